"""Files cut at arbitrary bytes, logs as a logger writes them, long forms, shared frames, scorers."""

import csv
import json
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from semrec import registry
from semrec.operators import behaviors as B
from semrec.operators import candidates as C
from semrec.operators import corpus as K
from semrec.operators.ordered import before_cut, global_row_number, order_bucket, ordered_parts
from semrec.plans import corpora, metadata, persona
from semrec.session import release, shared
from semrec.sources import fixtures as fx
from semrec.sources import readers as R
from semrec.sources import structure
from semrec.sources.structure import numbered_lines

SPLITS = ["97", "1000", "128m"]


@pytest.fixture()
def split_size(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for k, v in keep.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


# files in splits ---------------------------------------------------------------

def test_line_numbers_do_not_depend_on_the_splits(spark, tmp_dir, split_size):
    rnd = random.Random(1)
    for k in range(3):
        write(tmp_dir, f"{k}.txt", "".join("u" * rnd.randint(0, 30) + f" {i}" + rnd.choice(["\n", "\r\n"])
                                           for i in range(200 + k)))
    seen = []
    for size in SPLITS:
        split_size(size)
        lines = numbered_lines(spark, tmp_dir)
        assert (lines.rdd.getNumPartitions() > 20) == (size == "97")
        seen.append({(os.path.basename(r.file), r.line_no): r.value for r in lines.collect()})
        long = R.read_sequences(spark, tmp_dir)
        assert long.select("line_id").distinct().count() == sum(len(v.split()) > 1 for v in seen[-1].values())
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 603
    assert all(v.endswith(f" {n}") for (_, n), v in seen[0].items())


def test_row_index_of_an_eval_set_does_not_depend_on_the_splits(spark, tmp_dir, split_size):
    spark.range(500).select(F.lit(None).cast("string").alias("user_id"), F.col("id").cast("string").alias("description"),
                            F.lit("g").alias("groundtruth")).coalesce(2).write.parquet(f"{tmp_dir}/eval")
    seen = []
    for size in SPLITS:
        split_size(size)
        seen.append({r.description: r.user_id for r in R.read_eval_set(spark, f"{tmp_dir}/eval").collect()})
    assert seen[0] == seen[1] == seen[2]
    assert seen[0]["0"] == "user_0" and len(set(seen[0].values())) == 500


def odd_fields(n):
    rnd = random.Random(n)
    parts = ["plain", 'say ""twice""', 'a "quote"', "line\nend", "two\n\nends\n", "tab\there", "", "naïve ö", "'", '"',
             "{\"j\": 1}"]
    return [[str(i), *("".join(rnd.choices(parts, k=rnd.randint(0, 3))) for _ in range(2)), "end"] for i in range(n)]


@pytest.mark.parametrize("size", SPLITS)
def test_quoted_tsv_is_read_by_many_tasks(spark, tmp_dir, split_size, size):
    rows = odd_fields(150)
    for k in (0, 1):
        with open(os.path.join(tmp_dir, f"{k}.tsv"), "w", encoding="utf-8", newline="") as f:
            out = csv.writer(f, delimiter="\t", lineterminator="\n")
            out.writerow(["﻿t.id", "t.a", "t.b", "last"])
            out.writerows(rows[k::2])
    split_size(size)
    got = R.read_behavior_tsv(spark, tmp_dir, multi_line=True)
    assert got.columns == ["id", "a", "b", "last"]
    if size == "97":
        assert structure._pieces(spark, tmp_dir, "\n").rdd.getNumPartitions() > 8
    want = {r[0]: tuple(v or None for v in r) for r in rows}
    assert {r.id: tuple(v or None for v in r) for r in got.collect()} == want
    one_task = spark.read.option("sep", "\t").option("header", True).option("multiLine", True).option(
        "escape", '"').csv(tmp_dir).toDF(*got.columns)
    assert got.exceptAll(one_task).count() == 0 and one_task.count() == got.count()


def odd_catalog(n):
    rnd = random.Random(n)
    parts = ["}", "{", '"', "\\", "\\\"", "}}", "{\"x\": ", "é", "\n", " ", "a", ",", " ", ":"]
    text = lambda: "".join(rnd.choices(parts, k=rnd.randint(0, 8)))
    items = {}
    for i in range(n):
        items[f"{i}{text()}"] = rnd.choice([
            {"title": text(), "description": text(), "categories": text(), "sid": text()},
            {"title": text(), "more": {"deep": {"er": text()}, "list": [{"a": 1}, {}]}}, {}, None,
            {"sid": None, "title": text()}])
    return items


@pytest.mark.parametrize("size", SPLITS)
@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"indent": 2, "ensure_ascii": False}])
def test_one_json_object_is_read_by_many_tasks(spark, tmp_dir, split_size, size, layout):
    catalogues = [odd_catalog(60), odd_catalog(1), odd_catalog(0), odd_catalog(25)]
    for k, c in enumerate(catalogues):
        write(tmp_dir, f"{k}.json", json.dumps(c, **layout) + "\n" * (k % 2))
    split_size(size)
    got = R.read_item_catalog(spark, tmp_dir, whole_file=True)
    want = []
    for c in catalogues:
        for i, v in c.items():
            fields = tuple((v or {}).get(f) for f in R.CATALOG_FIELDS)
            if any(f is not None for f in fields):
                want.append((i, *fields))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    if size == "97":
        assert structure._pieces(spark, tmp_dir, "}").rdd.getNumPartitions() > 8
    whole = R.parse_catalog_json(spark.read.text(tmp_dir, wholetext=True))
    assert whole.count() == got.count()


# metric logs -------------------------------------------------------------------

# Banners, labels and line format of the evaluation logs being read.
PREFIX = "[2025-11-05 12:00:01,123] INFO: "
RULE = "=" * 60


def log_of(lines, prefix):
    return "\n".join(prefix + x for x in lines) + "\n"


@pytest.mark.parametrize("prefix", ["", PREFIX])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_logs_as_a_logger_writes_them(spark, tmp_dir, prefix, end):
    names = ["hit@1", "hit@5", "hit@10", "ndcg@5", "ndcg@10"]
    values = [0.25, 0.5, 0.75, 0.3125, 0.4]
    direct = ["Loaded 30 samples from parquet", "  hit@1: 0.9", RULE, "🎯 Final Hit Rate Results:", RULE,
              *[f"  {n}: {v:.4f}" for n, v in zip(names, values)], RULE, "Total samples: 30", "done 10:20:30"]
    cot = ["Test data size: 44", "🎯 Final CoT Hit Rate Results:", "  hit@1: 0.1", RULE,
           "🎯 Final CoT Hit Rate Results:", *[f"  {n}: {v:.4f}" for n, v in zip(names, values)],
           "late hit@5: 0.6 hit@5: 0.7", RULE]
    write(tmp_dir, "gpu_0.log", log_of(direct, prefix).replace("\n", end))
    write(tmp_dir, "gpu_1.log", log_of(direct[:-4], prefix).replace("\n", end))  # no closing rule, no count
    os.makedirs(f"{tmp_dir}/cot")
    write(f"{tmp_dir}/cot", "gpu_7.log", log_of(cot, prefix).replace("\n", end))
    write(f"{tmp_dir}/cot", "gpu_8.log", log_of(cot[:1], prefix).replace("\n", end))
    got = R.parse_metric_logs(spark, f"{tmp_dir}/gpu_*.log", names).collect()
    assert {(r.metric, r.value, r.n) for r in got if r.shard == 0} == {(n, v, 30) for n, v in zip(names, values)}
    assert [(r.found, r.metric) for r in got if r.shard == 1] == [(False, None)]
    got = R.parse_metric_logs(spark, f"{tmp_dir}/cot/gpu_*.log", names, "cot", 99).collect()
    values[1] = 0.7
    assert {(r.metric, r.value, r.n) for r in got if r.shard == 7} == {(n, v, 44) for n, v in zip(names, values)}
    assert [(r.found, r.metric) for r in got if r.shard == 8] == [(False, None)]


def test_a_stated_count_of_zero_gives_the_default(spark, tmp_dir):
    log = "Total samples: 0\nsamples 7\n🎯 Final CoT Hit Rate Results:\nhit@1: .5\n"
    write(tmp_dir, "gpu_2.log", log)
    got = R.parse_metric_logs(spark, tmp_dir, ["hit@1", "hit@5"], "cot", 12).collect()
    assert [(r.metric, r.value, r.n) for r in got] == [("hit@1", 0.5, 12)]


# numbering ---------------------------------------------------------------------

def jobs_started(spark, build):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, group)
    build()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_numbering_runs_nothing_while_the_plan_is_built(spark):
    df = spark.range(100).groupBy((F.col("id") % 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    assert jobs_started(spark, lambda: global_row_number(df, ["k"], "rn", "total")) == 0
    assert jobs_started(spark, lambda: df.collect()) > 0


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_slices_ascend_with_the_order(spark, slices):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("k"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("n"))
    got = order_bucket(df, [F.col("n"), F.col("k")], slices, "b").collect()
    got = [r.b for r in sorted(got, key=lambda r: (r.n is not None, r.n or 0, r.k))]
    assert got == sorted(got) and len(set(got)) <= slices
    if slices > 1:
        assert max(got.count(b) for b in set(got)) < 3 * 3000 / slices + 200
    empty = df.limit(0)
    assert order_bucket(empty, [F.col("k")], slices).collect() == []


def test_slices_grow_with_the_input(spark, tmp_dir, monkeypatch):
    from semrec.operators import ordered
    spark.range(200_000).write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    few = ordered.slices_of(df)
    monkeypatch.setattr(ordered, "SLICE_BYTES", 20_000)
    assert few == ordered.MIN_SLICES < ordered.slices_of(df)


# top-k, long forms, hot users ---------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_of_a_sample_with_very_many_sids(spark):
    n = 1_000_000
    cands = spark.range(n).select((F.col("id") % 1).cast("string").alias("sample_id"), F.lit(0).alias("think_idx"),
                                  F.col("id").cast("int").alias("beam_idx"), F.lit("t</think>x").alias("text"),
                                  F.concat(F.lit("sid"), F.col("id") % (n // 2)).alias("pred_sid"),
                                  (F.col("id") % 1000).cast("double").alias("score"))
    top = C.unique_top_k(cands, 10)
    assert "WindowGroupLimit" in plan_of(top)
    assert [(r.rank, r.pred_sid, r.score) for r in sorted(top.collect(), key=lambda r: r["rank"])] == [
        (i + 1, f"sid{1000 * i + 999}", 999.0) for i in range(10)]


def test_parts_join_to_the_whole_text(spark):
    rows = [(u, i, v * (1 + i % 3)) for u, v in (("a", "x"), ("b", "yy"), (None, "z" * 50)) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "u string, o long, v string").repartition(5)
    got = {}
    for r in ordered_parts(df, ["u"], "o", "v", "; ", 30, chunk_size=7).collect():
        got.setdefault(r.u, []).append((r.part_no, r.part))
        assert len(r.part) <= 30 + 150
    for u in ("a", "b"):
        assert "; ".join(p for _, p in sorted(got[u])) == "; ".join(v for k, _, v in rows if k == u)


def test_no_cell_grows_with_a_user(spark):
    n = 1_000_000
    items = spark.range(n).select(F.lit("hot").alias("user_id"), (F.col("id") + 1).alias("pos"),
                                  F.concat(F.lit("sid"), F.col("id")).alias("sid"))
    parts = K.leave_k_out_parts(items.withColumn("phrase", F.col("sid")), max_chars=100_000)
    facts = {r.split: r for r in parts.groupBy("split").agg(
        F.max(F.length("part")).alias("longest"), F.count(F.lit(1)).alias("n"), F.sum(F.length("part") + 2).alias("chars"),
        F.max("groundtruth").alias("target")).collect()}
    total = sum(len(f"sid{i}") + 2 for i in range(n))
    for split, k in K.SPLITS:
        tail = sum(len(f"sid{i}") + 2 for i in range(n - k - 1, n))
        assert facts[split].longest <= 100_000 + 9 and facts[split].n > 100
        assert facts[split].chars == total - tail and facts[split].target == f"sid{n - k - 1}"


@pytest.mark.parametrize("kind", ["sid", "reasoning", "alignment", "persona", "sequences"])
def test_long_forms_equal_the_whole_texts(spark, kind):
    inter, cat = fx.interactions(spark, SF_SMALL), fx.catalog(spark, SF_SMALL)
    log = B.positive_log(fx.behaviors(spark, SF_SMALL))
    keys, sep, prefix, end = ["split", "user_id"], "; ", K.PURCHASED_PREFIX, ";"
    if kind == "persona":
        items = metadata.item_metadata(log)
        parts, whole = persona.persona_parts(log, items, 300), persona.persona_grounding(log, items)
        prefix = persona.PERSONA_PREFIX
    elif kind == "sequences":
        parts, whole = B.user_sequence_parts(log, 3, 20), B.user_sequences(log, 3).withColumn(
            "description", F.expr("substring(line, length(user_id) + 2)"))
        keys, sep, prefix, end = ["user_id"], " ", "", ""
    else:
        build = {"sid": (corpora.sid_prediction_parts, corpora.sid_prediction_corpus),
                 "reasoning": (corpora.reasoning_parts, corpora.reasoning_corpus),
                 "alignment": (corpora.alignment_parts, corpora.alignment_corpus)}[kind]
        parts, whole = build[0](inter, cat, 200), build[1](inter, cat)
    got, targets, split = {}, {}, False
    for r in parts.collect():
        key = tuple(r[k] for k in keys)
        split |= r.part_no > 0
        got.setdefault(key, []).append((r.part_no, r.part))
        if "groundtruth" in parts.columns and r.part_no == 0:
            targets[key] = r.groundtruth
    assert split
    texts = {k: prefix + sep.join(p for _, p in sorted(v)) + end for k, v in got.items()}
    want = {tuple(r[k] for k in keys): r for r in whole.collect()}
    assert texts == {k: r.description for k, r in want.items()}
    if targets:
        assert targets == {k: r.groundtruth for k, r in want.items()}


def test_a_hot_users_rows_meet_their_cuts_in_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100_000).select(F.lit("hot").alias("user_id"), F.col("id").alias("idx"))
        cuts = spark.createDataFrame([("hot", "train", 99_000), ("hot", "val", 50), ("hot", "none", 0)],
                                     "user_id string, split string, cut long")
        met = before_cut(rows, cuts, "idx", span=1000)
        sizes = [r["n"] for r in met.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) > 4 and max(sizes) < 40_000
        assert {r.split: r["count"] for r in met.groupBy("split").count().collect()} == {"train": 99_000, "val": 50}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_behaviours_carry_their_place_in_the_order(spark):
    log = B.positive_log(fx.behaviors(spark, SF_SMALL)).select("user_id", "time_stamp", "event_id")
    placed = B.order_behaviors(log, "position").collect()
    assert [r.position for r in placed] == list(range(1, len(placed) + 1))
    assert [r.event_id for r in placed] == [r.event_id for r in B.order_behaviors(log).collect()]


# shared frames -------------------------------------------------------------------

def stored(spark):
    return spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_shared_frames_run_nothing_and_are_released(spark):
    release(spark)
    before = stored(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert jobs_started(spark, lambda: shared(df)) == 0
    kept = shared(df)
    assert kept.count() == 7 and kept.agg(F.sum("count")).first()[0] == 1000
    assert stored(spark) == before + 1
    release(spark)
    assert stored(spark) == before and kept.count() == 7
    plain = spark.range(10).where("id > 3")
    assert not shared(plain).is_cached and shared(plain, always=True).is_cached
    release(spark)


@pytest.mark.parametrize("name", ["legal_continuations", "trie_stats", "evaluate_default_candidates",
                                  "reconstruct_epoch_data", "merge_shards"])
def test_jobs_compute_their_intermediates_once_and_leave_nothing(spark, name):
    release(spark)
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get().replace("file:", "")
    before, kept = stored(spark), set(os.listdir(root))
    registry.QUERIES[name](spark, SF_SMALL)  # schemas and row counts of the tables are read once per application
    release(spark)
    built = []
    assert jobs_started(spark, lambda: built.append(registry.QUERIES[name](spark, SF_SMALL))) == 0
    if name == "reconstruct_epoch_data":  # reads the corpus and the candidates once, and shares nothing
        assert plan_of(built[0]).count("FileScan parquet") <= 13
    else:
        assert "InMemoryTableScan" in plan_of(built[0])
    assert built[0].count() > 0
    release(spark)
    assert stored(spark) == before and set(os.listdir(root)) == kept


# scorers -------------------------------------------------------------------------

def test_a_scorer_is_built_once_per_worker(spark, tmp_dir):
    prompts = spark.range(400).select(F.col("id").cast("string").alias("sample_id"),
                                      F.repeat(F.lit("p"), (F.col("id") % 40).cast("int")).alias("prompt")).repartition(12)

    def factory():
        with open(os.path.join(tmp_dir, f"{os.getpid()}"), "a") as f:
            f.write("built\n")

        def score(pdf):
            lengths = pdf["prompt"].str.len()
            assert "_bucket" not in pdf.columns and list(pdf.index) == list(range(len(pdf)))
            return pdf.assign(think_idx=os.getpid(), beam_idx=len(pdf), score=0.0,
                              text=f"{lengths.min()}-{lengths.max()}")[
                ["sample_id", "think_idx", "beam_idx", "text", "score"]]
        return score

    out = C.generate_candidates(prompts, factory=factory, batch_rows=8, by_length=True).collect()
    assert len(out) == 400 and max(r.beam_idx for r in out) <= 8
    for r in out:
        low, high = map(int, r.text.split("-"))
        assert (low + 1).bit_length() == (high + 1).bit_length()
    workers = {str(r.think_idx) for r in out}
    for pid in workers:
        with open(os.path.join(tmp_dir, pid)) as f:
            assert f.read() == "built\n"
    assert set(os.listdir(tmp_dir)) == workers
    with pytest.raises(ValueError):
        C.generate_candidates(prompts)
