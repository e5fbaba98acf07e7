"""Work that grows no faster than the input: what is written, shuffled and read twice."""

import glob
import io
import os
from contextlib import redirect_stdout

import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semrec.functions import text as txt
from semrec.llm import pii
from semrec.llm import quality as Q
from semrec.operators import behaviors as B
from semrec.operators import candidates as C
from semrec.operators.ordered import before_cut, ordered_concat, ordered_parts, parts_before_cuts, positions
from semrec.plans import evaluation, metadata, persona
from semrec.session import sized_broadcast
from semrec.sources import fixtures as fx
from semrec.sources import readers as R
from semrec.sources import structure
from semrec.sources import writers as W


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("quoted", [False, True])
def test_a_compressed_tsv_comes_back(spark, tmp_dir, quoted):
    rows = [(str(i), f'te"xt\t{i}\nline\\n' * 50) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, text string").coalesce(1)
    sizes = {}
    for kind in (None, "gzip"):
        path = os.path.join(tmp_dir, str(kind))
        W.write_behavior_tsv(df, path, quoted=quoted, compression=kind)
        sizes[kind] = sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*"))
        back = R.read_behavior_tsv(spark, path, multi_line=quoted)
        assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert 4 * sizes["gzip"] < sizes[None]


def test_quoted_records_are_put_together_without_a_shuffle_of_their_text(spark, tmp_dir):
    df = spark.createDataFrame([(str(i), f"a\nb{i}") for i in range(50)], "id string, text string").coalesce(1)
    W.write_behavior_tsv(df, tmp_dir, quoted=True)
    records = structure.quoted_records(spark, tmp_dir)
    assert "Window" not in plan_of(records.where("record_no < 0").select("value")).split("MapInArrow")[-1]
    assert sorted(r.value for r in records.where("record_no > 0").collect()) == sorted(
        f'"{i}"\t"a\nb{i}"' for i in range(50))
    assert sorted(r.record_no for r in records.collect()) == list(range(51))


def test_the_copy_of_the_log_holds_no_texts_and_gives_the_same_rows(spark):
    files = spark.read.parquet(fx.behavior_path(spark, SF_SMALL))
    assert not {"prompt", "introduction"} & set(files.columns)
    log, table = fx.behaviors(spark, SF_SMALL), fx.behavior_table(spark, SF_SMALL)
    table = table.select(log.columns)
    assert table.exceptAll(log).count() == 0 and log.exceptAll(table).count() == 0


def test_no_documents_text_is_broadcast_or_moved_without_need(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(fx._with_texts(fx._log_rows(spark, SF_SMALL), spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    long, short = fx.behaviors(spark, SF_SMALL), fx.behavior_outline(spark, SF_SMALL)
    texts = ["prompt", "introduction"]
    assert short.columns == long.columns
    rows = [df.select(*[c for c in df.columns if c not in texts], *[F.isnull(c).alias(c) for c in texts])
            for df in (long, short)]
    assert rows[0].exceptAll(rows[1]).count() == 0 and rows[1].exceptAll(rows[0]).count() == 0
    assert short.agg(F.max(F.length("prompt"))).first()[0] <= len("\rtail")
    details = [B.user_behavior_details(B.positive_log(df)) for df in (long, short)]
    assert sorted(map(tuple, details[0].collect())) == sorted(map(tuple, details[1].collect()))


def test_items_are_cut_short_before_rows_move(spark):
    schema = ("item_id string, time_stamp timestamp, event_id long, semantic_id string, prompt string, title string, "
              "introduction string, content_type int, photo_type int")
    rows = [("a", None, 1, "[1,2,3]", "p" * 3000, "", "i" * 3000, 0, 1), ("a", None, 2, "[4,5,6]", "q" * 3000, None, "", 0, 2),
            ("b", None, 3, "[1,2,3]", "p", "t", "", 1, 1), ("b", None, 4, "[", "p", "t", "", 1, 1),
            ("c", None, 5, "[7,8,9]", None, None, None, None, None)]
    items = metadata.item_metadata(spark.createDataFrame(rows, schema))
    got = {r.item_id: (r.title, r.description) for r in items.collect()}
    assert got == {"a": ("q" * 100, "q" * 1000 + "..."), "c": ("Item c", "")}
    for line in plan_of(items).splitlines():
        if line.startswith("Functions"):
            assert "introduction" not in line and "prompt" not in line


def test_values_are_placed_once_for_all_cuts(spark):
    rows = spark.createDataFrame([("u", i, f"v{i}" * (1 + i % 4)) for i in range(1, 60)], "user_id string, pos long, v string")
    cuts = spark.createDataFrame([("u", "a", 60), ("u", "b", 31), ("u", "c", 1), ("x", "a", 5)],
                                 "user_id string, split string, cut long")
    parts = parts_before_cuts(rows, cuts, "pos", "v", "; ", 25)
    got = {}
    for r in parts.collect():
        got.setdefault(r.split, []).append((r.part_no, r.part))
    whole = {c: "; ".join(f"v{i}" * (1 + i % 4) for i in range(1, n)) for c, n in (("a", 60), ("b", 31))}
    assert {c: "; ".join(p for _, p in sorted(v)) for c, v in got.items()} == whole
    assert min(len(v) for v in got.values()) > 3
    each = ordered_parts(before_cut(rows, cuts, "pos"), ["split", "user_id"], "pos", "v", "; ", 25)
    assert sorted(map(tuple, each.collect())) == sorted(map(tuple, parts.collect()))


def test_first_places_are_numbers_in_generation_order(spark):
    rows = [("s", 1, 0, "p", 1.0), ("s", 0, 7, "p", 0.5), ("s", 0, 3, "q", 2.0), ("s", None, 9, "q", 2.0)]
    df = spark.createDataFrame(rows, "sample_id string, think_idx int, beam_idx int, pred_sid string, score double")
    best = C.best_score_per_sid(df)
    assert "SortAggregate" not in plan_of(best)
    assert {(r.pred_sid, r.score, r.first_ord.think_idx, r.first_ord.beam_idx) for r in best.collect()} == {
        ("p", 1.0, 0, 7), ("q", 2.0, None, 9)}


def test_a_document_is_judged_by_one_factor_of_its_closest_estimate(spark):
    rows = [(i, lang, source, 20, 90 + i, 2, i % 3, 0, 0, i == 5) for i, (lang, source) in enumerate(
        [("en", "web"), ("en", "new"), ("de", "web"), ("en", None), (None, "web"), ("en", "web")])]
    stats = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, "
                                        "n_lines long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                        "base_failed boolean")
    keys = [("0:=en", "=web"), ("1:=en", "-"), ("2:-", "-")]
    variances = [float(i == j) / 4 for i, j in Q._PAIRS]
    names = ["lang", "source", "size", *[f"m{i}" for i in range(Q.DIMS)], *[f"v{i}{j}" for i, j in Q._PAIRS]]
    estimates = spark.createDataFrame([(*k, 300, *[float(n + 1)] * Q.DIMS, *variances) for n, k in enumerate(keys)], names)
    judged = Q.judged(stats, estimates, 30.0)
    assert judged.columns == [*stats.columns, "distance", "kept"]
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = judged._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count(" AS c33#") == 1
    vectors = {r.doc_id: r for r in stats.select("doc_id", *Q._vector()).collect()}
    got = {r.doc_id: r for r in judged.collect()}
    for doc_id, mean in enumerate([1, 2, 3, 2, 3]):
        v = vectors[doc_id]
        want = sum((v[f"__x{i}"] / Q.SCALE - mean) ** 2 / (0.25 + v[f"__e{i}"] / Q.SCALE ** 2) for i in range(Q.DIMS))
        assert got[doc_id].distance == pytest.approx(want) and got[doc_id].kept == (want <= 30)
    assert got[5].distance is None and not got[5].kept
    assert all(r.distance is None and r.kept != r.base_failed for r in Q.judged(stats, estimates.limit(0)).collect())


def test_rows_are_numbered_with_one_shuffle_of_their_own(spark):
    rows = spark.createDataFrame([(u, i, f"v{i}") for u in ("a", "b", None) for i in range(50)],
                                 "user_id string, at int, v string")
    got = positions(rows, ["user_id"], ["at"], bucket=F.floor(F.col("at") / 7))
    assert sorted(got.columns) == ["at", "pos", "user_id", "v"]
    assert [r.pos for r in got.orderBy("user_id", "at").collect()] == list(range(1, 51)) * 3
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan


def test_transitions_cross_chunks_and_gaps_without_a_self_join(spark):
    rows = [("u", p, s) for p, s in ((1, "a"), (2, "b"), (5, "a"), (511, "b"), (512, "a"), (2000, "b"), (2001, "c"))]
    rows += [("w", 3, "a"), ("w", 1030, "b"), (None, 1, "a"), (None, 2, "b"), ("x", 7, "c")]
    train = spark.createDataFrame(rows, "user_id string, pos long, sid string")
    last = spark.createDataFrame([("u", "a"), ("w", "b"), ("x", "c")], "sample_id string, sid string")
    got = C.transition_candidates(train, last)
    assert {(r.sample_id, r.beam_idx, r.pred_sid, r.score) for r in got.collect()} == {
        ("u", 0, "b", 4.0), ("w", 0, "a", 2.0), ("w", 1, "c", 1.0)}
    assert got._jdf.queryExecution().analyzed().toString().count("Join") == 1


@pytest.mark.parametrize("n", [3, 1100])
def test_default_candidates_leave_out_the_last_two(spark, n):
    items = spark.createDataFrame([(str(i), f"s{i}", "t", "c") for i in range(5)],
                                  "item_id string, sid string, title string, categories string")
    seqs = {"u": [(p, str(p % 5)) for p in range(1, n + 1)], "w": [(4, "1")], "v": [(1, "1"), (2, "9"), (9, "2")]}
    inter = spark.createDataFrame([(u, p, i) for u, v in seqs.items() for p, i in v],
                                  "user_id string, pos long, item_id string")
    want = {}
    for p in range(1, n - 2):
        want[f"s{p % 5}", f"s{(p + 1) % 5}"] = want.get((f"s{p % 5}", f"s{(p + 1) % 5}"), 0) + 1
    expected = {(u, d, float(c)) for u, last in (("u", f"s{(n - 1) % 5}"), ("v", "s1"))
                for (s, d), c in want.items() if s == last}
    got = evaluation.default_candidates(inter, items)
    assert {(r.sample_id, r.pred_sid, r.score) for r in got.collect()} == expected


def test_descriptions_meet_samples_and_not_their_outputs(spark):
    details = fx.truth(spark, SF_SMALL).where("sample_id < '3'").select(
        "sample_id", F.concat(F.lit("d"), "sample_id").alias("description"))
    got = fx.candidates(spark, SF_SMALL, details)
    want = fx.candidates(spark, SF_SMALL).join(details, "sample_id").select(got.columns)
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode") < plan.index("Join")


def test_thinking_is_found_from_the_end(spark):
    rows = [("x<think>a</think>", "x"), ("uu<think> k </think>u<think>\nb\n</think>c", "u"), ("no", "n"), ("<think>k", None),
            ("<think>k</think>", "q"), ("<think>k</think>u", "u"), (None, "u"), ("<think>k", "")]
    df = spark.createDataFrame(rows, "t string, u string").select(txt.extract_thinking("t", "u").alias("k"))
    assert [r.k for r in df.collect()] == ["a", "b", "", "k", "k", "", "", ""]
    assert "instr" not in df._jdf.queryExecution().analyzed().toString().lower()


def test_personal_data_is_found_in_small_batches(spark):
    rows = [(i, None if i % 7 == 0 else f"mail me{i}@x.org now") for i in range(3 * pii.ROWS + 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.text for r in pii.redact_documents(docs).collect()}
    assert got == {i: None if t is None else "mail [EMAIL] now" for i, t in rows}

    class Docs:  # hands the batch function on, to be called here
        schema = docs.schema
        select = mapInArrow = lambda self, *a: a[0] if callable(a[0]) else self

    ready, pii.python_ready = pii.python_ready, lambda df: df
    try:
        work = pii._mapped(Docs(), "text", [T.StructField("__r", T.StringType())], lambda t: (t,))
    finally:
        pii.python_ready = ready
    batch = pa.RecordBatch.from_pydict({n: [r[k] for r in rows] for n, k in (("doc_id", 0), ("text", 1), ("__text", 1))})
    out = list(work(iter([batch, batch.slice(0, 0)])))
    assert [b.num_rows for b in out] == [pii.ROWS] * 3 + [5]
    assert pa.Table.from_batches(out)["__r"].to_pylist() == [r[1] for r in rows]


def test_a_columnar_file_is_not_broadcast_by_its_size_on_disk(spark, tmp_dir):
    path = f"{tmp_dir}/items.parquet"
    spark.range(200_000).select(F.col("id").cast("string").alias("item"), F.lit("a long text " * 20).alias("title"),
                                F.lit("more " * 20).alias("more")).coalesce(1).write.parquet(path)
    items = spark.read.parquet(path)
    on_disk = os.path.getsize(glob.glob(f"{path}/*.parquet")[0])
    rows = spark.range(1000).select(F.col("id").cast("string").alias("item"))
    whole = rows.join(sized_broadcast(items, 2 * on_disk), "item")
    one_column = rows.join(sized_broadcast(items, 2 * on_disk), "item", "left").select("item")
    for joined in (whole, one_column):  # an estimate for one column falls under Spark's own bound
        assert "BroadcastHashJoin" not in plan_of(joined)
    assert "BroadcastHashJoin" in plan_of(rows.join(sized_broadcast(items, 40 * on_disk), "item"))
    assert whole.count() == one_column.count() == 1000
    small = spark.range(10).select(F.col("id").cast("string").alias("item"))
    assert "BroadcastHashJoin" in plan_of(rows.join(sized_broadcast(small, 1 << 20), "item"))


def test_offers_of_a_sample_move_as_numbers(spark):
    assert "cand_sid" not in plan_of(fx.candidates(spark, SF_SMALL)).split("collect_list", 1)[1].split("\n", 1)[0]
    sizes = [(p, s) for p in (-300, -1, 0, 5, 255, 256, 70_000, 1 << 40) for s in (-9, 0, 50, None)]
    rows = spark.createDataFrame(sizes, "p_partkey long, p_size int")
    p, last = F.col("p_partkey"), fx._last_code()
    got = rows.select(fx._packed_sid(p, last).alias("n"), fx._sid_text(p, last).alias("sid")).select(
        "n", "sid", fx._unpacked_sid(F.col("n")).alias("back")).collect()
    assert all(r.back == r.sid and (r.n is None or 0 <= r.n < fx._NO_SID - 1) for r in got)
    assert sum(r.sid is None for r in got) == 8


def test_compressed_quoted_files_are_read_once(spark, tmp_dir):
    rows = [(str(i), f'a "{i}"\nb\r\n\n{"x" * (i % 50)}', "" if i % 3 else "\t") for i in range(700)]
    df = spark.createDataFrame(rows, "k string, a string, b string").repartition(3)
    W.write_behavior_tsv(df, f"{tmp_dir}/gz", quoted=True, compression="gzip")
    got = R.read_behavior_tsv(spark, f"{tmp_dir}/gz", multi_line=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan
    plain = W.write_behavior_tsv(df, f"{tmp_dir}/plain", quoted=True) or R.read_behavior_tsv(
        spark, f"{tmp_dir}/plain", multi_line=True)
    assert sorted(map(tuple, got.na.fill("").collect())) == sorted(map(tuple, plain.na.fill("").collect()))
    assert sorted(r.a for r in got.collect()) == sorted(a for _, a, _ in rows)


def test_persona_clauses_are_moved_once_for_all_splits(spark):
    rows = [("u", i, i * 3 + 1 + i % 2, f"clause {i} " + "y" * (i % 40)) for i in range(1, 900)] + [("v", 1, 4, "only")]
    others = spark.createDataFrame(rows, "user_id string, idx long, o long, clause string")
    cuts = spark.createDataFrame([("u", "train", 300), ("u", "val", 895), ("u", "test", 899), ("v", "test", 2),
                                  ("w", "test", 5)], "user_id string, split string, cut long")
    found = [("u", "train", 30, "q 1"), ("u", "val", 30, "q 22"), ("u", "test", 30, "q 22"), ("u", "test", 2691, "late")]
    searches = spark.createDataFrame(found, "user_id string, split string, o long, clause string")
    clauses = searches.unionByName(before_cut(others, cuts, "idx").select("user_id", "split", "o", "clause"))
    keys = ["user_id", "split"]
    want = {r[:2]: r[2] for r in map(tuple, ordered_concat(clauses, keys, "o", "clause", "; ", "h").collect())}
    got = persona._histories(cuts, searches, others)
    assert {(r.user_id, r.split): r.history for r in got.collect()} == want and len(want) == 4
    wanted = ordered_parts(clauses, keys, "o", "clause", "; ", 1000)
    parts = persona._history_parts(cuts, searches, others, 1000)
    assert sorted(map(tuple, parts.select(*wanted.columns).collect())) == sorted(map(tuple, wanted.collect()))
