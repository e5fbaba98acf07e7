"""Numbering without checkpoints, hot users, partition pruning, metrics over all samples."""

import io
import os
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from semrec import registry
from semrec.functions.sid import parse_semantic_id
from semrec.operators import behaviors as B
from semrec.operators import candidates as C
from semrec.operators import metrics as M
from semrec.operators.ordered import global_row_number, ordered_concat, positions
from semrec.plans import corpora, evaluation
from semrec.session import read_table
from semrec.sources import fixtures as fx
from semrec.sources import readers as R

# SIDs of the reference's form.
SIDS = [f"<|sid_begin|><s_a_{i}><s_b_{i}><s_c_{i}><|sid_end|>" for i in range(6)]


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_positions_keep_null_keys_and_ties_of_the_coarse_order(spark):
    rows = [(None, 3), (None, 1), (None, None), ("a", 2), ("a", 1)] + [("b", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t long")
    for bucket in (None, F.floor(F.col("t") / 7)):
        got = {(r.k, r.t): r.pos for r in positions(df, ["k"], ["t"], bucket=bucket).collect()}
        assert got[(None, None)] == 1 and got[(None, 1)] == 2 and got[(None, 3)] == 3
        assert got[("a", 1)] == 1 and [got[("b", i)] for i in range(500)] == list(range(1, 501))


def test_numbering_leaves_the_callers_cache_and_writes_nothing(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7).cache()
    got = global_row_number(df, [F.col("v"), F.col("id")], "rn", "total").collect()
    assert sorted(r.rn for r in got) == list(range(1, 1001)) and got[0].total == 1000
    assert [r.rn for r in sorted(got, key=lambda r: (r.v, r.id))] == list(range(1, 1001))
    assert df.is_cached
    df.unpersist()


def test_a_hot_users_history_is_joined_in_many_tasks(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("user_id"), F.col("id").alias("pos"),
                                     F.col("id").cast("string").alias("v"))
    by_user = df.repartition(8, "user_id")  # as a join on the user would leave it
    text = ordered_concat(by_user, ["user_id"], "pos", "v", ";", "line")
    assert "REPARTITION_BY_COL" in plan_of(text)
    assert text.first()["line"] == ";".join(map(str, range(100_000)))


def test_partition_filter_reaches_the_scan(spark):
    day = B.scan_behavior_partition(fx.behavior_table(spark, SF_SMALL), "20240102")
    plan = plan_of(B.positive_log(day))
    assert "PartitionFilters: [isnotnull(p_date" in plan and "20240102" in plan


def test_derived_inputs_grow_with_the_tables(spark):
    plan = plan_of(fx.behaviors(spark, SF_SMALL))
    assert "LessThan(doc_id" not in plan
    joined = read_table(spark, SF_SMALL, "lineitem").join(
        read_table(spark, SF_SMALL, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    inter = fx.interactions(spark, SF_SMALL)
    assert inter.count() == joined.count()
    assert inter.groupBy("user_id").agg((F.max("pos") == F.count("pos")).alias("ok")).where("not ok").count() == 0


def test_samples_without_candidates_are_misses(spark):
    truth = spark.createDataFrame([("u1", SIDS[0]), ("u2", SIDS[1]), ("u3", SIDS[2])],
                                  "sample_id string, groundtruth string")
    cands = spark.createDataFrame([("u1", 0, 0, SIDS[0], 1.0)], "sample_id string, think_idx int, "
                                  "beam_idx int, text string, score double")
    direct = {r.metric: r for r in evaluation.evaluate_direct(cands, truth, ["hit@1"]).collect()}
    assert direct["hit@1"].value == pytest.approx(1 / 3) and direct["hit@1"].n_samples == 3
    rel = evaluation.cot_relevance(cands, truth)
    assert rel.groupBy("sample_id").count().where("count = 10").count() == 3
    empty = rel.where("sample_id = 'u2'")
    assert empty.where("score = -1000 and pred_sid = '' and rel = 0").count() == 10
    cot = {r.metric: r for r in evaluation.evaluate_cot(cands, truth, ["hit@1"]).collect()}
    assert cot["hit@1"].value == pytest.approx(1 / 3) and cot["hit@1"].n_samples == 3


def test_illegal_items_lose_their_rank(spark):
    truth = spark.createDataFrame([("u1", SIDS[0])], "sample_id string, groundtruth string")
    cands = spark.createDataFrame([("u1", 0, 0, SIDS[1], 9.0), ("u1", 0, 1, SIDS[0], 1.0)],
                                  "sample_id string, think_idx int, beam_idx int, text string, score double")
    legal = spark.createDataFrame([(SIDS[0],)], "sid string")
    assert evaluation.evaluate_direct(cands, truth, ["hit@1"]).first().value == 0.0
    assert evaluation.evaluate_direct(cands, truth, ["hit@1"], legal=legal).first().value == 1.0
    assert evaluation.evaluate_cot(cands, truth, ["hit@1"], legal=legal).first().value == 1.0


def test_transitions_skip_removed_items(spark):
    seqs = spark.createDataFrame([("u", 1, SIDS[0]), ("u", 4, SIDS[1]), ("u", 9, SIDS[2])],
                                 "user_id string, pos long, sid string")
    last = spark.createDataFrame([("s", SIDS[0])], "sample_id string, sid string")
    got = C.transition_candidates(seqs, last).collect()
    assert [(r.sample_id, r.think_idx, r.beam_idx, r.text) for r in got] == [("s", 0, 0, SIDS[1])]


@pytest.mark.parametrize("text,want", [
    (" [69,142,246] ", [69, 142, 246]), ("(1,2,3)", [1, 2, 3]), ("[1,2,]", [1, 2]), ("[]", []), ("()", []),
    ("(5,)", [5]), ("[ -1 , +2 ]", [-1, 2]), ("(5)", None), ("[1,2,3] x", None), ("[1,2,3]]", None),
    ("[1,null]", None), ("[1,", None), ("[,]", None), ("(,)", None), ("[01]", None), ("", None), (None, None)])
def test_semantic_id_literals(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_semantic_id("s").alias("c")).first()["c"] == want


def test_batches_of_the_scorer_are_bounded(spark):
    prompts = spark.range(25).select(F.col("id").cast("string").alias("sample_id"), F.lit("p").alias("prompt"))

    def scorer(pdf):
        return pdf.assign(think_idx=0, beam_idx=0, text=str(len(pdf)), score=0.0)[
            ["sample_id", "think_idx", "beam_idx", "text", "score"]]

    out = C.generate_candidates(prompts.coalesce(1), scorer, batch_rows=10)
    assert sorted(int(r.text) for r in out.collect()) == [5] * 5 + [10] * 20
    assert out.rdd.getNumPartitions() == 1


def test_lines_of_one_user_stay_apart(spark):
    items = spark.createDataFrame([(str(i), "t", "d", "c", SIDS[i]) for i in range(6)], "item_id string, "
                                  "title string, description string, categories string, sid string")
    lines = spark.createDataFrame([("u1 1 2 3",), ("u1 4 5",)], "value string")
    out = corpora.by_line(corpora.sid_prediction_corpus, R.parse_sequence_lines(lines), items)
    test = {(r.description.count("sid_begin"), r.groundtruth) for r in out.where("split = 'test'").collect()}
    assert test == {(2, SIDS[3]), (1, SIDS[5])}


def test_log_reader_stays_on_a_line(spark, tmp_dir):
    log = "Total samples: 0\nfew samples\nport 8080\n🎯 Final CoT Hit Rate Results:\n x hit@5: 0.25\n"
    with open(os.path.join(tmp_dir, "gpu_3.log"), "w", encoding="utf-8") as f:
        f.write(log)
    got = R.parse_metric_logs(spark, os.path.join(tmp_dir, "gpu_*.log"), ["hit@5"], "cot", 99).collect()
    assert [(r.shard, r.metric, r.value, r.n) for r in got] == [(3, "hit@5", 0.25, 99)]


def test_reconstruction_uses_every_candidate(spark):
    corpus = spark.createDataFrame([("u", "d", SIDS[0], "t", "c")], "user_id string, description string, "
                                   "groundtruth string, title string, categories string")
    cands = spark.createDataFrame([("u", 2, 7, SIDS[0])], "user_id string, think_idx int, beam_idx int, text string")
    assert evaluation.reconstruct_epoch_data(corpus, cands).first().matched
    assert not evaluation.reconstruct_epoch_data(corpus, cands, n_thinking=2, n_beams=5).first().matched


def test_running_metrics_over_many_spans(spark, monkeypatch):
    monkeypatch.setattr(M, "SPAN", 2)
    rel = spark.range(40).select(F.col("id").alias("sample_id"), F.lit(1).cast("long").alias("rank"),
                                 (F.col("id") % 2).cast("int").alias("rel"))
    got = M.running_metrics(rel, 2, 2, ["hit@1"]).collect()
    assert {r.samples: r.value for r in got} == {n: 0.5 for n in range(4, 41, 4)}


def test_sums_of_registered_shards_keep_every_sample(spark):
    summary = registry.QUERIES["shard_metric_summary"](spark, SF_SMALL).first()
    assert summary.n_samples == fx.truth(spark, SF_SMALL).count()


def test_scratch_tables_go_with_the_application(tmp_dir):
    import subprocess
    import sys
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from semrec.session import get_session, scratch_path
spark = get_session("local[1]")
spark.sparkContext.setCheckpointDir({tmp_dir!r})
paths = [scratch_path(spark, "t") for _ in range(2)]
for p in paths: spark.range(3).write.parquet(p)
assert paths[0] != paths[1] and sum(spark.read.parquet(p).count() for p in paths) == 6
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=200)
    left = [f for _, _, files in os.walk(tmp_dir) for f in files if f.endswith(".parquet")]
    assert left == []
