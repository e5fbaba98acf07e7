"""File-in / file-out commands covering the reference's programs.

    python -m semrec.cli corpus --kind sid --sequences seq.txt --items items.jsonl --out out/
    python -m semrec.cli behaviors --log log.tsv --out out/ [--raw] [--p-date 20240102]
    python -m semrec.cli trie --test test.parquet --out out/
    python -m semrec.cli evaluate --candidates cands.parquet --truth test.parquet --mode cot
    python -m semrec.cli summarize-logs --logs 'logs/gpu_*.log' [--mode cot]
    python -m semrec.cli reconstruct --corpus ra_train.parquet --candidates cands.parquet --out out/

Every command is a Spark job; the session comes from the environment
(``spark-submit`` settings or ``--master``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .operators import behaviors as bh
from .operators import trie
from .operators.metrics import DEFAULT_METRICS, match_rate, shard_metric_summary
from .plans import corpora, evaluation, metadata
from .session import get_session, release, shared
from .sources import readers, writers

_CORPORA = {"sid": corpora.sid_prediction_corpus, "ra": corpora.reasoning_corpus,
            "align": corpora.alignment_corpus}


def _corpus(spark, a):
    seq = readers.read_sequences(spark, a.sequences)
    items = readers.read_item_catalog(spark, a.items, whole_file=a.whole_file)
    more = (a.prefix,) if a.prefix else ()
    out = corpora.by_line(_CORPORA[a.kind], seq, items, *more)
    writers.write_splits(out, a.out)


def _behaviors(spark, a):
    log = (readers.read_behavior_tsv(spark, a.log) if a.log.endswith(".tsv") or a.format == "tsv"
           else spark.read.parquet(a.log))
    if "event_id" not in log.columns:  # file order, taken at the scan before any filter
        log = log.withColumn("event_id", F.monotonically_increasing_id())
    if a.p_date:
        log = bh.require_partition(log, a.p_date)
    if a.raw:
        log = bh.positive_log(log)
    log = (log.withColumn("time_stamp", F.col("time_stamp").cast("timestamp_ntz"))
           .withColumn("content_type", F.col("content_type").cast("bigint"))
           .withColumn("photo_type", F.col("photo_type").cast("bigint")))
    log = shared(log, always=True)  # three sinks read it
    writers.write_catalog(metadata.item_metadata(log), f"{a.out}/items")
    seqs = bh.user_sequences(log, a.min_sequence_length)
    seqs.select(F.col("line").alias("value")).write.mode("overwrite").text(f"{a.out}/sequences")
    writers.write_behaviors(bh.user_behavior_details(log), f"{a.out}/behaviors")


def _trie(spark, a):
    test = readers.read_eval_set(spark, a.test)
    sids = trie.valid_sid_set(test)
    trie.sid_transitions(sids, a.eos).write.mode("overwrite").parquet(f"{a.out}/transitions")
    trie.sid_prefix_trie(sids, a.eos).write.mode("overwrite").parquet(f"{a.out}/prefix_trie")
    trie.trie_stats(sids, test).show(truncate=False)


def _evaluate(spark, a):
    cands = spark.read.parquet(a.candidates)
    truth = spark.read.parquet(a.truth)
    if "sample_id" not in truth.columns:  # an eval set keyed by user id
        truth = truth.withColumn("sample_id", F.col("user_id").cast("string"))
    truth = truth.select(F.col("sample_id").cast("string").alias("sample_id"), "groundtruth")
    cands = cands.withColumn("sample_id", F.col("sample_id").cast("string"))
    metrics = a.metrics.split(",")
    legal = spark.read.parquet(a.legal).select("sid") if a.legal else None
    evaluate = evaluation.evaluate_cot if a.mode == "cot" else evaluation.evaluate_direct
    rep = evaluate(cands, truth, metrics, legal=legal)
    rep.show(truncate=False)


def _summarize(spark, a):
    logs = readers.parse_metric_logs(spark, a.logs, a.metrics.split(","), a.mode,
                                     a.default_samples)
    logs.where(~F.col("found")).select("shard").show()
    shard_metric_summary(logs.where("found")).show(truncate=False)


def _reconstruct(spark, a):
    corpus = spark.read.parquet(a.corpus)
    cands = spark.read.parquet(a.candidates)
    out = shared(evaluation.reconstruct_epoch_data(corpus, cands, a.levels))
    out.write.mode("overwrite").parquet(a.out)
    match_rate(out).show()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="semrec")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("corpus")
    c.add_argument("--kind", choices=sorted(_CORPORA), required=True)
    c.add_argument("--sequences", required=True)
    c.add_argument("--items", required=True)
    c.add_argument("--whole-file", action="store_true", help="items is one JSON object")
    c.add_argument("--prefix", default=None)
    c.add_argument("--out", required=True)
    c.set_defaults(fn=_corpus)

    b = sub.add_parser("behaviors")
    b.add_argument("--log", required=True)
    b.add_argument("--format", choices=["tsv", "parquet"], default="parquet")
    b.add_argument("--raw", action="store_true", help="apply the positive-behaviour filter")
    b.add_argument("--p-date", default=None)
    b.add_argument("--min-sequence-length", type=int, default=3)
    b.add_argument("--out", required=True)
    b.set_defaults(fn=_behaviors)

    t = sub.add_parser("trie")
    t.add_argument("--test", required=True)
    t.add_argument("--eos", default=trie.DEFAULT_EOS)
    t.add_argument("--out", required=True)
    t.set_defaults(fn=_trie)

    e = sub.add_parser("evaluate")
    e.add_argument("--candidates", required=True)
    e.add_argument("--truth", required=True)
    e.add_argument("--mode", choices=["direct", "cot"], default="direct")
    e.add_argument("--metrics", default=",".join(DEFAULT_METRICS))
    e.add_argument("--legal", default=None, help="parquet with the legal SIDs (column sid)")
    e.set_defaults(fn=_evaluate)

    s = sub.add_parser("summarize-logs")
    s.add_argument("--logs", required=True)
    s.add_argument("--mode", choices=["direct", "cot"], default="direct")
    s.add_argument("--metrics", default=",".join(DEFAULT_METRICS))
    s.add_argument("--default-samples", type=int, default=None)
    s.set_defaults(fn=_summarize)

    r = sub.add_parser("reconstruct")
    r.add_argument("--corpus", required=True)
    r.add_argument("--candidates", required=True)
    r.add_argument("--levels", type=int, default=3)
    r.add_argument("--out", required=True)
    r.set_defaults(fn=_reconstruct)

    a = p.parse_args(argv)
    spark = get_session(a.master)
    try:
        a.fn(spark, a)
    finally:
        release(spark)


if __name__ == "__main__":
    main()
