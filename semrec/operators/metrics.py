"""Relevance, ranking metrics, shards and rationale gating
(C3, D14-D18, E5, E6, G1, B9).

Metrics follow the reference's edge rules exactly:
* hit@k is 0 for a sample with fewer than k candidates, even with a hit;
* ndcg@k sums every matching rank <= min(k, n) with IDCG fixed at 1, so
  repeated hits can push a sample above 1.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sid import extract_first_sid, extract_sid_strict
from .ordered import global_row_number

#: Report blocks summed together before the running sum over spans.
SPAN = 4096
DEFAULT_METRICS = ["hit@1", "hit@5", "hit@10", "ndcg@5", "ndcg@10"]


def parse_metrics(metrics: Sequence[str]) -> list[tuple[str, str, int]]:
    """D16 name parsing: ``hit@k`` / ``ndcg@k`` in any case; other names are a ``ValueError``."""
    found = [(m, re.fullmatch(r"(hit|ndcg)\w*@([1-9]\d*)", m.strip(), re.IGNORECASE)) for m in metrics]
    unknown = [m for m, hit in found if hit is None]
    if unknown:
        raise ValueError(f"unknown metrics: {', '.join(unknown)}")
    return [(m, hit[1].lower(), int(hit[2])) for m, hit in found]


def match_truth(ranked: DataFrame, truth: DataFrame, pred_col: str = "pred_sid",
                levels: int = 3) -> DataFrame:
    """``rel`` = 1 when the prediction equals the target's first SID.

    ``truth``: ``(sample_id, groundtruth)`` decides the samples (``sample_id`` is
    unique); one without any candidate keeps one row with a null ``rank`` and
    ``rel`` 0, so it counts as a miss in every metric.
    """
    t = truth.select("sample_id", extract_first_sid("groundtruth", levels).alias("target"))
    rel = F.coalesce((F.col(pred_col) == F.col("target")).cast("int"), F.lit(0))
    return t.join(ranked, "sample_id", "left").withColumn("rel", rel)


def per_sample_metrics(rel: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """Per sample: ``n`` candidates and one column per metric.

    ``rel``: ``(sample_id, rank, rel)``; one shuffle on ``sample_id``.
    """
    r, rank = F.col("rel"), F.col("rank")
    aggs = [F.count(rank).alias("n")]  # a null rank marks a sample without candidates
    for name, kind, k in parse_metrics(metrics):
        if kind == "hit":
            aggs.append(F.max(F.when(rank <= k, r).otherwise(0)).alias(f"_h{k}"))
        else:
            aggs.append(F.sum(F.when(rank <= k, r / F.log2(rank + 1)).otherwise(0.0)).alias(name))
    out = rel.groupBy("sample_id").agg(*aggs)
    for name, kind, k in parse_metrics(metrics):
        if kind == "hit":
            out = out.withColumn(name, F.when((F.col("n") >= k) & (F.col(f"_h{k}") == 1), 1.0)
                                 .otherwise(0.0)).drop(f"_h{k}")
    return out


def hit_at_k(rel: DataFrame, k: int) -> DataFrame:
    """Share of samples with a hit in the first k and at least k candidates."""
    return per_sample_metrics(rel, [f"hit@{k}"]).agg(F.avg(f"hit@{k}").alias("value"))


def ndcg_at_k(rel: DataFrame, k: int) -> DataFrame:
    """Mean over samples of sum rel / log2(rank + 1), rank <= k, IDCG = 1."""
    return per_sample_metrics(rel, [f"ndcg@{k}"]).agg(F.avg(f"ndcg@{k}").alias("value"))


def _long(wide: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double")
                              .alias("value")) for m in metrics])
    return wide.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.metric", "r.value")


def metric_report(rel: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """``(metric, value, n_samples)``; one pass over per-sample rows."""
    per = per_sample_metrics(rel, metrics)
    wide = per.agg(F.count(F.lit(1)).alias("n_samples"),
                   *[F.avg(f"`{m}`").alias(m) for m in metrics])
    return _long(wide, metrics, ["n_samples"]).select("metric", "value", "n_samples")


def contiguous_shards(df: DataFrame, n: int, mode: str = "ceil", key: str = "sample_id") -> DataFrame:
    """``shard`` = contiguous block in ``key`` order.

    ``ceil``: n blocks of ceil(rows / n) (every row kept); ``floor``: blocks of
    rows // n and the remainder is dropped, as the 8-way launcher does.
    """
    out = global_row_number(df, [key], "_rn", total_out="_total")
    if mode == "ceil":
        size = F.ceil(F.col("_total") / n)
    elif mode == "floor":
        size = F.floor(F.col("_total") / n)
    else:
        raise ValueError(mode)
    out = out.withColumn("shard", F.floor((F.col("_rn") - 1) / F.greatest(size, F.lit(1)))
                         .cast("int"))
    if mode == "floor":
        out = out.where(F.col("shard") < n)
    return out.drop("_rn", "_total")


def shard_metric_summary(shard_metrics: DataFrame) -> DataFrame:
    """From ``(shard, metric, value, n)`` rows: macro = unweighted mean of the
    per-shard values as logged (4 decimals), micro = sample-weighted mean,
    total samples and completed shards."""
    v4 = F.round(F.col("value"), 4)
    return shard_metrics.groupBy("metric").agg(
        F.avg(v4).alias("macro"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("micro"),
        F.sum("n").alias("n_samples"),
        F.countDistinct("shard").alias("shards"))


def sharded_metrics(rel: DataFrame, shards: DataFrame,
                    metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """Per-shard metric values ``(shard, metric, value, n)``.  ``shards``:
    ``(sample_id, shard)``."""
    per = per_sample_metrics(rel, metrics).join(shards, "sample_id")
    wide = per.groupBy("shard").agg(F.count(F.lit(1)).alias("n"),
                                    *[F.avg(f"`{m}`").alias(m) for m in metrics])
    return _long(wide, metrics, ["shard", "n"]).select("shard", "metric", "value", "n")


def running_metrics(rel: DataFrame, batch_size: int, every: int,
                    metrics: Sequence[str] = DEFAULT_METRICS, key: str = "sample_id") -> DataFrame:
    """E5: metrics over all samples so far, reported after every ``every``-th
    batch of ``batch_size`` samples (in ``key`` order).

    Per-sample values are summed per report block first; the running sum is a
    window over one row per block, not per sample.
    """
    per = per_sample_metrics(rel, metrics)
    per = global_row_number(per, [key], "_rn")
    block = F.ceil((F.floor((F.col("_rn") - 1) / batch_size) + 1) / every).cast("bigint")
    sums = per.groupBy(block.alias("block")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"`{m}`").alias(m) for m in metrics])
    # running sums in two levels: inside a span of blocks, and over the few spans
    sums = sums.withColumn("_span", F.floor(F.col("block") / SPAN))
    inside = Window.partitionBy("_span").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    names = ["_n", *metrics]
    spans = sums.groupBy("_span").agg(*[F.sum(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(names)])
    starts = spans.select("_span", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_s{i}")
                                     for i in range(len(names))])
    cum = (sums.select("_span", "block", *[F.sum(f"`{c}`").over(inside).alias(f"_c{i}")
                                           for i, c in enumerate(names)])
           .join(starts, "_span")
           .select("block", *[(F.col(f"_c{i}") + F.col(f"_s{i}")).alias("samples" if i == 0 else c)
                              for i, c in enumerate(names)]))
    # only complete report blocks are reported
    cum = cum.where(F.col("samples") >= F.col("block") * batch_size * every)
    wide = cum.select((F.col("block") * every).alias("step"), "samples",
                      *[(F.col(f"`{m}`") / F.col("samples")).alias(m) for m in metrics])
    return _long(wide, metrics, ["step", "samples"])


def merge_shards(frames: Sequence[DataFrame]) -> DataFrame:
    """G1: concatenate shard outputs in shard order (``shard`` column added)."""
    if not frames:
        raise ValueError("no shards to merge")
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("shard", F.lit(i))
        out = f if out is None else out.unionByName(f)
    return out


def gate_rationales(corpus: DataFrame, predictions: DataFrame, levels: int = 3,
                    letters: str = "a-d") -> DataFrame:
    """Keep ``title``/``categories`` only where the ground-truth SID is among
    the sample's predicted SIDs; otherwise null both.  Rows are never dropped.

    ``predictions``: ``(user_id, text)``.  Matching is one equi join on
    ``(user_id, sid)`` with the distinct predictions, so no per-user candidate list is
    ever materialised and the corpus is read once.
    """
    gt = extract_sid_strict("groundtruth", levels, letters)
    preds = (predictions.select("user_id", extract_sid_strict("text", levels, letters).alias("_gt"))
             .where(F.col("_gt").isNotNull()).distinct().withColumn("matched", F.lit(True)))
    out = (corpus.withColumn("_gt", gt).join(preds, ["user_id", "_gt"], "left")
           .withColumn("matched", F.coalesce("matched", F.lit(False))))
    return (out.withColumn("title", F.when(F.col("matched"), F.col("title")))
            .withColumn("categories", F.when(F.col("matched"), F.col("categories")))
            .drop("_gt"))


def match_rate(gated: DataFrame) -> DataFrame:
    """Rows, matched rows and their ratio."""
    return gated.agg(F.count(F.lit(1)).alias("rows"),
                     F.count_if(F.col("matched")).alias("matched"),
                     F.round(F.count_if(F.col("matched")) / F.count(F.lit(1)), 6).alias("rate"))

