"""Scored-candidate operators.

Candidates are a table ``(sample_id, think_idx, beam_idx, text, score)``; the
generation order inside a sample is ``(think_idx, beam_idx)``.  Per-sample
groups are bounded by the beam budget, so per-sample windows here are small.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import THINK_CLOSE, normalize_prediction
from ..session import ship_package, sized_broadcast
from .ordered import CHUNK_SIZE, global_row_number

ILLEGAL_SCORE = -1000.0


def with_predictions(candidates: DataFrame, levels: int = 3) -> DataFrame:
    """H19 as a column: ``pred_sid`` = normalised prediction of ``text``."""
    return candidates.withColumn("pred_sid", normalize_prediction("text", levels))


def fan_out_thinking(prompts: DataFrame, n: int) -> DataFrame:
    """Each prompt ``n`` times with ``think_idx`` 0..n-1 (a generator, not a join)."""
    return prompts.withColumn("think_idx", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def demote_illegal_items(candidates: DataFrame, legal: DataFrame, sid_col: str = "pred_sid",
                         penalty: float = ILLEGAL_SCORE) -> DataFrame:
    """A candidate whose SID is not in ``legal`` (one ``sid`` column) scores
    ``penalty`` before ranking."""
    lg = legal.select(F.col("sid").alias(sid_col)).distinct().withColumn("_legal", F.lit(True))
    return (candidates.join(sized_broadcast(lg), sid_col, "left")
            .withColumn("score", F.when(F.col("_legal"), F.col("score"))
                        .otherwise(F.lit(penalty)))
            .drop("_legal"))


def slice_samples(df: DataFrame, offset: int = 0, n: int = -1, key: str = "sample_id") -> DataFrame:
    """Skip ``offset`` rows in ``key`` order, then keep at most ``n`` (n <= 0: all)."""
    if n > 0:  # each task keeps its first offset + n rows
        return df.orderBy(key).offset(offset).limit(n)
    return global_row_number(df, [key], "_rn").where(F.col("_rn") > offset).drop("_rn")


def head_samples(df: DataFrame, n: int, key: str = "sample_id") -> DataFrame:
    """First ``n`` rows by ``key`` (a debugging limit; the limit is the feature)."""
    return df.orderBy(key).limit(n)


def rank_candidates(candidates: DataFrame, score: str = "score",
                    order: tuple[str, ...] = ("think_idx", "beam_idx")) -> DataFrame:
    """``rank`` per sample by descending score; ties keep generation order."""
    w = Window.partitionBy("sample_id").orderBy(F.col(score).desc(), *order)
    return candidates.withColumn("rank", F.row_number().over(w).cast("bigint"))


def best_score_per_sid(candidates: DataFrame) -> DataFrame:
    """Per sample and normalised SID the best score and the first
    occurrence ``(think_idx, beam_idx)``, which breaks score ties.
    Expects ``pred_sid`` (see :func:`with_predictions`).
    """
    best = _best(candidates)
    code, low = F.col("first_ord"), -(1 << 31)
    cells = {"think_idx": F.shiftright(code, 32), "beam_idx": code.bitwiseAND(F.lit((1 << 32) - 1)) + low}
    return best.withColumn("first_ord", F.struct(*[
        F.nullif(c, F.lit(low)).cast(candidates.schema[name].dataType).alias(name) for name, c in cells.items()]))


def _generation() -> Column:
    """``(think_idx, beam_idx)`` as one number in the same order (nulls first): a number is aggregated in a
    hash table, a struct only after a sort of all rows."""
    low = -(1 << 31)
    think, beam = (F.coalesce(F.col(c).cast("bigint"), F.lit(low)) for c in ("think_idx", "beam_idx"))
    return think * (1 << 32) + (beam - low)


def _best(candidates: DataFrame) -> DataFrame:
    """Per sample and SID the best score and the first place in :func:`_generation` order (``first_ord``)."""
    return candidates.groupBy("sample_id", "pred_sid").agg(
        F.max("score").alias("score"), F.min(_generation()).alias("first_ord"))


def unique_top_k(candidates: DataFrame, k: int = 10, step: float = 0.1) -> DataFrame:
    """F2 + E4: top ``k`` distinct SIDs per sample over every thinking sample and
    beam, rebuilt as ``<first candidate's think block>\\n<sid>``; fewer than
    ``k`` are padded by repeating the last with a compounding penalty
    (pad i scores ``last - step * i * (i + 1) / 2``).

    Returns ``(sample_id, rank, text, pred_sid, score, padded)``.  No cell and no task holds
    more than ``k`` SIDs of a sample besides the per-SID aggregates.
    """
    best = _best(candidates)
    # every map task keeps at most k SIDs of a sample before the shuffle (WindowGroupLimit)
    order = Window.partitionBy("sample_id").orderBy(F.col("score").desc_nulls_last(), "first_ord", "pred_sid")
    kept = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    tops = kept.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct(
        "r", (-F.col("score")).alias("s"), "pred_sid"))).alias("top"))
    firsts = candidates.groupBy("sample_id").agg(F.min_by("text", _generation()).alias("first_text"))
    per = tops.join(firsts, "sample_id")
    prefix = F.concat(F.substring_index("first_text", THINK_CLOSE, 1), F.lit(THINK_CLOSE))
    ranks = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda r: F.struct(
        r.cast("bigint").alias("rank"), F.element_at("top", F.least(r, F.size("top"))).alias("c"),
        F.greatest(r - F.size("top"), F.lit(0)).alias("pad")))
    rows = per.select("sample_id", prefix.alias("prefix"), F.explode(ranks).alias("r"))
    i = F.col("r.pad")
    score = -F.col("r.c.s")
    return rows.select("sample_id", F.col("r.rank").alias("rank"),
                       F.concat("prefix", F.lit("\n"), "r.c.pred_sid").alias("text"),
                       F.col("r.c.pred_sid").alias("pred_sid"),
                       F.when(i > 0, score - F.lit(step / 2) * i * (i + 1)).otherwise(score)
                       .alias("score"), (i > 0).alias("padded"))


def pad_candidates(ranked: DataFrame, k: int = 10, step: float = 0.1) -> DataFrame:
    """Pad each sample's ranked list ``(sample_id, rank, ..., score)`` to ``k``
    rows by repeating its last row; pad i scores ``last - step * i * (i + 1) / 2``
    (each pad subtracts ``step * i`` from the previous, already penalised one).
    Adds ``padded``.  Per sample only the last row is carried (``max_by``)."""
    other = [c for c in ranked.columns if c not in ("sample_id", "rank", "score")]
    m = ranked.groupBy("sample_id").agg(
        F.max("rank").alias("m"), F.max_by(F.struct("score", *other), "rank").alias("last"))
    pads = (m.where(F.col("m") < k)
            .select("sample_id", "m", "last",
                    F.explode(F.sequence(F.lit(1), k - F.col("m"))).alias("i"))
            .select("sample_id", (F.col("m") + F.col("i")).alias("rank"),
                    *[F.col(f"last.{c}").alias(c) for c in other],
                    (F.col("last.score") - F.lit(step / 2) * F.col("i") * (F.col("i") + 1))
                    .alias("score"), F.lit(True).alias("padded")))
    return ranked.withColumn("padded", F.lit(False)).unionByName(pads)


Scorer = Callable[[pd.DataFrame], pd.DataFrame]
#: The scorer that this Python worker has built, by the name of its job.
_BUILT: dict[str, Scorer] = {}


def _built(job: str, factory: Callable[[], Scorer]) -> Scorer:
    """The worker's scorer of ``job``; built on first use, kept over tasks, one at a time."""
    if job not in _BUILT:
        _BUILT.clear()
        _BUILT[job] = factory()
    return _BUILT[job]


def _batched(frames: Iterator[pd.DataFrame], rows: int | None) -> Iterator[pd.DataFrame]:
    """Frames of at most ``rows`` rows (as they come without a number); with a column ``_bucket`` none
    holds two buckets, and a bucket's rows are filled up over the incoming frames."""
    if rows is None:
        for pdf in frames:
            yield from ((g for _, g in pdf.groupby("_bucket")) if "_bucket" in pdf else [pdf])
        return
    held: list[pd.DataFrame] = []
    size, bucket = 0, None
    for pdf in frames:
        groups = pdf.groupby("_bucket") if "_bucket" in pdf else [(None, pdf)]
        for name, group in groups:
            if held and name != bucket:
                yield pd.concat(held)
                held, size = [], 0
            bucket = name
            while len(group):
                part, group = group.iloc[:rows - size], group.iloc[rows - size:]
                held.append(part)
                size += len(part)
                if size == rows:
                    yield pd.concat(held)
                    held, size = [], 0
    if held:
        yield pd.concat(held)


def generate_candidates(prompts: DataFrame, fn: Scorer | None = None, schema: str | None = None,
                        batch_rows: int | None = None, factory: Callable[[], Scorer] | None = None,
                        by_length: bool = False, profile=None) -> DataFrame:
    """Plug-in batch scorer.  A scorer maps a pandas batch of prompts (``sample_id``, ``prompt``, ...) of at
    most ``batch_rows`` rows to candidate rows of ``schema`` (the candidate columns by default).

    ``fn`` is the scorer itself; ``factory`` builds one (loads a model) and is called once per Python worker,
    which keeps what it built for its later tasks.  ``by_length`` sorts each partition so that a batch only
    holds prompts of one length bucket (lengths between two powers of two), which wastes little padding.
    ``profile`` is a Spark resource profile for this stage (GPUs).  Runs in Arrow batches through
    ``mapInPandas``; no model ships with this package.
    """
    if (fn is None) == (factory is None):
        raise ValueError("give either fn or factory")
    job = uuid.uuid4().hex

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _batched(frames, batch_rows):
            scorer = fn or _built(job, factory)
            out = scorer(pdf.drop(columns="_bucket", errors="ignore").reset_index(drop=True))
            if out is not None and len(out):
                yield out

    if schema is None:
        kind = prompts.schema["sample_id"].dataType.simpleString()
        schema = f"sample_id {kind}, think_idx int, beam_idx int, text string, score double"
    if by_length:
        size = F.coalesce(F.length("prompt"), F.lit(0))
        prompts = (prompts.withColumn("_bucket", F.floor(F.log2(size + 1)).cast("int"))
                   .sortWithinPartitions("_bucket", "sample_id"))
    ship_package(prompts.sparkSession)
    return prompts.mapInPandas(run, schema, profile=profile)


def transition_candidates(train_seqs: DataFrame, last_items: DataFrame, k: int = 10,
                          chunk: str | None = None) -> DataFrame:
    """Default candidate generator without a model.

    ``train_seqs``: ``(user_id, pos, sid)`` training histories of resolved items.
    Item -> next item transitions are counted inside chunks of a history and from a
    chunk's last item to the first of the user's next chunk, so a hot user is spread
    over its chunks; the top ``k`` successors per item by count then
    SID are proposed for each ``last_items`` row ``(sample_id, sid)``.
    ``chunk`` names a column of ``train_seqs`` that never falls along a history (default: chunks of
    ``CHUNK_SIZE`` positions); positions may have gaps.
    Returns candidates ``(sample_id, think_idx, beam_idx, text, pred_sid, score)``
    that the evaluation jobs take as they are.
    """
    at = F.coalesce(F.col("pos").cast("bigint"), F.lit(-(1 << 63)))  # null positions come first
    part = F.floor(at / CHUNK_SIZE) if chunk is None else F.col(chunk)
    rows = train_seqs.where(F.col("user_id").isNotNull()).select("user_id", part.alias("_chunk"), at.alias("at"), "sid")
    order = Window.partitionBy("user_id", "_chunk").orderBy("at", "sid")
    near = rows.withColumns({"dst": F.lead("sid").over(order), "_next": F.lead("at").over(order),
                             "_prev": F.lag("at").over(order)})
    inside = near.where(F.col("_next").isNotNull()).select(F.col("sid").alias("src"), "dst")
    # the first and last rows of chunks: behind a last one comes the first of the user's next chunk
    ends = near.where(F.col("_next").isNull() | F.col("_prev").isNull())
    along = Window.partitionBy("user_id").orderBy("_chunk", "at", "sid", F.col("_prev").isNotNull())
    across = (ends.withColumns({"dst": F.lead("sid").over(along), "_after": F.lead("at").over(along)})
              .where(F.col("_next").isNull() & F.col("_after").isNotNull()).select(F.col("sid").alias("src"), "dst"))
    pairs = inside.unionAll(across).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("src").orderBy(F.col("cnt").desc(), F.col("dst"))
    top = (pairs.withColumn("beam_idx", (F.row_number().over(w) - 1).cast("int"))
           .where(F.col("beam_idx") < k))
    return (last_items.select("sample_id", F.col("sid").alias("src")).join(top, "src")
            .select("sample_id", F.lit(0).alias("think_idx"), "beam_idx", F.col("dst").alias("text"),
                    F.col("dst").alias("pred_sid"),
                    F.col("cnt").cast("double").alias("score")))
