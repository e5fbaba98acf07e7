"""Order-preserving per-group building blocks that stay safe under key skew.

A single user (or sample) may own a large share of all rows.  Nothing here
collects a whole group into one array:

* ``positions``       dense 1..n order index per group, numbered per slice of the
                      order (a hot group spans many slices and tasks);
* ``ordered_concat``  joins a group's values in order in two levels: fixed-size
                      chunks of ``chunk_size`` rows are assembled in parallel
                      tasks, then only the chunk strings are joined;
* ``last_k``          the last ``k`` rows per group; Spark plans the
                      ``row_number() <= k`` filter as a WindowGroupLimit, so each
                      map task keeps at most ``k`` rows per group before the
                      shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import input_size, shared

CHUNK_SIZE = 512
#: Characters of a part of a long text.
PART_CHARS = 1 << 20
#: Positions of a group that meet one copy of its cuts.
SPAN = 8192
#: Input bytes of a slice of an order, fewest and most slices, and keys sampled for each.  The most is
#: what one row of bounds and the table of counts may hold; slices then grow in length.
SLICE_BYTES, MIN_SLICES, MAX_SLICES, SAMPLED = 32 << 20, 16, 8192, 32


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def slices_of(df: DataFrame) -> int:
    """How many slices an order over ``df`` is cut into: grows with the size of its input tables."""
    return max(MIN_SLICES, min(MAX_SLICES, -(-input_size(df) // SLICE_BYTES)))


def order_bucket(df: DataFrame, cols: list[Column], slices: int | None = None, out: str = "_b") -> DataFrame:
    """Add ``out``, the number (0, 1, ...) of the slice of the order that a row falls into.

    The bounds are quantiles of the ``SAMPLED * slices`` keys with the smallest hashes, a
    scalar subquery of the plan: nothing runs while the plan is built, and since the sample is
    a function of the rows alone, every branch and every recomputed task finds the same bounds.
    A row finds its slice by binary search.
    """
    slices = slices or slices_of(df)
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])
    drawn = (df.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(SAMPLED * slices)
             .agg(F.sort_array(F.collect_list("k")).alias("ks")))
    step = F.ceil(F.size("ks") / slices).cast("int")
    bounds = drawn.select(F.filter("ks", lambda k, i: (i > 0) & (i % step == 0)).alias("b")).scalar()
    strides = F.array(*[F.lit(1 << i) for i in reversed(range(slices.bit_length()))])
    at = F.aggregate(strides, F.lit(0), lambda at, stride: F.when(
        F.get("_bounds", at + stride - 1) <= key, at + stride).otherwise(at))
    return df.withColumn("_bounds", bounds).withColumn(out, at).drop("_bounds")


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              out: str = "pos", skew_safe: bool = True, bucket: Column | None = None) -> DataFrame:
    """Add ``out`` = 1-based rank of each row within ``keys`` by ``order`` (ascending, nulls first).

    ``order`` must be unique within a group (callers add a tie-breaker).  Rows with
    null keys form groups like any other.

    ``skew_safe`` (default): rows are counted per ``(keys, bucket)`` with map-side
    combine, where ``bucket`` is a coarse function of the order (default:
    :func:`order_bucket`); a running count over that small table gives each
    bucket's offset, a row of its own at the bucket's head, and a window numbers the rows
    behind it, so a hot group is spread over its buckets.  Otherwise a plain ``row_number`` window,
    which sorts each group in one task.
    """
    keys, cols = list(keys), _cols(order)
    if not skew_safe:
        w = Window.partitionBy(*keys).orderBy(*cols)
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    df = shared(df)
    s = order_bucket(df, cols) if bucket is None else df.withColumn("_b", bucket)
    before = (Window.partitionBy(*keys).orderBy("_b")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (s.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
              .select(*keys, "_b", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")))
    # a bucket's offset goes ahead of its rows: they move once, where a join on keys that may be null moves them again
    both = s.withColumn("_off", F.lit(None).cast("bigint")).unionByName(starts, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_b").orderBy(F.col("_off").isNull(), *cols)
    first = F.first("_off").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (both.withColumns({"_in": F.row_number().over(inside), "_first": first}).where(F.col("_off").isNull())
            .withColumn(out, (F.col("_first") + F.col("_in") - 1).cast("bigint"))
            .drop("_b", "_in", "_off", "_first"))


def last_k(df: DataFrame, keys: Sequence[str], order_col: str, k: int,
           out: str = "rr") -> DataFrame:
    """Rows whose reverse rank by ``order_col`` is <= k, with that rank in ``out``."""
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def before_cut(rows: DataFrame, cuts: DataFrame, pos: str, cut: str = "cut", span: int = SPAN,
               key: str = "user_id") -> DataFrame:
    """Rows of ``rows`` joined with every row of ``cuts`` of the same ``key`` whose ``cut`` lies behind
    ``pos`` (both at least 0).

    Few ``cuts`` per key meet many ``rows``.  Rows join on ``(key, pos div span)`` and each cut is copied once for
    every span that begins before it, so a hot key's rows are dealt over its spans however the
    join is planned, and no span is met by a cut it lies behind.
    """
    spans = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(cut) - 1) / span))
    copies = cuts.where(F.col(cut) > 0).withColumn("_span", F.explode(spans))
    return (rows.withColumn("_span", F.floor(F.col(pos) / span)).join(copies, [key, "_span"])
            .where(F.col(pos) < F.col(cut)).drop("_span"))


def ordered_concat(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
                   sep: str, out: str, count_out: str | None = None,
                   chunk_size: int = CHUNK_SIZE, tail: int = 0, tail_cols: Sequence[str] = (),
                   values_out: str | None = None) -> DataFrame:
    """Per group: ``value_col`` joined by ``sep`` in ``order_col`` order (null values are left out).

    ``order_col`` is an integer position.  Rows are first grouped into
    ``(keys, order div chunk_size)`` chunks, so a hot group is spread over
    many tasks; the second level only joins chunk strings.  ``count_out`` counts the rows, ``values_out``
    those with a value.  ``tail`` adds an array ``tail`` of the last so many rows as
    ``struct<pos, value, tail_cols...>``; a chunk hands on no more than that.
    """
    keys = list(keys)
    cells = [F.col(c).alias(f"_t{i}") for i, c in enumerate(tail_cols)]
    chunked = (df.select(*keys, F.col(order_col).alias("_o"), F.col(value_col).alias("_v"), *cells)
               .withColumn("_chunk", F.floor(F.col("_o") / chunk_size))
               # its own exchange: an input dealt by ``keys`` alone would keep a hot group in one task
               .repartition(*keys, "_chunk"))

    def last(rows: Column) -> Column:
        return F.when(F.size(rows) > tail, F.slice(rows, -tail, tail)).otherwise(rows)

    row = F.struct(F.col("_o").alias("pos"), F.col("_v").alias("value"),
                   *[F.col(f"_t{i}").alias(c) for i, c in enumerate(tail_cols)])
    level1 = chunked.groupBy(*keys, "_chunk").agg(
        F.array_sort(F.collect_list(row)).alias("_rows"), F.count(F.lit(1)).alias("_n"), F.count("_v").alias("_nv"))
    kept = [last(F.col("_rows")).alias("_tail")] if tail else []
    level1 = level1.select(*keys, "_chunk", "_n", "_nv", F.array_join(
        F.transform("_rows", lambda x: x["value"]), sep).alias("_part"), *kept)
    part = F.when(F.col("_nv") > 0, F.col("_part"))  # a chunk without values adds no separator
    aggs = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", part.alias("p")))),
                                     lambda x: x["p"]), sep).alias(out)]
    if count_out:
        aggs.append(F.sum("_n").alias(count_out))
    if values_out:
        aggs.append(F.sum("_nv").alias(values_out))
    if tail:
        ends = F.array_sort(F.collect_list(F.struct("_chunk", "_tail")))
        aggs.append(last(F.flatten(F.transform(ends, lambda x: x["_tail"]))).alias("tail"))
    return level1.groupBy(*keys).agg(*aggs)


def ordered_parts(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str, sep: str,
                  max_chars: int = PART_CHARS, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Long form of :func:`ordered_concat`: ``(keys, part_no, part)``; the parts of a group in order, joined
    by ``sep``, are its whole text.

    A value belongs to the part that its start in the whole text falls into (running length
    ``div max_chars``), so a part is at most ``max_chars`` and its last value long, whatever the size of the
    group, and numbers may be skipped behind a value longer than that.  Running lengths are
    summed inside chunks of the order and over the chunks, so no task needs a whole group.
    """
    rows = _part_rows(df, keys, order_col, value_col, sep, max_chars, chunk_size)
    return rows.select(*keys, "part_no", F.array_join(F.transform("_rows", lambda x: x["_v"]), sep).alias("part"))


def _part_rows(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str, sep: str, max_chars: int,
               chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """``(keys, part_no, _rows)``: the values ``struct<_o, _v>`` of each part in order."""
    keys = list(keys)
    d = (df.select(*keys, F.col(order_col).alias("_o"), F.col(value_col).alias("_v"))
         .withColumn("_chunk", F.floor(F.col("_o") / chunk_size))
         .withColumn("_len", F.length("_v") + len(sep)))
    d = shared(d)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (d.groupBy(*keys, "_chunk").agg(F.sum("_len").alias("_n"))
              .withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_off") + F.coalesce(F.sum("_len").over(inside), F.lit(0))
    placed = (d.join(starts, [*keys, "_chunk"]).withColumn("part_no", F.floor(at / max_chars))
              .repartition(*keys, "part_no"))
    return placed.groupBy(*keys, "part_no").agg(F.array_sort(F.collect_list(F.struct("_o", "_v"))).alias("_rows"))


def parts_before_cuts(df: DataFrame, cuts: DataFrame, order_col: str, value_col: str, sep: str,
                      max_chars: int = PART_CHARS, key: str = "user_id") -> DataFrame:
    """:func:`ordered_parts` of the values in front of every cut ``(key, split, cut)``: ``(split, key, part_no, part)``.

    What stands in front of a value is the same for every cut behind it, so values are placed once, and
    only whole parts meet the cuts; the part that a cut falls into loses the values from there on.
    """
    rows = _part_rows(df, [key], order_col, value_col, sep, max_chars)
    met = before_cut(rows.withColumn("_first", F.get("_rows", F.lit(0))["_o"]), cuts.select(key, "split", "cut"),
                     "_first", key=key)
    kept = F.filter("_rows", lambda x: x["_o"] < F.col("cut"))
    return met.select("split", key, "part_no", F.array_join(F.transform(kept, lambda x: x["_v"]), sep).alias("part"))


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "rn",
                      total_out: str | None = None) -> DataFrame:
    """Dense 1..N row number in ``order`` without a single-partition window over rows.

    Rows are counted per :func:`order_bucket`; a running sum over that table (at most
    ``MAX_SLICES`` rows) gives each slice's offset, a window per slice the rest.
    ``order`` must be unique.  ``total_out`` adds the total row count from the same
    small table.  A computed input is read three times and therefore :func:`..session.shared`.
    """
    cols, slices = _cols(order), slices_of(df)
    df = shared(df)
    s = order_bucket(df, cols, slices)
    sizes = s.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    if total_out:
        starts = starts.withColumn(total_out, F.sum("_cnt").over(Window.partitionBy()))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(*cols))
    return (s.withColumn("_in", inside).join(F.broadcast(starts.drop("_cnt")), "_b")
            .withColumn(out, (F.col("_off") + F.col("_in")).cast("bigint"))
            .drop("_b", "_in", "_off"))
