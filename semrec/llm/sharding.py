"""Sharding: a reproducible shuffle with computable shard and slot.

Every row gets a dense global row number, a keyed Feistel permutation of
``[0, N)`` moves it, and the permuted number gives shard (remainder) and slot
(quotient), so the shard sizes differ by at most one row.  Any single row's
place is computable from its number, ``N`` and the seed alone.

DataFrame functions only.  Equal rows are counted before the shuffle and
expanded afterwards, so a row repeated very often is one row in every
exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
#: Copies of one row that a task writes out together.
SPAN = 8192
ROUNDS = 6
MAX_WALK = 64
_PRIME = 2147483647


def _round_keys(seed: int, rounds: int) -> list[int]:
    keys, x = [], (seed * 2654435761 + 97) % _PRIME
    for _ in range(rounds):
        x = (x * 48271 + 11) % _PRIME
        keys.append(x)
    return keys


def _mix(v: Column, key: Column) -> Column:
    """Keyed cubic hash modulo a 31-bit prime; products stay under 2^62."""
    x = (v + key) % _PRIME
    return ((x * x) % _PRIME * x + key) % _PRIME


def _feistel(x: Column, a: Column, b: Column, seed: int, rounds: int) -> Column:
    """One keyed permutation of ``[0, a*b)``: left half modulo ``a``, right modulo ``b``."""
    steps = F.array(*[F.struct(F.lit(i % 2).alias("side"), F.lit(k).cast("bigint").alias("key"))
                      for i, k in enumerate(_round_keys(seed, rounds))])
    start = F.struct((x % a).alias("l"), F.floor(x / a).cast("bigint").alias("r"))

    def step(acc: Column, s: Column) -> Column:
        left = (acc["l"] + _mix(acc["r"], s["key"])) % a
        right = (acc["r"] + _mix(acc["l"], s["key"])) % b
        return F.struct(F.when(s["side"] == 0, left).otherwise(acc["l"]).alias("l"),
                        F.when(s["side"] == 1, right).otherwise(acc["r"]).alias("r"))

    return F.aggregate(steps, start, step, lambda acc: acc["l"] + acc["r"] * a)


def permuted(x: Column, n: Column, seed: int = 0, rounds: int = ROUNDS) -> Column:
    """Bijection of ``[0, n)``: Feistel over the smallest ``a*b >= n`` with
    ``a = ceil(sqrt(n))``, walked along its cycle until it is below ``n``.

    Fewer than ``a`` of the ``a*b`` values lie outside, so a step leaves the
    range with probability under ``1/sqrt(n)``.  A walk over ``MAX_WALK`` steps
    raises an error; it never returns a wrong number.
    """
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(n))).cast("bigint")
    b = F.greatest(F.lit(1), F.ceil(n / a)).cast("bigint")
    once = _feistel(x, a, b, seed, rounds)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(MAX_WALK)), once,
                         lambda acc, _: F.when(acc < n, acc).otherwise(
                             _feistel(acc, a, b, seed, rounds)))
    return F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("bigint"))


def row_numbers(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``df`` plus ``row_no`` (dense from 0) and ``n_rows``.

    Distinct rows are counted with map-side combine, dealt to ``buckets`` by a
    hash of all columns, numbered inside a bucket by a running sum of counts,
    and shifted by the bucket's offset (one row per bucket, broadcast).  Equal
    rows get consecutive numbers and are written out by several tasks.  The result
    depends on the rows only, not on the layout of the input.  Columns must be comparable (no maps).
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    counted = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__b", F.pmod(F.xxhash64(*cols), F.lit(buckets))))
    before = Window.partitionBy("__b").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    inside = counted.withColumn("__at", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    sizes = counted.groupBy("__b").agg(F.sum("__n").alias("__size"))  # at most `buckets` rows
    running = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sizes.withColumn("__base", F.coalesce(F.sum("__size").over(running), F.lit(0)))
               .withColumn("n_rows", F.sum("__size").over(Window.partitionBy()))
               .drop("__size"))
    # a row repeated very often is cut into spans of copies, which are dealt before they are written out
    spans = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / SPAN))
    dealt = (inside.join(F.broadcast(offsets), "__b").withColumn("__span", F.explode(spans))
             .repartition("__b", "__at", "__span"))
    first = F.col("__span") * SPAN
    copies = F.sequence(first, F.least(first + SPAN, F.col("__n")) - 1)
    return (dealt.withColumn("__copy", F.explode(copies))
            .withColumn("row_no", F.col("__base") + F.col("__at") + F.col("__copy"))
            .drop("__b", "__n", "__at", "__base", "__copy", "__span"))


def assign_shards(df: DataFrame, n_shards: int, seed: int = 0, rounds: int = ROUNDS,
                  buckets: int = BUCKETS) -> DataFrame:
    """``df`` plus ``shard`` (0 .. n_shards-1) and ``slot`` (gapless from 0).

    Counts per shard differ by at most one.  Null values are ordinary values,
    repeated rows keep one place each, an empty frame gives an empty one; texts are
    compared whole.  Input columns named ``shard``, ``slot``, ``row_no`` or ``n_rows`` are
    replaced; names that start with ``__`` are reserved.
    """
    base = df.drop("shard", "slot", "row_no", "n_rows")
    numbered = row_numbers(base, buckets)
    p = permuted(F.col("row_no"), F.col("n_rows"), seed, rounds)
    return (numbered.withColumn("__p", p)
            .withColumn("shard", (F.col("__p") % n_shards).cast("int"))
            .withColumn("slot", F.floor(F.col("__p") / n_shards).cast("bigint"))
            .drop("__p", "row_no", "n_rows"))
