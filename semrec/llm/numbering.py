"""Dense positions inside groups of any size, numbered in ranges of the order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..session import sized_broadcast
from .common import frozen, python_ready


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append each row's place in its run of equal group names (the first column)."""
    last, seen = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        group = b.column(0)
        change = np.r_[group[0].as_py() != last,
                       pc.not_equal(group[1:], group[:-1]).to_numpy(zero_copy_only=False)].astype(bool)
        at = np.arange(b.num_rows)
        first = np.maximum.accumulate(np.where(change, at, -1))
        place = np.where(first < 0, at + seen, at - first)
        last, seen = group[-1].as_py(), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.int64())],
                                         names=[*b.schema.names, "__place"])


def numbered(df: DataFrame, group: str, order: list[str | Column], out: str = "pos") -> DataFrame:
    """``df`` with ``out`` = 0, 1, ... inside each ``group`` (a string column without nulls) in
    ``order`` (nulls first), written once.

    Rows are dealt by ranges of ``(group, order)``, so a group of any size is spread over tasks; a
    task counts its rows per group while it streams them.  Only a group that began in an
    earlier range has an offset there, so the table of offsets has at most one row a range.
    Rows that are equal in ``order`` are dealt over ranges too, and keep the numbers they were
    written with.
    """
    names = [group] + [c for c in df.columns if c != group]
    # the last key only cuts runs of equal rows, which may be any of each other
    keys = [F.col(c) if isinstance(c, str) else c for c in order] + [F.col("__tie")]
    ranged = (df.select(*names, F.monotonically_increasing_id().alias("__tie")).repartitionByRange(F.col(group), *keys)
              .sortWithinPartitions(F.col(group), *keys)
              .select(*names, F.spark_partition_id().alias("__range")))
    schema = StructType(list(ranged.schema.fields)).add("__place", LongType())
    rows = frozen(python_ready(ranged).mapInArrow(_count_runs, schema))
    sizes = rows.groupBy(F.col(group).alias("__g"), F.col("__range").alias("__r")).agg(
        F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = frozen(sizes.select("__g", "__r", F.sum("__n").over(before).alias("__off"))
                     .where("__off is not null"))
    return (rows.join(sized_broadcast(offsets), (F.col(group) == F.col("__g")) & (F.col("__range") == F.col("__r")),
                      "left")
            .select(*names, (F.col("__place") + F.coalesce("__off", F.lit(0))).alias(out)))
