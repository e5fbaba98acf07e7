"""Reading files whose records are not lines, in byte-range splits.

Spark cuts a text file at any record separator, so a task sees its split without
knowing what the text before it has opened.  Here every split is described by a few
numbers (records, quote parity, nesting), a running combination over the splits of a file
gives the state each one starts in, and records are then put together from their pieces:

* :func:`numbered_lines`   lines with their number in the file, the same however files are split;
* :func:`quoted_records`   records whose quoted fields hold line ends (quote parity);
* :func:`object_entries`   the members of one JSON object of any size (quote parity and depth).

Only tables with one row per split are combined; no file is read by one task.
"""

from __future__ import annotations

import functools
import posixpath
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package, sized_broadcast

_SPLIT = ["file", "split"]


def _in_split(to: int):
    """The pieces of a split up to the one ``to`` places away."""
    return Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, to)


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``(file, split, at, value)``: text between separators; ``at`` ascends inside a split."""
    return spark.read.text(path, lineSep=separator).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value")


def _before(column: str) -> Column:
    """Sum of ``column`` over the earlier splits of a file."""
    splits = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(splits), F.lit(0))


def _earlier(column: str) -> Column:
    """Sum of ``column`` over the earlier pieces of a split."""
    return F.coalesce(F.sum(column).over(_in_split(-1)), F.lit(0))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, value)``, lines counted from 0 in every file.

    A line's number is its place in its split (known at the scan, no shuffle) behind the lines of the
    earlier splits, so it depends on the file alone.
    """
    lines = _pieces(spark, path, "\n").withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    splits = (lines.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
              .select(*_SPLIT, (_before("n") - F.col("first")).alias("shift")))
    return lines.join(sized_broadcast(splits), _SPLIT).select(
        "file", (F.col("at") + F.col("shift")).alias("line_no"), "value")


def _quotes(value: Column) -> Column:
    return F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))


def _runs(files: pa.Array, splits: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the rows of one split in a batch, whose rows stand as they were read."""
    moved = splits[1:] != splits[:-1]
    if len(files) > 1:
        moved = moved | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(moved) + 1).tolist(), len(splits)]
    return zip(edges, edges[1:])


def _count_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split the parity of its quotes and the lines with an even and with an odd number of them in front."""
    at, odd, counts = None, 0, [0, 0]

    def row():
        return pa.RecordBatch.from_pydict({"file": [at[0]], "split": [at[1]], "odd": [odd], "n0": [counts[0]],
                                           "n1": [counts[1]]}, schema=_COUNTED)

    for batch in batches:
        files, splits = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        quotes = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in _runs(files, splits):
            here = (files[lo].as_py(), int(splits[lo]))
            if here != at:
                if at is not None:
                    yield row()
                at, odd, counts = here, 0, [0, 0]
            upto = odd + np.cumsum(quotes[lo:hi])
            n1 = int(((upto - quotes[lo:hi]) % 2).sum())
            counts[1] += n1
            counts[0] += hi - lo - n1
            odd = int(upto[-1] % 2)
    if at is not None:
        yield row()


_COUNTED = pa.schema([("file", pa.string()), ("split", pa.int64()), ("odd", pa.int64()), ("n0", pa.int64()),
                      ("n1", pa.int64())])
_RECORDS = pa.schema([("file", pa.string()), ("split", pa.int64()), ("record_no", pa.int64()), ("value", pa.string()),
                      ("whole", pa.bool_())])


def _records(file: str, split: int, numbers, values: pa.Array, whole) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array([split] * n, pa.int64()),
                                       pa.array(numbers, pa.int64()), values.cast(pa.string()),
                                       pa.array(whole, pa.bool_())], schema=_RECORDS)


def _put_together(batches: Iterator[pa.RecordBatch], whole_files: bool = False) -> Iterator[pa.RecordBatch]:
    """The records of every split from its lines.  The lines that end a record begun in an earlier split, and
    those of a record that goes on in the next one, are pieces of it (not ``whole``).  ``whole_files``: a split is
    a file, so none goes on."""
    at, odd, number, held, begun = None, 0, 0, [], False  # held: lines of the record that is still open

    def piece():
        return _records(*at, [number], pa.array(["\n".join(held)], pa.string()), [whole_files])

    for batch in batches:
        files, splits = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        quotes = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in _runs(files, splits):
            here = (files[lo].as_py(), int(splits[lo]))
            if here != at:
                if held:
                    yield piece()
                at, odd, held, begun = here, batch.column(4)[lo].as_py(), [], False
                number = batch.column(5)[lo].as_py() - 1
            upto = odd + np.cumsum(quotes[lo:hi])
            odd = int(upto[-1] % 2)
            values = batch.column(3)[lo:hi]
            starts = np.flatnonzero((upto - quotes[lo:hi]) % 2 == 0)
            if not len(starts):
                held += values.to_pylist()
                continue
            first = int(starts[0])
            held += values[:first].to_pylist()
            if held:  # complete: the next line starts another record
                yield _records(*at, [number], pa.array(["\n".join(held)], pa.string()), [begun])
            # the last record may go on behind these lines
            last = int(starts[-1]) if odd else hi - lo
            bounds = np.append(starts[:-1] if odd else starts, last)
            if len(bounds) > 1:
                # a record ends in front of the next start
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values.cast(pa.string()))
                n = len(bounds) - 1
                yield _records(*at, np.arange(number + 1, number + 1 + n), pc.binary_join(lists, "\n"), [True] * n)
            number += len(starts)
            held, begun = (values[last:].to_pylist(), True) if odd else ([], False)
    if held:
        yield piece()


_RECORD = "file string, split bigint, record_no bigint, value string, whole boolean"


def _cannot_be_cut(spark: SparkSession, path: str) -> bool:
    """Whether all files under ``path`` are compressed in a way that Spark reads from their start only."""
    compress, conf = spark._jvm.org.apache.hadoop.io.compress, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = compress.CompressionCodecFactory(conf)
    kinds = {posixpath.splitext(file)[1] for file in spark.read.text(path).inputFiles()}
    found = [codecs.getCodec(spark._jvm.org.apache.hadoop.fs.Path(f"/file{kind}")) for kind in kinds]
    cut = spark._jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    return bool(found) and all(codec is not None and not cut.isInstance(codec) for codec in found)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record_no, value)`` of files whose double-quoted fields may hold line ends (a quote inside
    is doubled).  Records are counted from 0 in every file; empty lines are records.

    A line starts a record when an even number of quotes stands before it in the file.  A first reading
    describes every split by the parity of its quotes and its number of records; in a second one
    each task puts the records of its splits together as it reads them.  Only records that lie in two
    splits or more are shuffled.  Compressed files that cannot be cut are read once, each by one task.
    """
    ship_package(spark)
    lines = _pieces(spark, path, "\n").withColumn("odd", (_quotes(F.col("value")) % 2).cast("bigint"))
    if _cannot_be_cut(spark, path):
        zero = F.lit(0).cast("bigint")
        files = lines.select(*_SPLIT, "odd", "value", zero.alias("turned"), zero.alias("earlier"))
        return _without_return(files.mapInArrow(functools.partial(_put_together, whole_files=True), _RECORD).select(
            "file", "record_no", "value"))
    splits = lines.select(*_SPLIT, "odd").mapInArrow(
        _count_records, "file string, split bigint, odd bigint, n0 bigint, n1 bigint")
    splits = splits.withColumn("turned", _before("odd") % 2)
    splits = splits.withColumn("n", F.when(F.col("turned") == 0, F.col("n0")).otherwise(F.col("n1")))
    splits = splits.select(*_SPLIT, "turned", _before("n").cast("bigint").alias("earlier"))
    # one row per split: as small as the list of splits that the driver plans the scan with
    placed = lines.join(F.broadcast(splits), _SPLIT).select(*_SPLIT, "odd", "value", "turned", "earlier")
    records = placed.mapInArrow(_put_together, _RECORD)
    single = records.where("whole").select("file", "record_no", "value")
    joined = _joined(records.where("not whole").withColumn("at", F.lit(0)), "record_no", "\n")
    return _without_return(single.unionByName(joined))


def _without_return(records: DataFrame) -> DataFrame:
    return records.withColumn("value", F.when(
        F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")))


def _joined(pieces: DataFrame, number: str, separator: str) -> DataFrame:
    """Pieces of one record put together; a cell holds one record."""
    values = F.array_sort(F.collect_list(F.struct("split", "at", "value")))
    return pieces.groupBy("file", number).agg(
        F.array_join(F.transform(values, lambda p: p["value"]), separator).alias("value"))


def _outside(value: Column, quoted: Column) -> Column:
    """``value`` without its strings; ``quoted``: it begins inside one."""
    text = F.concat(F.when(quoted, F.lit('"')).otherwise(F.lit("")), value)
    return F.regexp_replace(text, '"[^"]*("|\\z)', "")


def _nesting(value: Column, quoted: Column) -> Column:
    """How much deeper the text is after a piece and the brace that ends it."""
    rest = _outside(value, quoted)
    ends_inside = (quoted.cast("int") + _quotes(value)) % 2 == 1
    opened = F.length(rest) - F.length(F.replace(rest, F.lit("{"), F.lit("")))
    return opened - F.when(ends_inside, 0).otherwise(1)


def object_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(file, entry_no, value)``: the members of files that each hold one JSON object of objects, every
    ``value`` an object of its own with one member (or with members that are no objects in front of it).

    Files are cut at closing braces, also when they are one line.  A valid text escapes nothing but
    single characters inside strings, so no escape is cut; a piece's effect depends only on
    whether it begins inside a string, and both cases are described per split.
    """
    pieces = _pieces(spark, path, "}")
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = pieces.withColumn("odd", _quotes(bare) % 2).withColumn("inside", _earlier("odd") % 2 == 1)
    for turned in (0, 1):  # nesting when the split begins outside, inside a string
        quoted = F.col("inside") if turned == 0 else ~F.col("inside")
        pieces = pieces.withColumn(f"deeper{turned}", _nesting(bare, quoted))
    splits = pieces.groupBy(*_SPLIT).agg(*[F.sum(c).alias(c) for c in ("odd", "deeper0", "deeper1")])
    splits = splits.withColumn("turned", _before("odd") % 2)
    splits = splits.withColumn("deeper", F.when(F.col("turned") == 0, F.col("deeper0")).otherwise(F.col("deeper1")))
    splits = splits.select(*_SPLIT, "turned", _before("deeper").alias("depth"))

    placed = pieces.join(sized_broadcast(splits), _SPLIT)
    quoted = F.col("inside") != (F.col("turned") == 1)
    deeper = F.when(F.col("turned") == 0, F.col("deeper0")).otherwise(F.col("deeper1"))
    placed = (placed.withColumn("deeper", deeper)
              .withColumn("outside", (quoted.cast("int") + F.col("odd")) % 2 == 0)
              .withColumn("depth", F.col("depth") + F.sum("deeper").over(_in_split(0))))
    placed = placed.withColumn("ends", (F.col("outside") & (F.col("depth") == 1)).cast("int"))
    counts = placed.groupBy(*_SPLIT).agg(F.sum("ends").alias("ends")).select(
        *_SPLIT, _before("ends").alias("earlier"))
    numbered = (placed.join(sized_broadcast(counts), _SPLIT)
                .withColumn("entry_no", F.col("earlier") + _earlier("ends")))
    whole = _joined(numbered.select("file", "entry_no", "split", "at", "value"), "entry_no", "}")
    body = F.regexp_replace("value", r"\A[\s\x{FEFF}]*[{,]", "")
    return whole.select("file", "entry_no", F.concat(F.lit("{"), body, F.lit("}}")).alias("value"))
