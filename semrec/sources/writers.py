"""Sinks for the reference's output formats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import ordered_concat
from .readers import CATALOG_FIELDS, TSV_ESCAPES


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: train/val/test as one parquet dataset partitioned by ``split``."""
    df.write.mode(mode).partitionBy("split").parquet(path)


#: Rows of a compressed file, which one task reads.
GZIP_ROWS = 50_000


def write_behavior_tsv(df: DataFrame, path: str, mode: str = "overwrite", quoted: bool = False,
                       compression: str | None = None) -> None:
    """Tab-separated with a header, no index; tabs, line ends and backslashes
    inside a field are escaped, so every record is one line and
    :func:`..readers.read_behavior_tsv` reads it back in parallel.  ``quoted``: fields are quoted instead
    (quotes inside doubled), and line ends stay as they are (``multi_line`` reads it).  ``compression`` such as
    ``gzip`` keeps long texts small on disk; files then hold at most ``GZIP_ROWS`` records, so that many tasks
    read them."""
    def writer(out: DataFrame):
        w = out.write.mode(mode)
        return w.option("compression", compression).option("maxRecordsPerFile", GZIP_ROWS) if compression else w

    if quoted:
        # texts that stand twice in a record shrink about as much at zlib's fastest level
        (writer(df).option("zlib.compress.level", "BEST_SPEED").option("sep", "\t").option("header", True).option("quoteAll", True)
         .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
        return

    def field(c: str):
        out = F.col(c).cast("string")
        for plain, escaped in TSV_ESCAPES:
            out = F.replace(out, F.lit(plain), F.lit(escaped))
        return out.alias(c)

    (writer(df.select(*[field(c) for c in df.columns])).option("sep", "\t")
     .option("header", True).option("quote", "").option("escape", "\x00")
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def sequence_lines(seq: DataFrame, items: str = "items") -> DataFrame:
    """A8 rows: ``user item item ...`` from ``(user_id, items)`` where
    ``items`` is already a space-joined string (see ``user_sequences``)."""
    return seq.select(F.concat_ws(" ", "user_id", items).alias("value"))


def write_sequences(seq_long: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One text line per user from long form ``(user_id, pos, item_id)``."""
    lines = ordered_concat(seq_long, ["user_id"], "pos", "item_id", " ", "items")
    sequence_lines(lines).write.mode(mode).text(path)


def catalog_json_lines(items: DataFrame) -> DataFrame:
    """A9 rows: one ``{"item_id": {title, description, categories, sid}}`` object
    per line (non-ASCII text is written as is)."""
    info = F.struct(*[F.col(c) for c in CATALOG_FIELDS])
    return items.select(F.to_json(F.create_map(F.col("item_id"), info)).alias("value"))


def write_catalog(items: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Keyed catalogue as JSON lines."""
    catalog_json_lines(items).write.mode(mode).text(path)


def write_behaviors(details: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Behaviour details (long form from ``user_behavior_details``) as JSON
    lines, one behaviour per line with its ``user_id`` and ``idx``; readers
    regroup by user.  One line per behaviour keeps a heavy user's history
    from becoming a single record."""
    details.write.mode(mode).json(path)
