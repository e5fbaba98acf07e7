"""Readers for the reference's file formats.

Each returns a DataFrame; parsing happens in Column expressions so files
split across tasks (except where a format is inherently one object per file,
noted below).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.sid import py_strip
from ..operators.ordered import global_row_number
from .structure import numbered_lines, object_entries, quoted_records

CATALOG_FIELDS = ["title", "description", "categories", "sid"]
_CATALOG_STRUCT = "struct<" + ",".join(f"{f}:string" for f in CATALOG_FIELDS) + ">"


# ------------------------------------------------------------- sequences ---

def parse_sequence_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """A1 parsing: trim, skip blank lines, split on any (Unicode) whitespace,
    drop lines with <= 1 token; first token is the user, the rest the items
    in order.  Returns long form ``(line_id, user_id, pos, item_id)``.

    ``line_id`` keeps two lines of the same user apart, as the reference does; lines that come
    without one are numbered as they are read.
    """
    toks = F.split(py_strip(col), r"(?U)\s+")
    line = F.col("line_id") if "line_id" in lines.columns else F.monotonically_increasing_id()
    t = lines.select(line.alias("line_id"), toks.alias("toks")).where(F.size("toks") > 1)
    return t.select("line_id", F.col("toks")[0].alias("user_id"),
                    F.posexplode(F.slice("toks", 2, F.size("toks") - 1)).alias("pos", "item_id")) \
        .withColumn("pos", (F.col("pos") + 1).cast("bigint"))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """A1: sequence text file(s) ``user item item ...`` -> long form.  ``line_id`` is the file and the line's
    number in it, whatever splits Spark reads."""
    lines = numbered_lines(spark, path)
    return parse_sequence_lines(lines.select(F.concat_ws("#", "file", "line_no").alias("line_id"), "value"))


# ------------------------------------------------------------- catalogue ---

def parse_catalog_json(lines: DataFrame, col: str = "value") -> DataFrame:
    """A2 parsing: JSON objects keyed by item id -> one row per item.

    A value that is an empty object (or has no known field) counts as
    missing, as in the reference.  Absent fields stay null.
    """
    m = F.from_json(F.col(col), f"map<string,{_CATALOG_STRUCT}>")
    e = lines.select(F.explode(m).alias("item_id", "info"))
    return (e.where(F.col("info").isNotNull())
            .where(F.greatest(*[F.col(f"info.{f}").isNotNull() for f in CATALOG_FIELDS]))
            .select("item_id", *[F.col(f"info.{f}").alias(f) for f in CATALOG_FIELDS]))


def read_item_catalog(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """A2: item catalogue JSON.

    The default layout is JSON lines (one or more ``{"id": {...}}`` objects per line).
    ``whole_file=True`` reads files that are one object each, indented or on one line; they are
    cut and read by many tasks too (:func:`.structure.object_entries`).
    """
    return parse_catalog_json(object_entries(spark, path) if whole_file else spark.read.text(path))


# -------------------------------------------------------------- eval set ---

def eval_set(df: DataFrame, key: str | None = None) -> DataFrame:
    """A3 checks: ``description`` and ``groundtruth`` are required; a missing
    ``user_id`` becomes ``user_{idx}`` (row index in ``key`` order).  Without ``key`` the rows go by file
    and by their place in it, for a frame that reads Parquet files; it does not depend on splits."""
    missing = [c for c in ("description", "groundtruth") if c not in df.columns]
    if missing:
        raise ValueError(f"eval set lacks required columns: {missing}")
    keys = [key]
    if key is None:
        df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        keys = ["_file", "_row"]
    idx = global_row_number(df, keys, "_idx")
    uid = F.concat(F.lit("user_"), (F.col("_idx") - 1).cast("string"))
    if "user_id" in df.columns:
        uid = F.coalesce(F.col("user_id").cast("string"), uid)
    return idx.withColumn("user_id", uid).drop("_idx", "_file", "_row")


def read_eval_set(spark: SparkSession, path: str) -> DataFrame:
    """A3: parquet eval set with the checks of :func:`eval_set`."""
    return eval_set(spark.read.parquet(path))


# ------------------------------------------------------------------- TSV ---

def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip a UTF-8 BOM and any ``table.`` prefix from column names."""
    return df.toDF(*[c.replace("\ufeff", "").split(".")[-1] for c in df.columns])


#: What a TSV field holds in place of characters that would end it.
TSV_ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def unescape_tsv(c: str):
    """Characters back from their escapes; ``\\\\`` first becomes a mark no text holds."""
    out = F.replace(F.col(c), F.lit("\\\\"), F.lit("\ufdd0"))
    for plain, escaped in TSV_ESCAPES[1:]:
        out = F.replace(out, F.lit(escaped), F.lit(plain))
    return F.replace(out, F.lit("\ufdd0"), F.lit("\\"))


def read_behavior_tsv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Tab-separated behaviour log with a header (all columns as strings).

    One record is one line (line feeds, tabs and backslashes inside a field are
    escaped, as :func:`..writers.write_behavior_tsv` does).  ``multi_line=True`` reads the
    quoted form with line feeds inside fields instead (quotes inside are doubled); its
    files are cut and read by many tasks too (:func:`.structure.quoted_records`).
    """
    reader = (spark.read.option("sep", "\t").option("header", True).option("encoding", "UTF-8")
              .option("maxCharsPerColumn", -1))
    if multi_line:
        # Spark reads the header of one file for the names; records are cut and parsed in splits
        names = reader.option("multiLine", True).option("escape", '"').csv(path).columns
        records = quoted_records(spark, path).where((F.col("record_no") > 0) & (F.col("value") != ""))
        kind = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))]).simpleString()
        fields = F.from_csv("value", kind, {"sep": "\t", "escape": '"', "maxCharsPerColumn": "-1"})
        return clean_column_names(records.select(fields.alias("r")).select("r.*").toDF(*names))
    df = clean_column_names(reader.option("quote", "").option("escape", "\x00").csv(path))
    return df.select(*[unescape_tsv(c).alias(c) for c in df.columns])


# ------------------------------------------------------------ metric logs ---

# Banners of the evaluation logs being parsed.
DIRECT_MARKER = "🎯 Final Hit Rate Results:"
COT_MARKER = "🎯 Final CoT Hit Rate Results:"
RULE = "=" * 60


def _number_after(label: str, gap: str, number: str) -> str:
    """Pattern of ``label: number``, found at the label wherever a line holds it."""
    return rf"\Q{label}\E:{gap}({number})"


def _first(text: Column, pattern: str, kind: str) -> Column:
    """First number that ``pattern`` finds in ``text``, null without one."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast(kind)


def _direct_results(content: Column, metrics: Sequence[str]) -> tuple[Column, Column, list[Column]]:
    """``(has results, sample count, metric values)``: the text between the two rules behind the banner
    decides; of each metric the first number counts."""
    behind = F.split(F.element_at(F.split(content, DIRECT_MARKER, 2), -1), RULE, 3)
    complete = F.contains(content, F.lit(DIRECT_MARKER)) & (F.size(behind) == 3)
    n = _first(content, _number_after("Total samples", " ", r"\d+"), "bigint")
    values = [_first(F.get(behind, F.lit(1)), _number_after(m, r"\s+", r"[\d.]+"), "double") for m in metrics]
    return complete & n.isNotNull(), n, values


def _cot_results(content: Column, metrics: Sequence[str],
                 default_samples: int | None) -> tuple[Column, Column, list[Column]]:
    """As :func:`_direct_results`: every line behind the last banner gives one metric, the first of
    ``metrics`` that it names, by the last number behind that name; later lines win."""
    lines = F.split(F.substring_index(content, COT_MARKER, -1), "\n")
    names = [".*" + _number_after(m, r"\s*", r"[0-9]*\.?[0-9]+") for m in metrics]

    def value(i: int) -> Column:
        def decides(line: Column) -> Column:
            own = line.rlike(names[i])
            for earlier in names[:i]:
                own = own & ~line.rlike(earlier)
            return own
        return _first(F.try_element_at(F.filter(lines, decides), F.lit(-1)), names[i], "double")

    values = [value(i) for i in range(len(names))]
    counts = ["(?i)" + _number_after("Total samples", r"\s*", r"\d+"),
              "(?i)" + _number_after("Test data size", r"\s*", r"\d+"), r"(?i)samples.*?(\d+)"]
    stated = F.coalesce(*[_first(content, p, "bigint") for p in counts])
    n = F.when(stated > 0, stated).otherwise(F.lit(default_samples).cast("bigint"))
    some = F.coalesce(*values).isNotNull()
    return F.contains(content, F.lit(COT_MARKER)) & some, n, values


def parse_metric_logs(spark: SparkSession, path: str, metrics: Sequence[str],
                      mode: str = "direct", default_samples: int | None = None) -> DataFrame:
    """A10: per shard log -> ``(shard, found, metric, value, n)``.

    Labels are found at their number, whatever a logger wrote before them on the line (time stamp,
    level).  ``direct``: the metrics between the two rules after the results banner, and a
    ``Total samples`` count; a log that lacks either has no results.  ``cot``: the last value of each
    metric after the last CoT banner; the count is that of the first of ``Total samples``, ``Test data
    size`` and a number behind ``samples`` on one line that the log holds, else (or when it is 0)
    ``default_samples``.  A log without results yields one row with ``found = false``.  Logs are spread over
    tasks; each one is one record.
    """
    logs = (spark.read.text(path, wholetext=True)
            .select(F.regexp_extract(F.col("_metadata.file_name"), r"gpu_(\d+)\.log", 1).cast("int")
                    .alias("shard"), F.replace("value", F.lit("\r\n"), F.lit("\n")).alias("content")))
    if mode == "direct":
        found, n, values = _direct_results(F.col("content"), metrics)
    elif mode == "cot":
        found, n, values = _cot_results(F.col("content"), metrics, default_samples)
    else:
        raise ValueError(mode)
    rows = F.filter(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value"))
                              for m, v in zip(metrics, values)]), lambda r: r["value"].isNotNull())
    found = F.coalesce(found, F.lit(False))
    parsed = logs.select("shard", found.alias("found"), F.when(found, n).alias("n"),
                         F.when(found, rows).alias("rows"))
    return parsed.select("shard", "found", F.explode_outer("rows").alias("r"), "n").select(
        "shard", "found", "r.metric", "r.value", "n")


def read_shards(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """G1 from files: read each shard's parquet output and concatenate them in
    shard order (``shard`` = position in ``paths``).  A missing shard raises
    (the reference skipped it with a warning)."""
    from ..operators.metrics import merge_shards
    return merge_shards([spark.read.parquet(p) for p in paths])
