"""Recommendation tables derived from the TPC-H-style test parquet.

The reference's own inputs (item catalogue, user sequences, behaviour log,
scored candidates) are not shipped, so every job here derives them from the
given tables with plain DataFrame code; the work grows with the tables.

* ``catalog``       part                 -> item_id, title, categories, description, sid
* ``interactions``  lineitem x orders    -> user_id, pos, item_id  (time ordered)
* ``behaviors``     events x documents   -> a raw behaviour log
* ``candidates``    interactions/catalog -> scored model outputs per sample
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ordered import positions
from ..session import ensure_parallelism, read_table, scratch_path, shared, sized_broadcast

_MEMO: dict[tuple[str, str, str], DataFrame] = {}


def _memo(fn):
    """One DataFrame per (application, data directory, table): DataFrames are
    immutable, and building a derived table's plan costs driver round trips
    every time a job asks for it again."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, fn.__name__)
        df = _MEMO.get(key)
        if df is None:
            df = _MEMO[key] = fn(spark, sf_dir)
        return df
    return wrapper


U2028 = "\u2028"
U2029 = "\u2029"


def _rows(spark: SparkSession, sf_dir: str, table: str) -> int:
    """Row count of a table, read once per application from the file footers (ids are dense)."""
    key = (spark.sparkContext.applicationId, sf_dir, f"rows of {table}")
    if key not in _COUNTS:
        _COUNTS[key] = max(1, read_table(spark, sf_dir, table).count())
    return _COUNTS[key]


_COUNTS: dict[tuple[str, str, str], int] = {}


def customer_number(user: str = "user_id"):
    """The customer key in a user or sample id such as ``12`` or ``12-3``."""
    return F.substring_index(user, "-", 1).cast("bigint")


def _last_code() -> Column:
    """The last of an item's three codes."""
    return (F.col("p_partkey") * 7 + F.col("p_size")) % 256


def _sid_text(p: Column, last: Column) -> Column:
    """The SID of item ``p`` with the last code ``last``."""
    return _sid_of_codes(p % 256, (F.floor(p / 256) % 256).cast("bigint"), last)


def _sid_of_codes(a: Column, b: Column, c: Column) -> Column:
    return F.concat(F.lit("<|sid_begin|><s_a_"), a.cast("string"), F.lit("><s_b_"), b.cast("string"),
                    F.lit("><s_c_"), c.cast("string"), F.lit("><|sid_end|>"))


#: One more than the largest number of :func:`_packed_sid` and a mark for an item without a SID.
_NO_SID = 1 << 27


def _packed_sid(p: Column, last: Column) -> Column:
    """The codes of :func:`_sid_text` in one number, nine bits each (a code lies between -255 and 255)."""
    codes = [p % 256, F.floor(p / 256) % 256, last]
    return functools.reduce(lambda n, c: n * 512 + c + 255, codes, F.lit(0).cast("bigint"))


def _unpacked_sid(packed: Column) -> Column:
    """The SID text of a number from :func:`_packed_sid`."""
    a, b, c = (((F.shiftright(packed, bits) % 512) - 255) for bits in (18, 9, 0))
    return _sid_of_codes(a, b, c)


@_memo
def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    sid = _sid_text(p, _last_code())
    return (read_table(spark, sf_dir, "part")
            .where(p % 17 != 0)
            .select(p.cast("string").alias("item_id"),
                    F.when(p % 23 == 0, F.lit("")).otherwise(F.col("p_name")).alias("title"),
                    F.concat(F.col("p_type"), F.lit(" > "), F.col("p_brand")).alias("categories"),
                    F.concat(F.lit("about "), F.col("p_name")).alias("description"),
                    F.when(p % 19 == 0, F.lit(None).cast("string")).otherwise(sid).alias("sid"),
                    p.alias("p_partkey")))


@_memo
def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-ordered purchases per customer.  Every third customer's history is cut
    into several short users (``custkey-block``), so every split threshold is
    exercised and no row is lost."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = positions(li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey"), ["o_custkey"],
                  ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], "at",
                  bucket=F.year("l_shipdate"))
    c, at = F.col("o_custkey"), F.col("at") - 1
    size, short = c % 7 + 1, c % 3 == 0
    block = F.floor(at / size).cast("string")
    return j.select(
        F.when(short, F.concat_ws("-", c.cast("string"), block)).otherwise(c.cast("string"))
        .alias("user_id"),
        F.when(short, at % size + 1).otherwise(F.col("at")).cast("bigint").alias("pos"),
        F.col("l_partkey").cast("string").alias("item_id"), "o_custkey", "l_partkey")


def _log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw behaviour log but for its two long texts; ``doc_ref`` is the document they come from."""
    e = ensure_parallelism(read_table(spark, sf_dir, "events"))
    n_docs = _rows(spark, sf_dir, "documents")
    eid = F.col("event_id")
    et = F.col("event_type")
    doc = (eid * 13) % n_docs
    item = doc.cast("string")
    subtype = (F.when(eid % 8 == 0, "LIKE").when(eid % 8 == 1, "UNLIKE").when(eid % 8 == 2, "COMMENT")
               .when(eid % 8 == 3, "SHARE").when(eid % 8 == 4, "SAME_STYLE").when(eid % 8 == 5, "REPORT")
               .when(eid % 8 == 6, "LARGE").otherwise("NONE"))
    btype = (F.when(et == "purchase", "PRODUCE").when(eid % 5 == 0, "VIDEO_PLAY_FINISH")
             .when(eid % 5 == 1, "LONG_PLAY").when(eid % 5 == 2, "SHORT_PLAY").otherwise("OPERATE"))
    etype = (F.when(et == "purchase", "PRODUCE").when(et == "signup", "SEARCH")
             .when(et == "error", F.lit(None).cast("string")).otherwise("RECOMMEND"))
    played = F.when(eid % 29 == 0, "n/a").otherwise(
        (F.get_json_object(F.col("props"), "$.k").cast("int") % 11).cast("string"))
    extra = F.concat(F.lit('{"played_dur":"'), played, F.lit('","element_action":"'),
                     F.when(eid % 2 == 0, "FANC_CARD").otherwise("OTHER"),
                     F.lit('","query_cnt":'), (eid % 9).cast("string"), F.lit("}"))
    semantic = (F.when(eid % 53 == 0, F.lit(None).cast("string"))
                .when(eid % 31 == 0, "").when(eid % 37 == 0, "[1,").when(eid % 43 == 0, "[]")
                .when(eid % 59 == 0, "[1,2,3] x").when(eid % 61 == 0, "[1,2,3]]")
                .when(eid % 67 == 0, "[1,null]").when(eid % 71 == 0, "(1,2,3)")
                .when(eid % 73 == 0, "[1,2,]")
                .otherwise(F.concat(F.lit(" ["), (eid % 256).cast("string"), F.lit(","),
                                    (F.col("user_id") % 256).cast("string"), F.lit(","),
                                    item, F.lit("] "))))
    title = (F.when(eid % 4 == 0, F.lit("")).when(eid % 4 == 1, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Work "), item,
                                 F.when(eid % 10 == 2, F.lit("\rcut")).otherwise(F.lit("")))))
    query = F.when(et == "signup",
                   F.when(eid % 5 == 0, F.lit("")).when(eid % 5 == 1, F.lit(None).cast("string"))
                   .otherwise(F.concat(F.lit("query "), (eid % 7).cast("string"), F.lit(U2029))))
    content_type = (F.when(eid % 11 == 0, F.lit(None).cast("int")).when(eid % 11 == 10, F.lit(7))
                    .otherwise((eid % 3).cast("int")))
    photo_type = (F.when(eid % 13 == 0, F.lit(None).cast("int")).when(eid % 13 == 12, F.lit(5))
                  .otherwise((eid % 2 + 1).cast("int")))
    return e.select(
        F.col("user_id").cast("string").alias("user_id"),
        item.alias("item_id"),
        photo_type.alias("photo_type"),
        etype.alias("event_type"),
        btype.alias("behavior_type"),
        subtype.alias("behavior_subtype"),
        F.when(eid % 3 == 0, "App").otherwise("Web").alias("platform_type"),
        F.when(eid % 41 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts"))
        .alias("time_stamp"),
        content_type.alias("content_type"),
        title.alias("title"),
        query.alias("element_query_content"),
        extra.alias("extra_info"),
        semantic.alias("semantic_id"),
        F.date_format(F.col("ts"), "yyyyMMdd").alias("p_date"),
        eid.alias("event_id"),
        doc.alias("doc_ref"),
    )


BEHAVIOR_COLUMNS = ["user_id", "item_id", "photo_type", "event_type", "behavior_type", "behavior_subtype",
                    "platform_type", "time_stamp", "content_type", "prompt", "title", "introduction",
                    "element_query_content", "extra_info", "semantic_id", "p_date", "event_id"]


def _with_texts(rows: DataFrame, spark: SparkSession, sf_dir: str, whole: bool = True) -> DataFrame:
    """The raw behaviour log from :func:`_log_rows`: every row with the texts of its document; unless
    ``whole``, those are empty in place of the document's text.

    No broadcast hint: whole texts are many times their estimated size, and a broadcast goes
    through the driver.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    if not whole:
        docs = docs.withColumn("text", F.when(F.col("text").isNotNull(), F.lit("")))
    j = rows.join(docs, F.col("doc_id") == F.col("doc_ref"), "left")
    eid, text = F.col("event_id"), F.col("text")
    prompt = (F.when(eid % 47 == 0, F.lit(None).cast("string"))
              .when(eid % 5 == 4, F.concat(text, F.lit("\r"), F.lit("tail")))
              .otherwise(text))
    intro = (F.when(eid % 6 == 0, F.lit(None).cast("string")).when(eid % 6 == 3, F.lit(""))
             .otherwise(F.concat(text, F.lit(U2028), F.lit("intro"))))
    return j.withColumns({"prompt": prompt, "introduction": intro}).select(*BEHAVIOR_COLUMNS)


@_memo
def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw behaviour log with every awkward case of the real one: null event
    types, empty/malformed/``[]``/null semantic ids, null timestamps,
    non-numeric durations, null prompts, CR and U+2028/U+2029 in text."""
    return _with_texts(_log_rows(spark, sf_dir), spark, sf_dir)


@_memo
def behavior_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`behaviors` for readers that ask no more of ``prompt`` and ``introduction`` than whether
    they are null: documents' texts are left out, so none is moved."""
    return _with_texts(_log_rows(spark, sf_dir), spark, sf_dir, whole=False)


_PATHS: dict[tuple[str, str], str] = {}


def behavior_path(spark: SparkSession, sf_dir: str) -> str:
    """The rows of the behaviour log partitioned by ``p_date``, written once per application to the shared
    folder.  A text that many rows share stays in ``documents`` and is looked up when the log is
    read (:func:`behavior_rows`), so the copy on disk grows with the events and not with events times texts."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PATHS:
        path = scratch_path(spark, "log")
        _log_rows(spark, sf_dir).write.partitionBy("p_date").parquet(path)
        _PATHS[key] = path
    return _PATHS[key]


def behavior_schema(spark: SparkSession, sf_dir: str) -> StructType:
    """Columns of the files under :func:`behavior_path` (``p_date`` as text)."""
    return _log_rows(spark, sf_dir).schema


def behavior_rows(spark: SparkSession, sf_dir: str) -> Callable[[DataFrame], DataFrame]:
    """What turns rows read (or streamed) from :func:`behavior_path` into the raw log."""
    return lambda rows: _with_texts(rows, spark, sf_dir)


def behavior_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned raw log, read from :func:`behavior_path`."""
    rows = spark.read.schema(behavior_schema(spark, sf_dir)).parquet(behavior_path(spark, sf_dir))
    return behavior_rows(spark, sf_dir)(rows)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user with >= 2 resolvable purchases: the last one's SID.  One short row per user, computed once for
    all readers in a job."""
    return shared(_truth(spark, sf_dir))


@_memo
def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    inter = interactions(spark, sf_dir).select("user_id", "pos", "l_partkey")
    # a number moves and is aggregated in a hash table, its SID is written for the last purchase alone
    cat = (read_table(spark, sf_dir, "part").where((F.col("p_partkey") % 17 != 0) & (F.col("p_partkey") % 19 != 0))
           .select("p_partkey", (F.col("p_partkey") * 256 + _last_code()).alias("code"))
           .where(F.col("code").isNotNull()))
    j = inter.join(sized_broadcast(cat), F.col("l_partkey") == F.col("p_partkey"))
    last = j.groupBy("user_id").agg(F.max_by("code", "pos").alias("code"), F.count(F.lit(1)).alias("n"))
    return last.where(F.col("n") >= 2).select(
        F.col("user_id").alias("sample_id"), _sid_text(F.floor(F.col("code") / 256), F.col("code") % 256)
        .alias("groundtruth"))


def candidates(spark: SparkSession, sf_dir: str, details: DataFrame | None = None) -> DataFrame:
    """Five thinking samples x ten beams of scored outputs per sample (a tenth
    of the samples keep only four beams, every 29th customer's have none); scores tie,
    some texts hold no SID.

    With ``details`` (``sample_id`` and more columns) the outputs are those joined with it on ``sample_id``:
    it meets one row per sample, before its outputs are made."""
    t = truth(spark, sf_dir).withColumn("s", customer_number("sample_id")).where(F.col("s") % 29 != 0)
    s, ti, bi = F.col("s"), F.col("think_idx"), F.col("beam_idx")
    # what a customer's samples are offered is looked up once for all of them
    n_parts = _rows(spark, sf_dir, "part")
    grid = (read_table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("bigint").alias("s")).distinct()
            .where(s % 29 != 0)
            .withColumn("think_idx", F.explode(F.sequence(F.lit(0), F.lit(4))))
            .withColumn("beam_idx", F.explode(F.sequence(F.lit(0), F.lit(9))))
            .where((s % 10 != 0) | (bi < 4))
            .withColumn("lookup", (s * 37 + ti * 5 + bi * 3) % n_parts))
    p = F.col("p_partkey")
    cat = (read_table(spark, sf_dir, "part").where(p % 17 != 0)
           .select(p.alias("lookup"), F.when(p % 19 != 0, _packed_sid(p, _last_code())).alias("packed")))
    # an offer moves as one number, its SID is written where the sample's outputs are made
    offer = (ti * 10 + bi).cast("bigint") * _NO_SID + F.coalesce(F.col("packed"), F.lit(_NO_SID - 1))
    offers = grid.join(sized_broadcast(cat), "lookup", "left").groupBy("s").agg(F.collect_list(offer).alias("offers"))
    # one row per sample moves, its outputs are made where it stands
    per = t.join(offers, "s")
    per = per.repartition("sample_id") if details is None else per.join(details, "sample_id")
    more = [] if details is None else [c for c in details.columns if c != "sample_id"]
    slot, packed = F.floor(F.col("o") / _NO_SID), F.col("o") % _NO_SID
    j = (per.select("sample_id", "groundtruth", "s", *more, F.explode("offers").alias("o"))
         .select("sample_id", "groundtruth", "s", *more, F.floor(slot / 10).alias("think_idx"),
                 (slot % 10).alias("beam_idx"),
                 F.when(packed != _NO_SID - 1, _unpacked_sid(packed)).alias("cand_sid")))
    answer = (F.when((s * 7 + ti * 3 + bi) % 23 == 0, F.col("groundtruth"))
              .when((s + bi) % 13 == 0, F.lit("no id here"))
              .otherwise(F.coalesce(F.col("cand_sid"), F.lit("unknown"))))
    text = F.concat(F.lit("<think>\nreason "), ti.cast("string"), F.lit("\n</think>\n"), answer)
    score = -((s * 31 + ti * 17 + bi * 29) % 97).cast("double") / 10
    return j.select("sample_id", "groundtruth", ti.cast("int").alias("think_idx"),
                    bi.cast("int").alias("beam_idx"), text.alias("text"), score.alias("score"), *more)
