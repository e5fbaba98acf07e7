"""Registered whole-table jobs: one per SURVEY §2 operator, each paired with
the DuckDB SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .operators import behaviors as bh
from .operators import corpus as corpus_ops
from .functions import chat as chatf
from .functions import sid as sidf
from .functions import text as txt
from .operators import candidates as cand
from .operators import trie
from .operators import metrics as metrics_ops
from .plans import corpora, evaluation, metadata, persona
from .session import read_table, release, scratch_path, shared
from .operators.ordered import ordered_concat
from .sources import fixtures as fx
from .sources import readers, writers

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


#: Characters of a part in the compared long forms (:data:`.operators.ordered.PART_CHARS` by default).
PART = 1000


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def job(spark: SparkSession, sf: str) -> DataFrame:
            release(spark)  # what the job before has shared
            return fn(spark, sf)

        QUERIES[name] = job
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- corpora ---

_K2_CTE = """sid_corpus as (
select s.split, q.user_id,
       'The user has purchased the following items: ' ||
         array_to_string(q.seq[1:len(q.seq) - s.k - 1], '; ') || ';' description,
       q.seq[len(q.seq) - s.k] groundtruth
from (select user_id, list(sid order by pos) seq
      from interactions i join catalog k using (item_id)
      where coalesce(k.sid, '') <> '' group by user_id) q,
     (values ('train', 2), ('val', 1), ('test', 0)) s(split, k)
where len(q.seq) >= s.k + 2)"""


_K2_SQL = O.with_fixtures("select split, user_id, description, groundtruth from sid_corpus",
                          "interactions", "catalog", extra=[_K2_CTE])


@query("sid_prediction_corpus", _K2_SQL)
def q_sid_prediction_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return corpora.sid_prediction_corpus(fx.interactions(spark, sf), fx.catalog(spark, sf))


_PHRASE_SQL = ("sid || ', its title is \"' || coalesce(title, '') || '\", its categories are \"' || "
               "coalesce(categories, '') || '\"'")

_K4_CTE = f"""ra_corpus as (
select s.split, q.user_id,
       'The user has purchased the following items: ' ||
         array_to_string(list_transform(q.seq[1:len(q.seq) - s.k - 1], lambda x: x.p), '; ') || ';'
         description,
       struct_extract(q.seq[len(q.seq) - s.k], 'sid') groundtruth,
       struct_extract(q.seq[len(q.seq) - s.k], 't') title,
       struct_extract(q.seq[len(q.seq) - s.k], 'c') categories
from (select user_id,
             list({{'p': {_PHRASE_SQL}, 'sid': sid, 't': coalesce(title, ''),
                   'c': coalesce(categories, '')}} order by pos) seq
      from interactions i join catalog k using (item_id)
      where coalesce(k.sid, '') <> '' group by user_id) q,
     (values ('train', 2), ('val', 1), ('test', 0)) s(split, k)
where len(q.seq) >= s.k + 2)"""

def _k3_sql(out: str = "description") -> str:
    return O.with_fixtures(f"""
select s.split, q.user_id,
       'The user has purchased the following items: ' ||
         array_to_string(list_transform(list_filter(q.seq[1:len(q.seq) - s.k], lambda x: x.ok),
                                        lambda x: x.p), '; ') || ';' {out}
from (select i.user_id,
             list({{'ok': coalesce(k.sid, '') <> '' and coalesce(k.title, '') <> ''
                          and coalesce(k.categories, '') <> '',
                   'p': {_PHRASE_SQL}}} order by i.pos) seq
      from interactions i left join catalog k using (item_id) group by i.user_id) q,
     (values ('train', 2), ('val', 1), ('test', 0)) s(split, k)
where len(q.seq) > s.k and len(list_filter(q.seq[1:len(q.seq) - s.k], lambda x: x.ok)) > 0""",
                           "interactions", "catalog")


def _sid_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return corpora.sid_prediction_corpus(fx.interactions(spark, sf), fx.catalog(spark, sf))


def _ra_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return corpora.reasoning_corpus(fx.interactions(spark, sf), fx.catalog(spark, sf))


@query("reasoning_corpus", O.with_fixtures("select * from ra_corpus", "interactions", "catalog",
                                           extra=[_K4_CTE]))
def q_reasoning_corpus(spark, sf):
    return _ra_corpus(spark, sf)


@query("alignment_corpus", _k3_sql())
def q_alignment_corpus(spark, sf):
    return corpora.alignment_corpus(fx.interactions(spark, sf), fx.catalog(spark, sf))


def _parts_sql(phrase: str, usable: str, on: str = "p.rr = s.k + 1", behind: str = "p.pos < c.cut",
               targets: str = "") -> str:
    """Histories in front of each split's cut, cut into parts of ``PART`` characters; ``targets``: columns of
    the cut row that stand in part 0."""
    names = [t.split(" ")[-1] for t in targets.split(", ") if t]
    first = "".join(f", case when a.part_no = 0 then c.{n} end {n}" for n in names)
    return O.with_fixtures(f"""
select a.split, a.user_id, a.part_no, a.part{first}
from (select split, user_id, cast(floor(ahead / {PART}) as bigint) part_no,
             string_agg(phrase, '; ' order by pos) part
      from (select c.split, c.user_id, p.pos, p.phrase,
                   coalesce(sum(length(p.phrase) + 2) over (
                     partition by c.split, c.user_id order by p.pos
                     rows between unbounded preceding and 1 preceding), 0) ahead
            from cuts c join ph p on p.user_id = c.user_id and {behind} and p.phrase is not null) h
      group by split, user_id, floor(ahead / {PART})) a
join cuts c on c.split = a.split and c.user_id = a.user_id""", "interactions", "catalog", extra=[f"""ph as (
select i.user_id, i.pos, k.sid, coalesce(k.title, '') title, coalesce(k.categories, '') categories, {phrase} phrase,
       row_number() over (partition by i.user_id order by i.pos desc) rr
from interactions i {usable})""", f"""cuts as (
select s.split, p.user_id, p.pos cut{', ' + targets if targets else ''}
from ph p join (values ('train', 2), ('val', 1), ('test', 0)) s(split, k) on {on})"""])


_USABLE = "join catalog k using (item_id) where coalesce(k.sid, '') <> ''"


@query("sid_prediction_parts", _parts_sql("k.sid", _USABLE, targets="p.sid groundtruth"))
def q_sid_prediction_parts(spark, sf):
    return corpora.sid_prediction_parts(fx.interactions(spark, sf), fx.catalog(spark, sf), PART)


@query("reasoning_parts", _parts_sql(_PHRASE_SQL.replace("sid ||", "k.sid ||"), _USABLE, targets=(
    "p.sid groundtruth, p.title title, p.categories categories")))
def q_reasoning_parts(spark, sf):
    return corpora.reasoning_parts(fx.interactions(spark, sf), fx.catalog(spark, sf), PART)


@query("alignment_parts", _parts_sql(
    "case when coalesce(k.sid, '') <> '' and coalesce(k.title, '') <> '' and coalesce(k.categories, '') <> '' "
    f"then {_PHRASE_SQL.replace('sid ||', 'k.sid ||')} end", "left join catalog k using (item_id)",
    behind="p.pos <= c.cut"))
def q_alignment_parts(spark, sf):
    return corpora.alignment_parts(fx.interactions(spark, sf), fx.catalog(spark, sf), PART)


@query("missing_items_report", O.with_fixtures("""
select user_id, reason, count(*) n_items from (
  select i.user_id,
         case when k.item_id is null then 'absent' when coalesce(k.sid, '') = '' then 'no_sid'
              when coalesce(k.title, '') = '' or coalesce(k.categories, '') = '' then 'no_text'
         end reason
  from interactions i left join catalog k using (item_id)) t
where reason is not null group by user_id, reason""", "interactions", "catalog"))
def q_missing_items_report(spark, sf):
    return corpus_ops.missing_items_report(fx.interactions(spark, sf), fx.catalog(spark, sf))


@query("split_counts", O.with_fixtures(
    "select split, count(*) n_rows from sid_corpus group by split",
    "interactions", "catalog", extra=[_K2_CTE]))
def q_split_counts(spark, sf):
    return corpus_ops.split_counts(_sid_corpus(spark, sf))


@query("preview_rows", O.with_fixtures("""
select split, user_id, description, groundtruth from (
  select *, row_number() over (partition by split order by user_id) rn from sid_corpus) t
where rn <= 2""", "interactions", "catalog", extra=[_K2_CTE]))
def q_preview_rows(spark, sf):
    return corpus_ops.preview_rows(_sid_corpus(spark, sf))


# ------------------------------------------------------------- behaviours ---

def _clean(c: str) -> str:
    return f"replace(replace(replace({c}, chr(8232), ' '), chr(8233), ' '), chr(13), ' ')"


_VALID_SQL = """select * from behaviors
where coalesce(item_id, '') <> '' and coalesce(user_id, '') <> ''
  and prompt is not null and semantic_id is not null"""

_EXTRA_SQL = f"""select *, json_extract_string(extra_info, '$.played_dur') played_dur,
       json_extract_string(extra_info, '$.element_action') element_action,
       json_extract_string(extra_info, '$.query_cnt') query_cnt
from ({_VALID_SQL}) v"""

_LONG_ENOUGH = ("(platform_type = 'App' or (platform_type = 'Web' "
                "and try_cast(played_dur as double) >= 5))")

_PLOG_CTE = f"""plog as (
select user_id, item_id, photo_type, event_type, behavior_type, behavior_subtype, time_stamp,
       content_type, {_clean('prompt')} prompt, {_clean('title')} title,
       {_clean('introduction')} introduction,
       {_clean('element_query_content')} element_query_content, query_cnt, semantic_id, event_id
from ({_EXTRA_SQL}) r
where event_type = 'PRODUCE' or case behavior_type
  when 'VIDEO_PLAY_FINISH' then true
  when 'LONG_PLAY' then {_LONG_ENOUGH} when 'SHORT_PLAY' then {_LONG_ENOUGH}
  when 'OPERATE' then case behavior_subtype
    when 'LARGE' then platform_type = 'App' or (platform_type = 'Web' and element_action = 'FANC_CARD')
    else behavior_subtype in ('LIKE', 'UNLIKE', 'COMMENT', 'SHARE', 'SAME_STYLE', 'REPORT') end
  end)"""

# a list or tuple of integers and nothing else, as a literal parser takes it
_INTS = r"[+-]?(0+|[1-9][0-9]*)"
_LITERAL = (rf"(\\[\\s*({_INTS}\\s*(,\\s*{_INTS}\\s*)*,?\\s*)?\\]"
            rf"|\\(\\s*({_INTS}\\s*,\\s*({_INTS}\\s*(,\\s*{_INTS}\\s*)*,?\\s*)?)?\\))")
_PARSED = (f"case when regexp_full_match({O.strip('semantic_id')}, '{_LITERAL}') then "
           f"list_transform(regexp_extract_all({O.strip('semantic_id')}, '[+-]?[0-9]+'), "
           "lambda x: try_cast(x as bigint)) end").replace("\\\\", "\\")

_PARSEABLE_CTE = f"""prows as (select *, {_PARSED} codes from plog where ({_PARSED}) is not null)"""


def _plog(spark: SparkSession, sf: str) -> DataFrame:
    return bh.positive_log(fx.behaviors(spark, sf))


def _outline_log(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`_plog` for readers of its short columns."""
    return bh.positive_log(fx.behavior_outline(spark, sf))


_TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_TS_FMT_SQL = "%Y-%m-%d %H:%M:%S.%f"


def _present_log(df: DataFrame) -> DataFrame:
    """Log rows as compared with the oracle: nullable codes and timestamps as
    text so both engines hand over the same value types."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in ("photo_type", "content_type")
                       else F.date_format(c, _TS_FMT).alias(c) if c == "time_stamp"
                       else F.col(c) for c in df.columns])


def _present_log_sql(rel: str = "plog") -> str:
    return (f"select * replace (cast(photo_type as varchar) as photo_type, "
            f"cast(content_type as varchar) as content_type, "
            f"strftime(time_stamp, '{_TS_FMT_SQL}') as time_stamp) from {rel}")


def _bsql(body: str, *extra: str) -> str:
    return O.with_fixtures(body, "behaviors", extra=[_PLOG_CTE, *extra])


@query("valid_behavior_rows", O.with_fixtures(
    "select event_id, user_id, item_id from (" + _VALID_SQL + ") v", "behaviors"))
def q_valid_behavior_rows(spark, sf):
    return bh.valid_behavior_rows(fx.behaviors(spark, sf)).select("event_id", "user_id", "item_id")


@query("extract_extra_info", O.with_fixtures(
    "select event_id, played_dur, element_action, query_cnt from (" + _EXTRA_SQL + ") x",
    "behaviors"))
def q_extract_extra_info(spark, sf):
    return (bh.extract_extra_info(bh.valid_behavior_rows(fx.behaviors(spark, sf)))
            .select("event_id", "played_dur", "element_action", "query_cnt"))


@query("positive_behaviors", _bsql(_present_log_sql()))
def q_positive_behaviors(spark, sf):
    return _present_log(_plog(spark, sf))


@query("scan_behavior_partition", _bsql(_present_log_sql(
    "(select p.* from plog p join behaviors b using (event_id) where b.p_date = '20240102') q")))
def q_scan_behavior_partition(spark, sf):
    raw = bh.require_partition(fx.behavior_table(spark, sf), "20240102")
    return _present_log(bh.positive_log(raw))


@query("parseable_sid_rows", _bsql("select event_id, array_to_string(codes, ',') codes from prows",
                                   _PARSEABLE_CTE))
def q_parseable_sid_rows(spark, sf):
    codes = sidf.parse_semantic_id("semantic_id")
    return bh.parseable_sid_rows(_outline_log(spark, sf)).select(
        "event_id", F.array_join(F.transform(codes, lambda x: x.cast("string")), ",").alias("codes"))


@query("order_behaviors", _bsql(f"""
select row_number() over (order by user_id nulls first, time_stamp nulls last, event_id) "position",
       user_id, event_id, strftime(time_stamp, '{_TS_FMT_SQL}') time_stamp from plog"""))
def q_order_behaviors(spark, sf):
    log = _outline_log(spark, sf).select("user_id", "event_id", "time_stamp")
    return bh.order_behaviors(log, "position").select(
        "position", "user_id", "event_id", F.date_format("time_stamp", _TS_FMT).alias("time_stamp"))


_TS_SQL = ("strftime(time_stamp, '%Y-%m-%d %H:%M:%S') || case when epoch_us(time_stamp) % 1000000 "
           "<> 0 then '.' || strftime(time_stamp, '%f') else '' end")


@query("user_sequences", _bsql("""
select user_id, user_id || ' ' || string_agg(item_id, ' ' order by time_stamp nulls last, event_id)
         line, count(*) n_items
from prows group by user_id having count(*) >= 3""", _PARSEABLE_CTE))
def q_user_sequences(spark, sf):
    return bh.user_sequences(_outline_log(spark, sf))


@query("user_sequence_parts", _bsql(f"""
select user_id, cast(floor(ahead / {PART}) as bigint) part_no, string_agg(item_id, ' ' order by n) part
from (select user_id, item_id, row_number() over by_time n, count(*) over (partition by user_id) total,
             coalesce(sum(length(item_id) + 1) over (by_time rows between unbounded preceding
                                                     and 1 preceding), 0) ahead
      from prows window by_time as (partition by user_id order by time_stamp nulls last, event_id)) s
where total >= 3 group by user_id, floor(ahead / {PART})""", _PARSEABLE_CTE))
def q_user_sequence_parts(spark, sf):
    return bh.user_sequence_parts(_outline_log(spark, sf), 3, PART)


@query("user_behavior_details", _bsql(f"""
select user_id,
       row_number() over (partition by user_id order by time_stamp nulls last, event_id) idx,
       item_id, coalesce(event_type, 'UNKNOWN') event_type,
       coalesce(behavior_type, '') behavior_type, coalesce(behavior_subtype, '') behavior_subtype,
       coalesce({_TS_SQL}, '') "timestamp",
       coalesce(element_query_content, '') element_query_content,
       coalesce(try_cast(query_cnt as bigint), 0) query_cnt
from prows""", _PARSEABLE_CTE))
def q_user_behavior_details(spark, sf):
    return bh.user_behavior_details(_outline_log(spark, sf))


@query("latest_item_records", _bsql("""
select item_id, event_id, user_id, semantic_id from (
  select *, row_number() over (partition by item_id
                               order by time_stamp desc nulls first, event_id desc) r
  from plog) t where r = 1"""))
def q_latest_item_records(spark, sf):
    return bh.latest_item_records(_plog(spark, sf)).select(
        "item_id", "event_id", "user_id", "semantic_id")


@query("event_type_distribution", _bsql("""
select rank, event_type, n, round(n * 100.0 / total, 6) pct from (
  select case event_type when 'RECOMMEND' then 0 when 'SEARCH' then 1 else 2 end rank,
         event_type, count(*) n, (select count(*) from plog) total
  from plog where event_type in ('RECOMMEND', 'SEARCH', 'PRODUCE') group by event_type) t"""))
def q_event_type_distribution(spark, sf):
    return bh.event_type_distribution(_outline_log(spark, sf))


@query("sequence_length_histogram", _bsql("""
select b.rank, b.bin, count(u.n) n_users,
       round(count(u.n) * 100.0 / (select count(distinct user_id) from prows), 6) pct
from (values (0, '1-2', 0, 3), (1, '3-4', 3, 5), (2, '5-9', 5, 10), (3, '10-19', 10, 20),
             (4, '20-49', 20, 50), (5, '50+', 50, 1000000000)) b(rank, bin, lo, hi)
left join (select user_id, count(*) n from prows group by user_id) u
  on u.n >= b.lo and u.n < b.hi
group by b.rank, b.bin""", _PARSEABLE_CTE))
def q_sequence_length_histogram(spark, sf):
    return bh.sequence_length_histogram(_outline_log(spark, sf))


@query("sequence_user_totals", _bsql("""
select count(*) total_users, count(*) filter (where n >= 3) valid_users
from (select user_id, count(*) n from prows group by user_id) u""", _PARSEABLE_CTE))
def q_sequence_user_totals(spark, sf):
    return bh.sequence_user_totals(_outline_log(spark, sf))


@query("search_query_stats", _bsql("""
select count(*) search_rows, count(*) filter (where coalesce(element_query_content, '') <> '')
       with_query,
       round(case when count(*) > 0 then count(*) filter
             (where coalesce(element_query_content, '') <> '') * 100.0 / count(*) end, 6) pct
from plog where event_type = 'SEARCH'"""))
def q_search_query_stats(spark, sf):
    return bh.search_query_stats(_outline_log(spark, sf))


_LATEST_CTE = """latest as (
select * from (select *, row_number() over (partition by item_id
                                             order by time_stamp desc nulls first, event_id desc) r
               from plog) t where r = 1)"""

_ITEMS_CTE = f"""items as (
select item_id,
       coalesce(nullif(title, ''), nullif(substring(introduction, 1, 100), ''),
                nullif(substring(description, 1, 100), ''), 'Item ' || item_id) title,
       description,
       case when content_type is null then 'General Creation'
            when content_type = 0 then 'Image and Video Creation'
            when content_type = 1 then 'Image Creation' when content_type = 2 then 'Video Creation'
            else 'Content Type ' || cast(content_type as varchar) end ||
       case when photo_type is null then '' when photo_type = 1 then ' > Material'
            when photo_type = 2 then ' > Short Film'
            else ' > Type ' || cast(photo_type as varchar) end categories,
       '<|sid_begin|>' || array_to_string(list_transform(codes[1:3], lambda x, i:
           '<' || ['s_a', 's_b', 's_c'][i] || '_' || cast(x as varchar) || '>'), '') ||
         '<|sid_end|>' sid
from (select *, {_PARSED.replace('semantic_id', 'l.semantic_id')} codes,
             case when length(coalesce(prompt, '')) > 1000
                  then substring(prompt, 1, 1000) || '...' else coalesce(prompt, '') end description
      from latest l) t
where len(codes) > 0)"""


@query("item_metadata", _bsql("select * from items", _LATEST_CTE, _ITEMS_CTE))
def q_item_metadata(spark, sf):
    return metadata.item_metadata(_plog(spark, sf))


@query("catalog_quality", _bsql(f"""
select (select count(*) from plog) raw_rows, count(*) unique_items,
       count(*) filter (where len({_PARSED}) > 0) valid_items,
       count(*) - count(*) filter (where len({_PARSED}) > 0) missing_sid
from latest""", _LATEST_CTE))
def q_catalog_quality(spark, sf):
    return metadata.catalog_quality(_outline_log(spark, sf))


# ------------------------------------------------------------ SID / trie ---

_VOCAB_CTE = """vocab as (
select '<|sid_begin|>' token, 0 token_id union all select '<|sid_end|>', 1
union all
select '<' || ['s_a', 's_b', 's_c'][(i // 256) + 1] || '_' || cast(i % 256 as varchar) || '>',
       i + 2 from range(768) t(i))"""

_TOKEN_RE = "<[^<>]+>"

_CAT_STEPS_CTE = f"""csteps as (
select sid, pos, toks[pos + 1] token,
       case when pos + 1 < len(toks) then toks[pos + 2] else '<|endoftext|>' end next_token,
       array_to_string(toks[1:pos + 1], '') prefix
from (select sid, toks, unnest(range(len(toks))) pos
      from (select sid, regexp_extract_all(sid, '{_TOKEN_RE}') toks
            from VSRC where sid is not null) a) b)"""

_VALID_CTE = f"""valid as (
select distinct sid from (
  select unnest(regexp_extract_all(description, '{O.SID_RE}')) sid from sid_corpus
  where split = 'test'
  union all
  select {O.first_sid('groundtruth')} sid from sid_corpus where split = 'test') u
where contains(sid, '<|sid_begin|>') and contains(sid, '<|sid_end|>'))"""


def _steps(src: str) -> str:
    return _CAT_STEPS_CTE.replace("VSRC", src)


def _test_corpus(spark, sf):
    return _sid_corpus(spark, sf).where(F.col("split") == "test")


def _valid_sids(spark, sf):
    return trie.valid_sid_set(_test_corpus(spark, sf))


def _tsql(body: str, *extra: str, more: tuple[str, ...] = ()) -> str:
    return O.with_fixtures(body, "interactions", "catalog", *more,
                           extra=[_K2_CTE, _VALID_CTE, *extra])


@query("sid_vocabulary_encode", O.with_fixtures("""
select s.sid, s.pos, s.token, v.token_id, 1024 padded_size
from csteps s join vocab v using (token)""",
                                                "catalog", extra=[_VOCAB_CTE, _steps("catalog")]))
def q_sid_vocabulary_encode(spark, sf):
    vocab = trie.sid_vocabulary(spark)
    sids = fx.catalog(spark, sf).where(F.col("sid").isNotNull()).select("sid")
    size = vocab.select("token_id", F.col("padded_size").cast("int").alias("padded_size"))
    return trie.encode_sid_tokens(sids, vocab).join(F.broadcast(size), "token_id").select(
        "sid", "pos", "token", "token_id", "padded_size")  # levels x 256 + 2 rows


@query("next_token", O.with_fixtures("select sid, pos, token, next_token from csteps", "catalog",
                                     extra=[_steps("catalog")]))
def q_next_token(spark, sf):
    sids = fx.catalog(spark, sf).where(F.col("sid").isNotNull()).select("sid")
    return trie.token_steps(sids)


@query("sid_tokens", O.with_fixtures(f"""
select sid, len(regexp_extract_all(sid, '{_TOKEN_RE}')) n_tokens,
       array_to_string(regexp_extract_all(sid, '{_TOKEN_RE}'), ' ') tokens
from catalog where sid is not null""", "catalog"))
def q_sid_tokens(spark, sf):
    c = fx.catalog(spark, sf).where(F.col("sid").isNotNull())
    t = sidf.sid_tokens("sid")
    return c.select("sid", F.size(t).cast("bigint").alias("n_tokens"),
                    F.array_join(t, " ").alias("tokens"))


@query("valid_sid_set", _tsql("select sid from valid"))
def q_valid_sid_set(spark, sf):
    return _valid_sids(spark, sf)


@query("sid_union_distinct", _tsql("""
select distinct sid from (select sid from catalog where sid is not null
                          union all select groundtruth from sid_corpus) u"""))
def q_sid_union_distinct(spark, sf):
    cat = fx.catalog(spark, sf).where(F.col("sid").isNotNull()).select("sid")
    return trie.sid_union_distinct(cat, _sid_corpus(spark, sf).select(
        F.col("groundtruth").alias("sid")))


@query("sid_transitions", _tsql("""
select pos, token, array_to_string(list_sort(list_distinct(list(next_token))), ' ') next_tokens
from csteps group by pos, token""", _steps("valid")))
def q_sid_transitions(spark, sf):
    t = trie.sid_transitions(_valid_sids(spark, sf))
    return t.select("pos", "token", F.array_join("next_tokens", " ").alias("next_tokens"))


@query("sid_prefix_trie", _tsql("""
select pos, prefix, array_to_string(list_sort(list_distinct(list(next_token))), ' ') next_tokens
from csteps group by pos, prefix""", _steps("valid")))
def q_sid_prefix_trie(spark, sf):
    t = trie.sid_prefix_trie(_valid_sids(spark, sf))
    return t.select("pos", "prefix", F.array_join("next_tokens", " ").alias("next_tokens"))


@query("trie_stats", _tsql("""
select 'unique_sids' metric, cast(-1 as bigint) pos, count(*) value from valid
union all
select 'max_depth', -1, max(len(regexp_extract_all(sid, '<[^<>]+>'))) from valid
union all
select 'tokens_at_pos', pos, count(distinct token) from csteps where pos < 6 group by pos
union all
select 'total_samples', -1, count(*) from sid_corpus where split = 'test'""", _steps("valid")))
def q_trie_stats(spark, sf):
    # whole-table statistics carry pos -1 in the compared output
    out = trie.trie_stats(_valid_sids(spark, sf), _test_corpus(spark, sf))
    return out.withColumn("pos", F.coalesce("pos", F.lit(-1).cast("bigint")))


_PREDS_CTE = f"""preds as (
select sample_id, think_idx, beam_idx, text, score, groundtruth,
       {O.normalize_prediction('text')} pred_sid
from candidates)"""


def _legal_sql(mode: str) -> str:
    key = "token" if mode == "bigram" else "prefix"
    return _tsql(f"""
select p.sample_id, p.think_idx, p.beam_idx, p.pred_sid from preds p
where regexp_full_match(p.pred_sid, '{O.SID_RE}')
  and not exists (
    select 1 from (select sid, pos, token, next_token, prefix from ccand) s
    where s.sid = p.pred_sid and not exists (
      select 1 from csteps a where a.pos = s.pos and a.{key} = s.{key}
                               and a.next_token = s.next_token))""",
                 _PREDS_CTE, _steps("valid"),
                 _steps("(select distinct pred_sid sid from preds)").replace("csteps as", "ccand as"),
                 more=("candidates",))


def _preds(spark, sf):
    return cand.with_predictions(fx.candidates(spark, sf))


@query("legal_continuations", _legal_sql("bigram"))
def q_legal_continuations(spark, sf):
    table = trie.sid_transitions(_valid_sids(spark, sf))
    return trie.legal_continuations(_preds(spark, sf), table, "pred_sid", "bigram").select(
        "sample_id", "think_idx", "beam_idx", "pred_sid")


@query("legal_continuations_prefix", _legal_sql("prefix"))
def q_legal_continuations_prefix(spark, sf):
    table = trie.sid_prefix_trie(_valid_sids(spark, sf))
    return trie.legal_continuations(_preds(spark, sf), table, "pred_sid", "prefix").select(
        "sample_id", "think_idx", "beam_idx", "pred_sid")


# ------------------------------------------------------------- evaluation ---

METRICS = ["hit@1", "hit@5", "hit@10", "ndcg@5", "ndcg@10"]


def _metric_sql(rel: str, metrics=METRICS, extra_keys: str = "") -> str:
    """DuckDB metric_report over a ``rel(sample_id, rank, rel)`` relation."""
    parts = []
    for m in metrics:
        k = int(m.split("@")[1])
        if m.startswith("hit"):
            parts.append(f"max(case when rank <= {k} then rel else 0 end) h{k}")
        else:
            parts.append(f"sum(case when rank <= {k} then rel / log2(rank + 1) else 0 end) d{k}")
    per = f"select sample_id, count(rank) n, {', '.join(parts)} from {rel} group by sample_id"
    cols = []
    for i, m in enumerate(metrics):
        k = int(m.split("@")[1])
        if m.startswith("hit"):
            cols.append(f"avg(case when n >= {k} and h{k} = 1 then 1.0 else 0.0 end) m{i}")
        else:
            cols.append(f"avg(d{k}) m{i}")
    wide = f"select count(*) n_samples, {', '.join(cols)} from ({per}) p"
    return "\nunion all\n".join(
        f"select '{m}' metric, round(m{i}, 6) value, n_samples from ({wide}) w"
        for i, m in enumerate(metrics))


def _rounded(df: DataFrame, col: str = "value") -> DataFrame:
    return df.withColumn(col, F.round(F.col(col), 6))


_DIRECT_REL_CTE = """drel as (
select t.sample_id, p.think_idx, p.beam_idx, p.pred_sid, p.score,
       case when p.sample_id is not null then row_number() over (
         partition by t.sample_id order by p.score desc, p.think_idx, p.beam_idx) end rank,
       coalesce(cast(p.pred_sid = """ + O.first_sid("t.groundtruth") + """ as integer), 0) rel
from truth t left join (select * from preds where think_idx = 0) p on p.sample_id = t.sample_id)"""


def _esql(body: str, *extra: str) -> str:
    return O.with_fixtures(body, "candidates", extra=[_PREDS_CTE, *extra])


def _direct(spark, sf):
    return fx.candidates(spark, sf).where(F.col("think_idx") == 0)


@query("rank_candidates", _esql("""
select sample_id, coalesce(beam_idx, -1) beam_idx, coalesce(rank, 0) rank, pred_sid, rel
from drel""", _DIRECT_REL_CTE))
def q_rank_candidates(spark, sf):
    return evaluation.direct_relevance(_direct(spark, sf), fx.truth(spark, sf)).select(
        "sample_id", F.coalesce("beam_idx", F.lit(-1)).alias("beam_idx"),
        F.coalesce("rank", F.lit(0)).cast("bigint").alias("rank"), "pred_sid", "rel")


@query("normalize_prediction", _esql("select sample_id, think_idx, beam_idx, pred_sid from preds"))
def q_normalize_prediction(spark, sf):
    return _preds(spark, sf).select("sample_id", "think_idx", "beam_idx", "pred_sid")


@query("hit_at_k", _esql("select value from (" + _metric_sql("drel", ["hit@10"]) + ") t",
                         _DIRECT_REL_CTE))
def q_hit_at_k(spark, sf):
    rel = evaluation.direct_relevance(_direct(spark, sf), fx.truth(spark, sf))
    return _rounded(metrics_ops.hit_at_k(rel, 10))


@query("ndcg_at_k", _esql("select value from (" + _metric_sql("drel", ["ndcg@10"]) + ") t",
                          _DIRECT_REL_CTE))
def q_ndcg_at_k(spark, sf):
    rel = evaluation.direct_relevance(_direct(spark, sf), fx.truth(spark, sf))
    return _rounded(metrics_ops.ndcg_at_k(rel, 10))


@query("evaluate_direct", _esql(_metric_sql("drel"), _DIRECT_REL_CTE))
def q_evaluate_direct(spark, sf):
    return _rounded(evaluation.evaluate_direct(_direct(spark, sf), fx.truth(spark, sf), METRICS))


_BEST_CTE = """best as (
select sample_id, pred_sid, max(score) score, min(think_idx * 100000 + beam_idx) ord,
       cast(min(think_idx * 100000 + beam_idx) // 100000 as bigint) first_think,
       cast(min(think_idx * 100000 + beam_idx) % 100000 as bigint) first_beam
from preds group by sample_id, pred_sid)"""

_TOP_CTE = """top10 as (
select b.*, string_split(f.first_text, '</think>')[1] || '</think>' prefix from (
  select *, row_number() over (partition by sample_id order by score desc, ord) rank from best) b
join (select sample_id, arg_min(text, think_idx * 100000 + beam_idx) first_text
      from preds group by sample_id) f using (sample_id)
where rank <= 10)"""

_PADDED_CTE = """padded as (
select sample_id, rank, prefix, pred_sid, score, false padded from top10
union all
select m.sample_id, m.m + r.i, m.lprefix, m.lpred, m.lscore - 0.05::double * r.i * (r.i + 1), true
from (select sample_id, max(rank) m, arg_max(pred_sid, rank) lpred, arg_max(score, rank) lscore,
             arg_max(prefix, rank) lprefix
      from top10 group by sample_id) m, range(1, 11) r(i)
where m.m + r.i <= 10)"""

_COT_REL_CTE = """crel as (
select p.sample_id, p.rank, cast(p.pred_sid = """ + O.first_sid("t.groundtruth") + """ as integer) rel
from padded p join truth t using (sample_id)
union all
select t.sample_id, r.i, 0 from truth t, range(1, 11) r(i)
where t.sample_id not in (select sample_id from padded))"""


@query("best_score_per_sid", _esql(
    "select sample_id, pred_sid, score, first_think, first_beam from best", _BEST_CTE))
def q_best_score_per_sid(spark, sf):
    b = cand.best_score_per_sid(_preds(spark, sf))
    return b.select("sample_id", "pred_sid", "score",
                    F.col("first_ord.think_idx").cast("bigint").alias("first_think"),
                    F.col("first_ord.beam_idx").cast("bigint").alias("first_beam"))


@query("unique_top10", _esql("""
select sample_id, rank, prefix || chr(10) || pred_sid text, round(score, 6) score, padded
from padded""", _BEST_CTE, _TOP_CTE, _PADDED_CTE))
def q_unique_top10(spark, sf):
    t = cand.unique_top_k(_preds(spark, sf), 10)
    return _rounded(t.select("sample_id", "rank", "text", "score", "padded"), "score")


@query("evaluate_cot", _esql(_metric_sql("crel"), _BEST_CTE, _TOP_CTE, _PADDED_CTE,
                             _COT_REL_CTE))
def q_evaluate_cot(spark, sf):
    return _rounded(evaluation.evaluate_cot(fx.candidates(spark, sf), fx.truth(spark, sf),
                                            METRICS))


@query("demote_illegal_items", _esql("""
select p.sample_id, p.think_idx, p.beam_idx,
       case when l.sid is null then -1000.0 else p.score end score
from preds p left join (select distinct sid from catalog where sid is not null) l
  on l.sid = p.pred_sid"""))
def q_demote_illegal_items(spark, sf):
    legal = fx.catalog(spark, sf).where(F.col("sid").isNotNull()).select("sid")
    return cand.demote_illegal_items(_preds(spark, sf), legal).select(
        "sample_id", "think_idx", "beam_idx", "score")


@query("fan_out_thinking", O.with_fixtures("""
select user_id, t.i think_idx, description from sid_corpus, range(0, 5) t(i)
where split = 'test'""", "interactions", "catalog", extra=[_K2_CTE]))
def q_fan_out_thinking(spark, sf):
    return cand.fan_out_thinking(_test_corpus(spark, sf).select("user_id", "description"), 5) \
        .select("user_id", F.col("think_idx").cast("bigint").alias("think_idx"), "description")


@query("slice_samples", O.with_fixtures("""
select sample_id, groundtruth from (
  select *, row_number() over (order by sample_id) rn from truth) t
where rn > 100 and rn <= 100 + 500""", "truth"))
def q_slice_samples(spark, sf):
    return cand.slice_samples(fx.truth(spark, sf), offset=100, n=500)


@query("head_samples", O.with_fixtures(
    "select sample_id, groundtruth from truth order by sample_id limit 64", "truth"))
def q_head_samples(spark, sf):
    return cand.head_samples(fx.truth(spark, sf), 64)


@query("contiguous_shards", O.with_fixtures("""
select sample_id, cast(floor((row_number() over (order by sample_id) - 1) /
                             ceil(count(*) over () / 8.0)) as integer) shard
from truth""", "truth"))
def q_contiguous_shards(spark, sf):
    return metrics_ops.contiguous_shards(fx.truth(spark, sf), 8, "ceil").select(
        "sample_id", "shard")


@query("contiguous_shards_floor", O.with_fixtures("""
select sample_id, shard from (
  select sample_id, cast(floor((row_number() over (order by sample_id) - 1) /
                               floor(count(*) over () / 8)) as integer) shard from truth) t
where shard < 8""", "truth"))
def q_contiguous_shards_floor(spark, sf):
    return metrics_ops.contiguous_shards(fx.truth(spark, sf), 8, "floor").select(
        "sample_id", "shard")


_SHARDS_CTE = """shards as (
select sample_id, cast(floor((row_number() over (order by sample_id) - 1) /
                             ceil(count(*) over () / 8.0)) as integer) shard from truth)"""


def _per_shard_sql(rel: str) -> str:
    parts, cols = [], []
    for i, m in enumerate(METRICS):
        k = int(m.split("@")[1])
        if m.startswith("hit"):
            parts.append(f"max(case when rank <= {k} then rel else 0 end) h{k}")
            cols.append(f"avg(case when n >= {k} and h{k} = 1 then 1.0 else 0.0 end) m{i}")
        else:
            parts.append(f"sum(case when rank <= {k} then rel / log2(rank + 1) else 0 end) d{k}")
            cols.append(f"avg(d{k}) m{i}")
    per = (f"select sample_id, count(rank) n, {', '.join(parts)} from {rel} group by sample_id")
    wide = (f"select s.shard, count(*) n, {', '.join(cols)} from ({per}) p "
            f"join shards s using (sample_id) group by s.shard")
    return "shard_metrics as (" + "\nunion all\n".join(
        f"select shard, '{m}' metric, m{i} value, n from ({wide}) w"
        for i, m in enumerate(METRICS)) + ")"


@query("shard_metric_summary", _esql("""
select metric, round(avg(round(value, 4)), 8) macro, round(sum(value * n) / sum(n), 6) micro,
       cast(sum(n) as bigint) n_samples, count(distinct shard) shards
from shard_metrics group by metric""", _DIRECT_REL_CTE, _SHARDS_CTE, _per_shard_sql("drel")))
def q_shard_metric_summary(spark, sf):
    rel = evaluation.direct_relevance(_direct(spark, sf), fx.truth(spark, sf))
    shards = metrics_ops.contiguous_shards(fx.truth(spark, sf), 8).select("sample_id", "shard")
    s = metrics_ops.shard_metric_summary(metrics_ops.sharded_metrics(rel, shards, METRICS))
    # the mean of 4-decimal shard values has at most 7 decimals: 8 avoids a tie
    return s.withColumn("macro", F.round("macro", 8)).withColumn("micro", F.round("micro", 6))


def _running_sql(rel: str, batch: int, every: int) -> str:
    parts, sums = [], []
    for i, m in enumerate(METRICS):
        k = int(m.split("@")[1])
        if m.startswith("hit"):
            parts.append(f"case when count(rank) >= {k} and max(case when rank <= {k} then rel "
                         f"else 0 end) = 1 then 1.0 else 0.0 end m{i}")
        else:
            parts.append(f"sum(case when rank <= {k} then rel / log2(rank + 1) else 0 end) m{i}")
        sums.append(f"sum(m{i}) over (order by sample_id) c{i}")
    per = f"select sample_id, {', '.join(parts)} from {rel} group by sample_id"
    cum = (f"select row_number() over (order by sample_id) rn, {', '.join(sums)} from ({per}) p")
    rep = f"select rn, * exclude (rn) from ({cum}) c where rn % {batch * every} = 0"
    return "\nunion all\n".join(
        f"select rn // {batch} step, rn samples, '{m}' metric, round(c{i} / rn, 6) value "
        f"from ({rep}) r" for i, m in enumerate(METRICS))


@query("running_metrics", _esql(_running_sql("drel", 4, 50), _DIRECT_REL_CTE))
def q_running_metrics(spark, sf):
    rel = evaluation.direct_relevance(_direct(spark, sf), fx.truth(spark, sf))
    out = metrics_ops.running_metrics(rel, 4, 50, METRICS)
    return _rounded(out.select("step", "samples", "metric", "value"))


_RR_CTE = """rr as (
select i.user_id, i.pos, k.sid,
       row_number() over (partition by i.user_id order by i.pos desc) r
from interactions i join catalog k using (item_id) where coalesce(k.sid, '') <> '')"""

_SUCCESSORS_CTE = """successors as (
select src, dst, cnt from (
  select src, dst, cnt, row_number() over (partition by src order by cnt desc, dst) n
  from (select sid src, next_sid dst, count(*) cnt
        from (select sid, lead(sid) over (partition by user_id order by pos) next_sid
              from rr where r > 2) a
        where next_sid is not null group by sid, next_sid) c) x where n <= 10)"""


@query("default_candidates", O.with_fixtures("""
select l.sample_id, t.beam_idx, t.dst pred_sid, cast(t.cnt as double) score
from (select user_id sample_id, sid from rr where r = 2) l
join (select src, dst, cnt, beam_idx from (
        select src, dst, cnt,
               cast(row_number() over (partition by src order by cnt desc, dst) - 1 as integer)
                 beam_idx
        from (select sid src, next_sid dst, count(*) cnt
              from (select sid, lead(sid) over (partition by user_id order by pos) next_sid
                    from rr where r > 2) a
              where next_sid is not null group by sid, next_sid) c) x where beam_idx < 10) t
  on t.src = l.sid""", "interactions", "catalog", extra=[_RR_CTE]))
def q_default_candidates(spark, sf):
    return _default_candidates(spark, sf).select("sample_id", "beam_idx", "pred_sid", "score")


def _default_candidates(spark, sf):
    return evaluation.default_candidates(fx.interactions(spark, sf), fx.catalog(spark, sf), 10)


_DEFAULT_REL_CTE = """drel as (
select t.sample_id,
       case when d.src is not null then row_number() over (
         partition by t.sample_id order by d.cnt desc, d.dst) end rank,
       coalesce(cast(d.dst = t.groundtruth as integer), 0) rel
from truth t
left join (select user_id, sid from rr where r = 2) l on l.user_id = t.sample_id
left join successors d on d.src = l.sid)"""


@query("evaluate_default_candidates", O.with_fixtures(
    _metric_sql("drel"), "interactions", "catalog", "truth", extra=[_RR_CTE, _SUCCESSORS_CTE,
                                                                   _DEFAULT_REL_CTE]))
def q_evaluate_default_candidates(spark, sf):
    return _rounded(evaluation.evaluate_direct(_default_candidates(spark, sf), fx.truth(spark, sf),
                                               METRICS))


@query("evaluate_legal", _esql(_metric_sql("drel"), """lpreds as (
select p.* replace (case when l.sid is null then -1000.0::double else p.score end as score)
from preds p left join (select distinct sid from catalog where sid is not null) l
  on l.sid = p.pred_sid)""", _DIRECT_REL_CTE.replace("from preds", "from lpreds")))
def q_evaluate_legal(spark, sf):
    legal = fx.catalog(spark, sf).where(F.col("sid").isNotNull()).select("sid")
    return _rounded(evaluation.evaluate_direct(_direct(spark, sf), fx.truth(spark, sf), METRICS,
                                               legal=legal))


# ------------------------------------------------------------ text / chat ---

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _nl(s: str) -> str:
    """SQL string expression for a Python literal that may contain newlines."""
    parts = s.split("\n")
    return " || chr(10) || ".join(_q(p) for p in parts)


_OPENER_HEAD = _nl(f"<|im_start|>system\n{txt.SYSTEM_MESSAGE}<|im_end|>\n<|im_start|>user\n")
_OPENER_TAIL = _nl("<|im_end|>\n<|im_start|>assistant\n")


def _opener_sql(user: str) -> str:
    return f"({_OPENER_HEAD} || coalesce({user}, '') || {_OPENER_TAIL})"


_EMPTY_THINK = _nl("<think>\n\n</think>\n")


@query("chat_texts", O.with_fixtures(f"""
select split, user_id,
       {_opener_sql('description')} prompt_think,
       {_opener_sql('description')} || {_EMPTY_THINK} prompt_direct,
       {_opener_sql('description')} || {_EMPTY_THINK} || groundtruth || '<|im_end|>' || chr(10) sft
from sid_corpus""", "interactions", "catalog", extra=[_K2_CTE]))
def q_chat_texts(spark, sf):
    c = _sid_corpus(spark, sf)
    return c.select("split", "user_id", txt.chat_prompt_think("description").alias("prompt_think"),
                    txt.chat_prompt_direct("description").alias("prompt_direct"),
                    txt.sft_text("description", "groundtruth").alias("sft"))


def _rationale_sql(p: str = "") -> str:
    return (f"{_opener_sql(p + 'description')} || '<think>' || chr(10) || "
            f"case when {p}title is not null then 'The user is likely to buy items in ' || "
            f"coalesce({p}categories, 'None') || ' category' else '' end || chr(10) || "
            f"'</think>' || chr(10) || coalesce({p}groundtruth, '') || '<|im_end|>' || chr(10)")


@query("rationale_text", O.with_fixtures(f"""
select split, user_id, {_rationale_sql()} text from ra_corpus""", "interactions", "catalog",
                                         extra=[_K4_CTE]))
def q_rationale_text(spark, sf):
    c = _ra_corpus(spark, sf)
    return c.select("split", "user_id", txt.rationale_text(
        "description", "groundtruth", "title", "categories").alias("text"))


@query("align_text", _k3_sql("text"))
def q_align_text(spark, sf):
    return corpora.align_text(corpora.alignment_corpus(fx.interactions(spark, sf),
                                                       fx.catalog(spark, sf)))


def _gen_sql() -> str:
    return f"""gen as (
select c.sample_id, c.think_idx, c.beam_idx, s.description u,
       {_opener_sql('s.description')} || c.text g
from candidates c join sid_corpus s on s.user_id = c.sample_id
where s.split = 'test')"""


def _gen(spark, sf):
    s = _test_corpus(spark, sf).select(F.col("user_id").alias("sample_id"), "description")
    return fx.candidates(spark, sf, s).withColumn(
        "generated", F.concat(txt.chat_prompt_think("description"), F.col("text")))


_THINK_SQL = """case when contains(g, '<think>') and contains(ap, '<think>')
     then trim(case when contains(tp, '</think>') then string_split(tp, '</think>')[1] else tp end,
               WS) else '' end""".replace("WS", O.WS)


@query("extract_thinking", O.with_fixtures(f"""
select sample_id, think_idx, beam_idx, {_THINK_SQL} thinking,
       {_opener_sql('u')} || '<think>' || chr(10) || {_THINK_SQL} || chr(10) || '</think>' ||
         chr(10) sid_prompt
from (select *, string_split(ap, '<think>')[-1] tp from (
        select *, case when contains(g, u) then string_split(g, u)[-1] else g end ap
        from gen) a) b""", "interactions", "catalog", "candidates", extra=[_K2_CTE, _gen_sql()]))
def q_extract_thinking(spark, sf):
    g = _gen(spark, sf).withColumn("thinking", txt.extract_thinking("generated", "description"))
    return g.select("sample_id", "think_idx", "beam_idx", "thinking",
                    txt.chat_prompt_sid("description", "thinking").alias("sid_prompt"))


def _response_variant(spark, sf):
    c = fx.candidates(spark, sf)
    answer = F.substring_index("text", "</think>", -1)
    v = (F.when(F.col("beam_idx") % 3 == 0, F.col("text"))
         .when(F.col("beam_idx") % 3 == 1,
               F.concat(F.lit("<|im_start|>assistant\n"), answer,
                        F.lit("<|im_end|>\n<|im_start|>user\nmore")))
         .otherwise(answer))
    return c.withColumn("v", v)


_RESP_V = """case when beam_idx % 3 = 0 then text
     when beam_idx % 3 = 1 then '<|im_start|>assistant' || chr(10) ||
        string_split(text, '</think>')[-1] || '<|im_end|>' || chr(10) || '<|im_start|>user' ||
        chr(10) || 'more'
     else string_split(text, '</think>')[-1] end"""

_SP = "split_part(v, '<|im_start|>assistant', 2)"
_RESP_SQL = f"""case when contains(v, '</think>')
       then {O.first_sid(O.strip("string_split(v, '</think>')[-1]"))}
     when contains(v, '<|im_start|>assistant')
       then {O.first_sid(O.strip(f"case when contains({_SP}, '<|im_end|>') then string_split({_SP}, '<|im_end|>')[1] else {_SP} end"))}
     else {O.first_sid('v')} end"""


@query("extract_response", O.with_fixtures(f"""
select sample_id, think_idx, beam_idx, {_RESP_SQL} response
from (select *, {_RESP_V} v from candidates) c""", "candidates"))
def q_extract_response(spark, sf):
    return _response_variant(spark, sf).select(
        "sample_id", "think_idx", "beam_idx", txt.extract_response("v").alias("response"))


_CONV_CTE = """conv as (
select conv_id, count(*) n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                  order by turn) text
from conversations group by conv_id)"""


@query("loss_span", O.with_fixtures("""
select conv_id, n_turns, length(text) n_chars,
       cast(instr(text, '<|im_start|>user') - 1 as bigint) user_start,
       instr(text, '<|im_start|>user') = 0 masked
from conv
union all
select -1 - conv_id, count(*), sum(length('<|im_start|>' || role || text) + 12), -1, true
from conversations where role <> 'user' group by conv_id""", extra=[_CONV_CTE]))
def q_loss_span(spark, sf):
    turns = read_table(spark, sf, "conversations")
    # the same conversations without their user turns, under negative ids
    silent = turns.where(F.col("role") != "user").withColumn("conv_id", -1 - F.col("conv_id"))
    conv = chatf.conversation_text(turns.unionByName(silent))
    span = txt.loss_span("text")
    return conv.select("conv_id", "n_turns", F.length("text").cast("bigint").alias("n_chars"),
                       span["start"].alias("user_start"), span["masked"].alias("masked"))


def _verb_case(col: str) -> str:
    whens = " ".join(f"when {_q(k)} then {_q(v)}" for k, v in txt.BEHAVIOR_VERBS.items())
    return f"case {col} {whens} end"


_VERB_SQL = ("coalesce(" + _verb_case("behavior_subtype") + ", " + _verb_case("behavior_type")
             + ", " + _verb_case("event_type") + ")")


@query("behavior_verb", _bsql(f"select event_id, {_VERB_SQL} verb from plog"))
def q_behavior_verb(spark, sf):
    return _plog(spark, sf).select(
        "event_id", txt.behavior_verb("behavior_subtype", "behavior_type", "event_type")
        .alias("verb"))


_CATEGORY_SQL = """case when content_type is null then 'General Creation'
            when content_type = 0 then 'Image and Video Creation'
            when content_type = 1 then 'Image Creation' when content_type = 2 then 'Video Creation'
            else 'Content Type ' || cast(content_type as varchar) end ||
       case when photo_type is null then '' when photo_type = 1 then ' > Material'
            when photo_type = 2 then ' > Short Film'
            else ' > Type ' || cast(photo_type as varchar) end"""


@query("item_text_fields", _bsql(f"""
select event_id, {_CATEGORY_SQL} categories, description,
       coalesce(nullif(title, ''), nullif(substring(introduction, 1, 100), ''),
                nullif(substring(description, 1, 100), ''), 'Item ' || item_id) title
from (select *, case when length(coalesce(prompt, '')) > 1000
                     then substring(prompt, 1, 1000) || '...' else coalesce(prompt, '') end
                  description from plog) t"""))
def q_item_text_fields(spark, sf):
    p = _plog(spark, sf).withColumn("description", txt.truncate_description("prompt"))
    return p.select("event_id", txt.item_category("content_type", "photo_type").alias("categories"),
                    "description",
                    txt.item_title("title", "introduction", "description", "item_id").alias("title"))


@query("clean_text", O.with_fixtures(f"""
select event_id, {_clean('prompt')} prompt, {_clean('title')} title,
       {_clean('introduction')} introduction,
       {_clean('element_query_content')} element_query_content
from behaviors""", "behaviors"))
def q_clean_text(spark, sf):
    b = fx.behaviors(spark, sf)
    return b.select("event_id", *[txt.clean_text(c).alias(c) for c in
                                  ["prompt", "title", "introduction", "element_query_content"]])


@query("extract_all_sids", O.with_fixtures(f"""
select split, user_id, len(regexp_extract_all(description, '{O.SID_RE}')) n_sids,
       array_to_string(regexp_extract_all(description, '{O.SID_RE}'), ' ') sids
from sid_corpus""", "interactions", "catalog", extra=[_K2_CTE]))
def q_extract_all_sids(spark, sf):
    a = sidf.extract_all_sids("description")
    return _sid_corpus(spark, sf).select("split", "user_id", F.size(a).cast("bigint").alias("n_sids"),
                                         F.array_join(a, " ").alias("sids"))


@query("extract_first_sid", O.with_fixtures(f"""
select sample_id, think_idx, beam_idx, {O.first_sid('text')} first_sid from candidates""",
                                            "candidates"))
def q_extract_first_sid(spark, sf):
    return fx.candidates(spark, sf).select("sample_id", "think_idx", "beam_idx",
                                           sidf.extract_first_sid("text").alias("first_sid"))


_STRICT3 = r"<\|sid_begin\|>(?:<s_[a-d]_\d+>){3}<\|sid_end\|>"
_STRICT4 = r"<\|sid_begin\|>(?:<s_[a-d]_\d+>){4}<\|sid_end\|>"


@query("extract_sid_strict", O.with_fixtures(f"""
select sample_id, think_idx, beam_idx,
       nullif(regexp_extract(text, '{_STRICT3}', 0), '') strict3,
       nullif(regexp_extract(text, '{_STRICT4}', 0), '') strict4
from candidates""", "candidates"))
def q_extract_sid_strict(spark, sf):
    return fx.candidates(spark, sf).select(
        "sample_id", "think_idx", "beam_idx",
        sidf.extract_sid_strict("text", 3).alias("strict3"),
        sidf.extract_sid_strict("text", 4).alias("strict4"))


@query("parse_format_sid", _bsql(f"""
select event_id, array_to_string(codes, ',') codes,
       case when len(codes) > 0 then '<|sid_begin|>' ||
         array_to_string(list_transform(codes[1:3], lambda x, i:
           '<' || ['s_a', 's_b', 's_c'][i] || '_' || cast(x as varchar) || '>'), '') ||
         '<|sid_end|>' end sid
from (select event_id, {_PARSED} codes from plog) t"""))
def q_parse_format_sid(spark, sf):
    p = _plog(spark, sf).withColumn("c", sidf.parse_semantic_id("semantic_id"))
    return p.select("event_id", F.array_join(F.transform("c", lambda x: x.cast("string")), ",")
                    .alias("codes"), sidf.format_sid("c").alias("sid"))


# ---------------------------------------------------- rationale gating (K8) ---

_GATE_CTE = f"""gated as (
select c.split, c.user_id, c.description, c.groundtruth,
       case when m.user_id is not null then c.title end title,
       case when m.user_id is not null then c.categories end categories,
       m.user_id is not null matched
from ra_corpus c left join (
  select distinct sample_id user_id,
         nullif(regexp_extract(text, '{_STRICT3}', 0), '') sid
  from candidates) m
  on m.user_id = c.user_id and m.sid = nullif(regexp_extract(c.groundtruth, '{_STRICT3}', 0), ''))"""


def _gsql(body: str) -> str:
    return O.with_fixtures(body, "interactions", "catalog", "candidates",
                           extra=[_K4_CTE, _GATE_CTE])


def _k8_cands(spark, sf):
    return fx.candidates(spark, sf).withColumn("user_id", F.col("sample_id").cast("string"))


@query("gate_rationales", _gsql("select split, user_id, title, categories, matched from gated"))
def q_gate_rationales(spark, sf):
    preds = _k8_cands(spark, sf)
    g = metrics_ops.gate_rationales(_ra_corpus(spark, sf), preds.select("user_id", "text"))
    return g.select("split", "user_id", "title", "categories", "matched")


@query("reconstruct_epoch_data", _gsql(f"""
select split, user_id, description, groundtruth, title, categories, matched,
       {_rationale_sql()} text from gated"""))
def q_reconstruct_epoch_data(spark, sf):
    out = evaluation.reconstruct_epoch_data(_ra_corpus(spark, sf), _k8_cands(spark, sf))
    return out.select("split", "user_id", "description", "groundtruth", "title", "categories",
                      "matched", "text")


@query("match_rate", _gsql("""
select count(*) "rows", count(*) filter (where matched) matched,
       round(count(*) filter (where matched) / count(*), 6) rate from gated"""))
def q_match_rate(spark, sf):
    return evaluation.reconstruct_match_rate(_ra_corpus(spark, sf), _k8_cands(spark, sf))


# ------------------------------------------------------- sources and sinks ---

def _sequence_text(spark, sf):
    """Sequence-file lines derived from the interactions, with the whitespace
    variants real files have (tabs, padding, blank lines)."""
    inter = fx.interactions(spark, sf)
    lines = ordered_concat(inter, ["user_id"], "pos", "item_id", " ", "items")
    u = fx.customer_number()
    body = F.concat_ws(" ", "user_id", "items")
    value = (F.when(u % 11 == 0, F.lit("   "))
             .when(u % 4 == 1, F.concat(F.lit("  "), F.regexp_replace(body, " ", "\t  "),
                                        F.lit(" \t")))
             .otherwise(body))
    return lines.select(value.alias("value"))


_SEQ_TEXT_CTE = """seqtext as (
select case when cast(split_part(user_id, '-', 1) as bigint) % 11 = 0 then '   '
            when cast(split_part(user_id, '-', 1) as bigint) % 4 = 1
              then '  ' || replace(user_id || ' ' || items, ' ', chr(9) || '  ') || ' ' || chr(9)
            else user_id || ' ' || items end value
from (select user_id, string_agg(item_id, ' ' order by pos) items
      from interactions group by user_id) t)"""


@query("read_sequences", O.with_fixtures("""
select toks[1] user_id, cast(len(toks) - 1 as bigint) n_items,
       array_to_string(toks[2:], ' ') items
from (select string_split_regex(trim(value, ' ' || chr(9)), '\\s+') toks from seqtext) t
where len(toks) > 1""", "interactions", extra=[_SEQ_TEXT_CTE]))
def q_read_sequences(spark, sf):
    parsed = readers.parse_sequence_lines(_sequence_text(spark, sf))
    agg = ordered_concat(parsed, ["line_id", "user_id"], "pos", "item_id", " ", "items", "n_items")
    return agg.select("user_id", F.col("n_items").cast("bigint").alias("n_items"), "items")


@query("read_item_catalog", O.with_fixtures(
    "select item_id, title, description, categories, sid from catalog", "catalog"))
def q_read_item_catalog(spark, sf):
    lines = writers.catalog_json_lines(fx.catalog(spark, sf))
    return readers.parse_catalog_json(lines)


@query("read_eval_set", O.with_fixtures("""
select coalesce(case when cast(split_part(user_id, '-', 1) as bigint) % 5 = 0 then null
                     else user_id end,
                'user_' || cast(row_number() over (order by user_id) - 1
                                as varchar)) user_id,
       description, groundtruth
from sid_corpus where split = 'test'""", "interactions", "catalog", extra=[_K2_CTE]))
def q_read_eval_set(spark, sf):
    t = _test_corpus(spark, sf).withColumn("uid", F.col("user_id")).withColumn(
        "user_id", F.when(fx.customer_number("uid") % 5 != 0, F.col("uid")))
    return readers.eval_set(t.select("user_id", "uid", "description", "groundtruth"),
                            key="uid").select("user_id", "description", "groundtruth")


@query("stream_positive_behaviors", _bsql(_present_log_sql()))
def q_stream_positive_behaviors(spark, sf):
    from .streaming.behaviors import stream_positive_behaviors
    root = scratch_path(spark, "stream")
    # the partitioned log itself is the stream's source
    return _present_log(stream_positive_behaviors(
        spark, fx.behavior_path(spark, sf), fx.behavior_schema(spark, sf), f"{root}/out", f"{root}/checkpoint",
        rows=fx.behavior_rows(spark, sf)))


def _stub_scorer(pdf):
    """Deterministic stand-in model for J1: beam b proposes the b-th most
    recent SID of the prompt's history, score -b."""
    import pandas as pd
    from .functions.sid import sid_regex
    recent = pdf["prompt"].str.findall(sid_regex(3)).map(lambda sids: sids[:-6:-1])
    out = pd.DataFrame({"sample_id": pdf["sample_id"], "think_idx": 0, "sid": recent}).explode("sid")
    out = out[out["sid"].notna()]
    out["beam_idx"] = out.groupby(level=0).cumcount()
    out["text"] = "<think>\n\n</think>\n" + out["sid"]
    out["score"] = -out["beam_idx"].astype(float)
    return out[["sample_id", "think_idx", "beam_idx", "text", "score"]]


@query("generate_candidates", O.with_fixtures(f"""
select user_id sample_id, 0 think_idx, cast(b.i as integer) beam_idx,
       '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || s[len(s) - b.i] text,
       cast(-b.i as double) score
from (select user_id, regexp_extract_all(description, '{O.SID_RE}') s from sid_corpus
      where split = 'test') t, range(0, 5) b(i)
where b.i < len(s)""", "interactions", "catalog", extra=[_K2_CTE]))
def q_generate_candidates(spark, sf):
    prompts = _test_corpus(spark, sf).select(F.col("user_id").alias("sample_id"),
                                             F.col("description").alias("prompt"))
    return cand.generate_candidates(prompts, _stub_scorer)


# ---------------------------------------------------------- persona (K1) ---

_DET_CTE = """det as (
select p.*, i.sid, i.title i_title, i.categories i_categories, i.description i_description
from (select user_id,
             row_number() over (partition by user_id order by time_stamp nulls last, event_id) idx,
             item_id, coalesce(event_type, 'UNKNOWN') event_type,
             coalesce(behavior_type, '') behavior_type,
             coalesce(behavior_subtype, '') behavior_subtype,
             coalesce(element_query_content, '') q,
             coalesce(try_cast(query_cnt as bigint), 0) query_cnt
      from prows) p
left join items i using (item_id))"""

_RES_CTE = """res as (
select *, row_number() over (partition by user_id order by idx desc) rr,
       count(*) over (partition by user_id) n
from det where coalesce(sid, '') <> '')"""

_CUTS_CTE = """cuts as (
select s.split, r.user_id, r.idx cut, r.sid groundtruth, r.i_title title,
       r.i_categories categories
from res r join (values ('train', 2), ('val', 1), ('test', 0)) s(split, k)
  on r.rr = s.k + 1 and r.n >= s.k + 2)"""

_D_VERB = (_VERB_SQL.replace("behavior_subtype", "d.behavior_subtype")
           .replace("behavior_type", "d.behavior_type").replace("event_type", "d.event_type"))

_CLAUSES_CTE = f"""clauses as (
select c.user_id, c.split, min(d.idx) * 3 o,
       'searched for ' || chr(39) || d.q || chr(39) || ' ' || cast(max(d.query_cnt) as varchar)
         || ' times' clause
from det d join cuts c on c.user_id = d.user_id and d.idx < c.cut
where d.event_type = 'SEARCH' and d.q <> '' group by c.user_id, c.split, d.q
union all
select c.user_id, c.split, d.idx * 3 + 1,
       'created content with prompt ' || chr(39) || d.i_description || chr(39)
from det d join cuts c on c.user_id = d.user_id and d.idx < c.cut
where d.event_type = 'PRODUCE' and d.i_description is not null
union all
select c.user_id, c.split, d.idx * 3 + 2,
       coalesce({_D_VERB}, 'interacted with') || ' item ' || d.sid || ', its title is ' ||
       chr(39) || coalesce(d.i_title, '') || chr(39) || ', its categories are ' || chr(39) ||
       coalesce(d.i_categories, '') || chr(39)
from det d join cuts c on c.user_id = d.user_id and d.idx < c.cut
where coalesce(d.sid, '') <> '')"""

_PERSONA_SQL = _bsql("""
select c.split, c.user_id, 'The user has ' || coalesce(h.history, '') || ';' description,
       c.groundtruth, c.title, c.categories
from cuts c left join (select user_id, split, string_agg(clause, '; ' order by o) history
                       from clauses group by user_id, split) h using (user_id, split)""",
                     _PARSEABLE_CTE, _LATEST_CTE, _ITEMS_CTE, _DET_CTE, _RES_CTE, _CUTS_CTE,
                     _CLAUSES_CTE)


@query("persona_parts", _bsql(f"""
select c.split, c.user_id, coalesce(a.part_no, 0) part_no, coalesce(a.part, '') part,
       case when coalesce(a.part_no, 0) = 0 then c.groundtruth end groundtruth,
       case when coalesce(a.part_no, 0) = 0 then c.title end title,
       case when coalesce(a.part_no, 0) = 0 then c.categories end categories
from cuts c left join (
  select split, user_id, cast(floor(ahead / {PART}) as bigint) part_no, string_agg(clause, '; ' order by o) part
  from (select *, coalesce(sum(length(clause) + 2) over (partition by split, user_id order by o
                           rows between unbounded preceding and 1 preceding), 0) ahead from clauses) l
  group by split, user_id, floor(ahead / {PART})) a on a.split = c.split and a.user_id = c.user_id""",
                              _PARSEABLE_CTE, _LATEST_CTE, _ITEMS_CTE, _DET_CTE, _RES_CTE, _CUTS_CTE,
                              _CLAUSES_CTE))
def q_persona_parts(spark, sf):
    return persona.persona_parts(_outline_log(spark, sf), metadata.item_metadata(_plog(spark, sf)), PART)


@query("persona_grounding", _PERSONA_SQL)
def q_persona_grounding(spark, sf):
    return persona.persona_grounding(_outline_log(spark, sf), metadata.item_metadata(_plog(spark, sf)))


@query("merge_shards", _gsql("""
select cast(floor((row_number() over (order by user_id) - 1) /
                  ceil(count(*) over () / 4.0)) as integer) shard,
       user_id, title, matched
from gated where split = 'test'"""))
def q_merge_shards(spark, sf):
    """Gate the test split, cut it into contiguous shards, and concatenate the shards' outputs in shard
    order (from files: :func:`.sources.readers.read_shards`)."""
    corpus = _ra_corpus(spark, sf).where(F.col("split") == "test")
    gated = metrics_ops.gate_rationales(corpus, _k8_cands(spark, sf).select("user_id", "text"))
    sharded = shared(metrics_ops.contiguous_shards(gated.select("user_id", "title", "matched"), 4, "ceil",
                                                   key="user_id"))
    outputs = [sharded.where(F.col("shard") == i).drop("shard") for i in range(4)]
    return metrics_ops.merge_shards(outputs).select("shard", "user_id", "title", "matched")


# -------------------------------------------------- sinks, written and read ---

@query("write_splits", _K2_SQL)
def q_write_splits(spark, sf):
    path = scratch_path(spark, "splits")
    writers.write_splits(_sid_corpus(spark, sf), path)
    return spark.read.parquet(path).select("split", "user_id", "description", "groundtruth")


_TSV_COLUMNS = ["event_id", "user_id", "item_id", "prompt", "title", "introduction", "semantic_id",
                "extra_info"]


@query("behavior_tsv", O.with_fixtures(
    "select " + ", ".join(f"coalesce(cast({c} as varchar), '') {c}" for c in _TSV_COLUMNS)
    + " from behaviors", "behaviors"))
def q_behavior_tsv(spark, sf):
    """A TSV holds no difference between null and empty, as in the reference."""
    path = scratch_path(spark, "tsv")
    writers.write_behavior_tsv(fx.behaviors(spark, sf).select(*_TSV_COLUMNS), path, compression="gzip")
    back = readers.read_behavior_tsv(spark, path)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in _TSV_COLUMNS])


@query("behavior_tsv_quoted", ORACLE["behavior_tsv"])
def q_behavior_tsv_quoted(spark, sf):
    """A6 on the quoted form, line ends inside fields, read in splits."""
    path = scratch_path(spark, "tsv-quoted")
    writers.write_behavior_tsv(fx.behaviors(spark, sf).select(*_TSV_COLUMNS), path, quoted=True,
                               compression="gzip")
    back = readers.read_behavior_tsv(spark, path, multi_line=True)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in _TSV_COLUMNS])


@query("write_sequences", O.with_fixtures("""
select user_id, pos, item_id from interactions""", "interactions"))
def q_write_sequences(spark, sf):
    path = scratch_path(spark, "sequences")
    writers.write_sequences(fx.interactions(spark, sf).select("user_id", "pos", "item_id"), path)
    return readers.read_sequences(spark, path).select("user_id", "pos", "item_id")


@query("write_behaviors", ORACLE["user_behavior_details"])
def q_write_behaviors(spark, sf):
    path = scratch_path(spark, "behaviors")
    details = bh.user_behavior_details(_outline_log(spark, sf))
    writers.write_behaviors(details, path)
    return spark.read.schema(details.schema).json(path)


@query("sid_prediction_lines", O.with_fixtures(
    "select split, split_part(user_id, ':', 2) user_id, description, groundtruth from sid_corpus",
    "interactions", "catalog", extra=[_K2_CTE.replace("from interactions i", """from (
        select (pos % 2) || ':' || user_id user_id, pos, item_id from interactions) i""")]))
def q_sid_prediction_lines(spark, sf):
    """Every user's purchases as two sequence lines of the same user."""
    lines = fx.interactions(spark, sf).withColumn("line_id", F.col("pos") % 2)
    out = corpora.by_line(corpora.sid_prediction_corpus, lines, fx.catalog(spark, sf))
    return out.select("split", "user_id", "description", "groundtruth")
