"""DuckDB spellings of the derived tables, used by the correctness oracle.

Each oracle query in ``__spark_entry__.oracle_sql()`` is ``WITH <fixtures>
<body>``, run by DuckDB over the same parquet views the Spark jobs read.
DuckDB notes: ``||`` propagates nulls like Spark's ``concat``; ``//`` is
integer division; ``chr(n)`` takes a code point.
"""

from __future__ import annotations

# Python-style strip set for DuckDB trim(): whitespace seen in the data plus
# the Unicode line separators.
WS = ("(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || "
      "chr(30) || chr(31) || chr(133) || chr(160) || chr(8232) || chr(8233) || chr(12288))")

SID_RE = r"<\|sid_begin\|><s_a_\d+><s_b_\d+><s_c_\d+><\|sid_end\|>"


def strip(expr: str) -> str:
    return f"trim({expr}, {WS})"


def first_sid(expr: str) -> str:
    return (f"(case when regexp_extract({expr}, '{SID_RE}', 0) <> '' "
            f"then regexp_extract({expr}, '{SID_RE}', 0) else {strip(expr)} end)")


def normalize_prediction(expr: str) -> str:
    tail = f"string_split({expr}, '</think>')[-1]"
    return first_sid(f"replace({strip(tail)}, ' ', '')")


FIXTURES: dict[str, str] = {}

FIXTURES["catalog"] = """
catalog as (
  select cast(p_partkey as varchar) item_id,
         case when p_partkey % 23 = 0 then '' else p_name end title,
         p_type || ' > ' || p_brand categories,
         'about ' || p_name description,
         case when p_partkey % 19 = 0 then null else
           '<|sid_begin|><s_a_' || cast(p_partkey % 256 as varchar) ||
           '><s_b_' || cast((p_partkey // 256) % 256 as varchar) ||
           '><s_c_' || cast((p_partkey * 7 + p_size) % 256 as varchar) || '><|sid_end|>' end sid,
         p_partkey
  from part where p_partkey % 17 <> 0)"""

FIXTURES["interactions"] = """
interactions as (
  select cast(o_custkey as varchar) ||
           case when o_custkey % 3 = 0 then '-' || cast((p - 1) // (o_custkey % 7 + 1) as varchar)
                else '' end user_id,
         case when o_custkey % 3 = 0 then (p - 1) % (o_custkey % 7 + 1) + 1 else p end pos,
         cast(l_partkey as varchar) item_id, o_custkey, l_partkey
  from (select o_custkey, l_partkey,
               row_number() over (partition by o_custkey
                                  order by l_shipdate, l_orderkey, l_linenumber, l_partkey) p
        from lineitem join orders on l_orderkey = o_orderkey) t)"""

FIXTURES["behaviors"] = """
behaviors as (
  select cast(e.user_id as varchar) user_id,
    cast((e.event_id * 13) % (select count(*) from documents) as varchar) item_id,
    case when e.event_id % 13 = 0 then null when e.event_id % 13 = 12 then 5
         else cast(e.event_id % 2 + 1 as integer) end photo_type,
    case e.event_type when 'purchase' then 'PRODUCE' when 'signup' then 'SEARCH'
                      when 'error' then null else 'RECOMMEND' end event_type,
    case when e.event_type = 'purchase' then 'PRODUCE'
         when e.event_id % 5 = 0 then 'VIDEO_PLAY_FINISH' when e.event_id % 5 = 1 then 'LONG_PLAY'
         when e.event_id % 5 = 2 then 'SHORT_PLAY' else 'OPERATE' end behavior_type,
    case e.event_id % 8 when 0 then 'LIKE' when 1 then 'UNLIKE' when 2 then 'COMMENT'
         when 3 then 'SHARE' when 4 then 'SAME_STYLE' when 5 then 'REPORT' when 6 then 'LARGE'
         else 'NONE' end behavior_subtype,
    case when e.event_id % 3 = 0 then 'App' else 'Web' end platform_type,
    case when e.event_id % 41 = 0 then null else e.ts end time_stamp,
    case when e.event_id % 11 = 0 then null when e.event_id % 11 = 10 then 7
         else cast(e.event_id % 3 as integer) end content_type,
    case when e.event_id % 47 = 0 then null
         when e.event_id % 5 = 4 then d.text || chr(13) || 'tail' else d.text end prompt,
    case when e.event_id % 4 = 0 then '' when e.event_id % 4 = 1 then null
         else 'Work ' || cast((e.event_id * 13) % (select count(*) from documents) as varchar) ||
              case when e.event_id % 10 = 2 then chr(13) || 'cut' else '' end end title,
    case when e.event_id % 6 = 0 then null when e.event_id % 6 = 3 then ''
         else d.text || chr(8232) || 'intro' end introduction,
    case when e.event_type = 'signup' then
      case when e.event_id % 5 = 0 then '' when e.event_id % 5 = 1 then null
           else 'query ' || cast(e.event_id % 7 as varchar) || chr(8233) end end element_query_content,
    '{"played_dur":"' || case when e.event_id % 29 = 0 then 'n/a'
        else cast(cast(json_extract_string(e.props, '$.k') as integer) % 11 as varchar) end ||
      '","element_action":"' || case when e.event_id % 2 = 0 then 'FANC_CARD' else 'OTHER' end ||
      '","query_cnt":' || cast(e.event_id % 9 as varchar) || '}' extra_info,
    case when e.event_id % 53 = 0 then null when e.event_id % 31 = 0 then ''
         when e.event_id % 37 = 0 then '[1,' when e.event_id % 43 = 0 then '[]'
         when e.event_id % 59 = 0 then '[1,2,3] x' when e.event_id % 61 = 0 then '[1,2,3]]'
         when e.event_id % 67 = 0 then '[1,null]' when e.event_id % 71 = 0 then '(1,2,3)'
         when e.event_id % 73 = 0 then '[1,2,]'
         else ' [' || cast(e.event_id % 256 as varchar) || ',' || cast(e.user_id % 256 as varchar) ||
              ',' || cast((e.event_id * 13) % (select count(*) from documents) as varchar) || '] ' end semantic_id,
    strftime(e.ts, '%Y%m%d') p_date,
    e.event_id
  from events e left join documents d on d.doc_id = (e.event_id * 13) % (select count(*) from documents))"""

FIXTURES["truth"] = """
truth as (
  select i.user_id sample_id, arg_max(k.sid, i.pos) groundtruth
  from interactions i join catalog k on i.l_partkey = k.p_partkey
  where k.sid is not null
  group by i.user_id having count(*) >= 2)"""

FIXTURES["candidates"] = """
candidates as (
  select g.sample_id, g.groundtruth, cast(g.think_idx as integer) think_idx,
    cast(g.beam_idx as integer) beam_idx,
    '<think>' || chr(10) || 'reason ' || cast(g.think_idx as varchar) || chr(10) || '</think>' ||
      chr(10) ||
      case when (g.s * 7 + g.think_idx * 3 + g.beam_idx) % 23 = 0 then g.groundtruth
           when (g.s + g.beam_idx) % 13 = 0 then 'no id here'
           else coalesce(k.sid, 'unknown') end text,
    -cast((g.s * 31 + g.think_idx * 17 + g.beam_idx * 29) % 97 as double) / 10 score
  from (select t.sample_id, t.s, t.groundtruth, a.x think_idx, b.x beam_idx
        from (select *, cast(split_part(sample_id, '-', 1) as bigint) s from truth) t,
             range(0, 5) a(x), range(0, 10) b(x)
        where t.s % 29 <> 0 and (t.s % 10 <> 0 or b.x < 4)) g
  left join catalog k on k.p_partkey =
    (g.s * 37 + g.think_idx * 5 + g.beam_idx * 3) % (select count(*) from part))"""

# Dependencies between the fixtures (emitted in this order).
_ORDER = ["catalog", "interactions", "behaviors", "truth", "candidates"]
_DEPS = {"truth": ["catalog", "interactions"], "candidates": ["truth", "catalog"]}


def with_fixtures(body: str, *names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding ``names`` (plus their dependencies) then ``body``.

    ``extra`` are additional ``name as (...)`` CTE strings appended after the
    fixtures, in order.
    """
    need: set[str] = set()

    def add(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in _DEPS.get(n, []):
            add(d)

    for n in names:
        add(n)
    ctes = [FIXTURES[n].strip() for n in _ORDER if n in need] + [e.strip() for e in extra or []]
    if not ctes:
        return body.strip()
    return "with " + ",\n".join(ctes) + "\n" + body.strip()
