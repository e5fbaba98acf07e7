"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (balltree, jaccard, merkle, neardup, packing, pii, preference, quality, repair, sharding, spm,
               token_counts, toxicity)
from .common import frozen, table, text_of, vocabulary


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn(
        "digest", F.sha2(text_of().cast("binary"), 256))
    coded = spm.encode(docs, vocabulary("piece_bpe_32k.model"), keep_text=False, decoded="decoded")
    return coded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.crc32("ids").alias("ids_crc32"),
                        (F.sha2(F.col("decoded").cast("binary"), 256) == F.col("digest")).alias("round_trip"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = docs.select("doc_id", (F.octet_length(text_of()) + 16).cast("bigint").alias("size"),
                       F.crc32(text_of().cast("binary")).alias("text_crc32"))
    return sharding.assign_shards(rows, 40).select(
        "*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding").select(
        "vec_id", balltree.quantised("embedding").alias("v"))
    return balltree.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return quality.quality_verdicts(docs).select(
        "doc_id", *quality.STATS, "base_failed", "kept", "distance")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, vocabulary("byte_bpe_50k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    grammar = toxicity.learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return (toxicity.toxicity_scores(docs, grammar)
            .select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted"))


def op10_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    numbered = frozen(preference.numbered_turns(turns))  # both sides of every pair read it
    return preference.format_preferences(*preference.echo_pairs(numbered))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *merkle.FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    m = merkle.manifest(docs, changed={"n_chars": tampered})
    folded = merkle.folded(F.col("changed_leaf"), F.col("path"))
    return m.select("doc_id", "leaf", "subroot", "root",
                    merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"),
                    folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.repair(repair.damaged(turns), turns)[0]


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


QUERIES = {f.__name__: f for f in [op1_best_fit_packing, op2_pii, op3_sentencepiece, op4_sharding,
                                  op5_exact_top_k, op6_quality_rules,
                                  op7_ngram_jaccard,
                                  op8_token_counts, op9_toxicity, op10_preference_formatting,
                                  op11_merkle_manifest, op12_conversation_repair,
                                  op13_embedding_near_dedup]}

ORACLE: dict[str, str] = {}

ORACLE["op5_exact_top_k"] = """
with v as (
  select vec_id, [cast(floor(1024 * cast(x as double)) as double) for x in embedding] e
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
scored as (
  select q.vec_id query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e))
select query_id, cast(row_number() over best as integer) rank, vec_id, score
from scored
window best as (partition by query_id order by score desc, vec_id)
qualify row_number() over best <= 10
"""

ORACLE["op10_preference_formatting"] = """
with turns as (
  select distinct conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations),
numbered as (
  select conv_id, role, text,
         row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 pos
  from turns),
ends as (
  select conv_id, max(pos) filter (role = 'assistant') answer, max(pos) last_pos, arg_min(text, pos) opening
  from numbered group by conv_id),
rejected as (
  select n.conv_id, n.pos, n.role, case when n.pos = e.answer then e.opening else n.text end text
  from numbered n join ends e on n.conv_id is not distinct from e.conv_id
  where n.pos < coalesce(e.answer, e.last_pos) or n.pos = e.answer),
both_sides as (
  select coalesce(c.conv_id, r.conv_id) pair_id, coalesce(c.pos, r.pos) pos,
         c.role c_role, c.text c_text, r.role r_role, r.text r_text
  from numbered c full join rejected r
    on c.conv_id is not distinct from r.conv_id and c.pos = r.pos),
prefix as (
  select pair_id, min(pos) filter (c_role is distinct from r_role or c_text is distinct from r_text) stop
  from both_sides group by pair_id),
tagged as (
  select b.*, b.pos < coalesce(p.stop, 1000000000000) common
  from both_sides b join prefix p on b.pair_id is not distinct from p.pair_id),
parts as (
  select pair_id, 'prompt' part, pos, c_role role, c_text text from tagged where common
  union all
  select pair_id, 'chosen', pos, c_role, c_text from tagged where not common and c_role is not null
  union all
  select pair_id, 'rejected', pos, r_role, r_text from tagged where not common and r_role is not null),
rendered as (
  select pair_id, part, pos, role,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) rendered from parts)
select pair_id, part, pos, role, rendered,
       cast(sum(length(rendered)) over upto as bigint) - length(rendered) as "start",
       cast(sum(length(rendered)) over upto as bigint) as "end",
       part = 'prompt' or role <> 'assistant' masked
from rendered
window upto as (partition by pair_id, part order by pos)
"""

ORACLE["op11_merkle_manifest"] = """
with recursive rows_in as (
  select doc_id, coalesce('=' || lang, '-') tree, doc_id::varchar id_text, n_chars,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') head,
         coalesce(strlen(text) || ':' || text, '-') tail
  from documents),
hit as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint, [ord(c)::bigint for c in split(id_text, '')]),
                lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                         lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 7 = 0 hit
  from rows_in),
leaves as (
  select doc_id, tree,
         sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) leaf,
         sha256(head || coalesce(strlen((n_chars + hit::int)::varchar) || ':' || (n_chars + hit::int), '-') || tail) changed
  from (select * replace (coalesce(hit, false) as hit) from hit)),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 idx,
         count(*) over (partition by tree) n
  from leaves),
nodes as (
  select tree, 0 level, idx, n, leaf digest from placed
  union all
  select tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by idx))
  from nodes where n > 1 group by tree, level, n, idx // 2),
subroots as (
  select tree, digest subroot, row_number() over (order by tree) - 1 idx, count(*) over () n
  from nodes where n = 1),
upper_nodes as (
  select 0 level, idx, n, subroot digest from subroots
  union all
  select level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by idx))
  from upper_nodes where n > 1 group by level, n, idx // 2),
steps as (
  select p.tree, p.idx, l.level, ((p.idx >> l.level) % 2)::varchar || coalesce(s.digest, '') step
  from placed p join (select distinct tree, level from nodes where n > 1) l on p.tree = l.tree
  left join nodes s on s.tree = p.tree and s.level = l.level and s.idx = xor(p.idx >> l.level, 1::bigint)),
upper_steps as (
  select r.tree, l.level, ((r.idx >> l.level) % 2)::varchar || coalesce(s.digest, '') step
  from subroots r join (select distinct level from upper_nodes where n > 1) l on true
  left join upper_nodes s on s.level = l.level and s.idx = xor(r.idx >> l.level, 1::bigint)),
paths as (select tree, idx, list(step order by level) path from steps group by tree, idx),
upper_paths as (select tree, list(step order by level) path from upper_steps group by tree),
proved as (
  select p.*, r.subroot, (select digest from upper_nodes where n = 1) root,
         list_concat(coalesce(a.path, []), coalesce(b.path, [])) path
  from placed p join subroots r on p.tree = r.tree
  left join paths a on a.tree = p.tree and a.idx = p.idx left join upper_paths b on b.tree = p.tree),
done as (
  select doc_id, leaf, subroot, root, sha256(array_to_string([s[2:] for s in path], '')) proof_sha256,
         list_reduce(list_prepend(changed, path), lambda a, s:
           sha256(case when s[1] = '1' then s[2:] || a else a || s[2:] end)) folded_root
  from proved)
select *, folded_root = root verified from done
"""
