"""Sharding, search, joins, preferences and the pipeline against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from scripts.oracle_check import TABLES, digest
from semrec.llm import balltree, jaccard, preference, queries, sharding, shingles
from semrec.llm.common import table
from semrec.llm.components import components

import brute
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(brute.odd_rows(), brute.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, con, name):
    got, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert digest(got)[0] == digest(want)[0]


def test_every_operator_is_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


# sharding -----------------------------------------------------------------

def test_shards_of_odd_rows(odd):
    rows = sharding.assign_shards(odd, 7).collect()
    assert len(rows) == odd.count()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(v) for v in slots.values()] + [0] * (7 - len(slots))
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.assign_shards(odd.limit(0), 7).count() == 0


def test_shards_do_not_depend_on_the_layout(odd):
    a = sharding.assign_shards(odd, 5).select("doc_id", "text", "shard", "slot")
    b = sharding.assign_shards(odd.repartition(11), 5).select("doc_id", "text", "shard", "slot")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def plain_permuted(x, n, seed, rounds):
    """The Feistel walk of one number in plain Python."""
    a = max(1, math.isqrt(n - 1) + 1)
    b = max(1, -(-n // a))
    keys, k, prime = [], (seed * 2654435761 + 97) % 2147483647, 2147483647
    for _ in range(rounds):
        k = (k * 48271 + 11) % prime
        keys.append(k)

    def mix(v, key):
        y = (v + key) % prime
        return (y * y % prime * y + key) % prime

    while True:
        left, right = x % a, x // a
        for i, key in enumerate(keys):
            if i % 2 == 0:
                left = (left + mix(right, key)) % a
            else:
                right = (right + mix(left, key)) % b
        x = left + right * a
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997, 4096, 5000])
def test_permutation_equals_its_plain_version(spark, n):
    for seed in (0, 7):
        p = spark.range(n).select("id", sharding.permuted(F.col("id"), F.lit(n).cast("bigint"), seed=seed).alias("p"))
        assert all(r["p"] == plain_permuted(r["id"], n, seed, sharding.ROUNDS) for r in p.collect())


def test_copies_of_one_row_are_written_out_by_many_tasks(spark):
    rows = spark.range(200_000).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    placed = sharding.assign_shards(rows, 40)
    sizes = [r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("m")).collect()]
    assert sum(sizes) == 200_000 and max(sizes) - min(sizes) <= 1
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which joins small partitions
    try:
        tasks = sharding.row_numbers(rows).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 100_000


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997, 4096, 5000])
def test_permutation_is_a_bijection(spark, n):
    p = spark.range(n).select(sharding.permuted(F.col("id"), F.lit(n).cast("bigint"), seed=3).alias("p"))
    assert sorted(r["p"] for r in p.collect()) == list(range(n))


# exact top-k --------------------------------------------------------------

def brute_top(vectors, ids, k):
    out = []
    for q, i in zip(vectors, ids):
        if i % 100 == 0:
            scores = vectors @ q
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out += [(int(i), r + 1, int(ids[j]), int(scores[j])) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("big", [1, 10 ** 7])
def test_top_k_with_ties_and_small_shards(spark, big):
    rng = np.random.default_rng(2)
    v = rng.integers(-3, 4, (700, 5)) * big
    v[100:300] = v[0]  # one very common vector
    ids = np.arange(700)
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id bigint, v array<bigint>")
    got = balltree.top_k(df, df.where("vec_id % 100 = 0"), k=10, shard_rows=90, block_queries=3)
    assert sorted(map(tuple, got.collect())) == brute_top(v, ids, 10)


def test_top_k_of_odd_rows(spark):
    rows = [(0, [0.5, -0.25]), (0, [0.5, -0.25]), (1, None), (2, [float("nan"), 1.0]), (3, [1.0, None]),
            (4, [float("inf"), 1.0]), (5, []), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, [0.1, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    v = df.select("vec_id", balltree.quantised("embedding").alias("v"))
    got = balltree.top_k(v, v.where("vec_id % 100 = 0")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 7, 512 * 102)]
    assert balltree.top_k(v.limit(0), v.limit(0)).count() == 0


# n-gram Jaccard join ------------------------------------------------------

def as_set(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (1, 60)])
def test_links_of_odd_rows(odd, words, percent):
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = jaccard.linked_documents(odd, words, percent).collect()
    assert as_set(got) == as_set(brute.components(docs, words, percent))
    assert jaccard.linked_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4, 512])
def test_links_in_a_large_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "SHORT_LIST", 5)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.choice(60, rng.integers(0, 5), replace=False):
            w[at] = f"x{rng.integers(0, 9)}"
        rows.append((i, " ".join(w[:rng.integers(50, 61)]) + f" e{i % 40}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for words, percent in ((2, 80), (1, 90)):
        got = jaccard.linked_documents(docs, words, percent).collect()
        assert as_set(got) == as_set(brute.components(rows, words, percent))


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_combinations_of_long_sets_stay_linear_and_meet(percent):
    rng = np.random.default_rng(percent)
    for n in (14, 40, 511, 640, 1023, 1030, 5000, 20_000):
        s = np.unique(rng.integers(0, 1 << 63, n + 50, dtype=np.uint64))[:n]
        own = jaccard.combinations(s[:jaccard.prefix_length(n, percent)], n, percent)
        assert len(own) < 12 * n
        for keep in (-(-percent * n // 100), n - n // 20):  # a part of the set, and one more changed
            for other in (rng.choice(s, keep, replace=False),
                          np.r_[rng.choice(s, n - (n - keep) // 3, replace=False),
                                rng.integers(0, 1 << 63, (n - keep) // 3, dtype=np.uint64)]):
                other = np.unique(other)
                common = len(np.intersect1d(s, other))
                if 100 * common < percent * (n + len(other) - common):
                    continue
                theirs = jaccard.combinations(other[:jaccard.prefix_length(len(other), percent)],
                                              len(other), percent)
                assert len(np.intersect1d(own, theirs)), (n, len(other))


def test_links_of_the_documents(spark):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text")
    want = brute.components([tuple(r) for r in docs.collect()], 4, 85)
    assert as_set(queries.op7_ngram_jaccard(spark, SF_SMALL).collect()) == as_set(want)


def test_one_document_of_each_group_stays(odd):
    left = jaccard.one_per_group(odd)
    assert left.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    groups = {}
    for (d, t), (_, n, c) in zip(rows, brute.components(rows, 5, 80)):
        groups.setdefault(c if n else ("empty", d, len(groups)), []).append((d, t))
    assert left.count() == len(groups)
    kept = {(r["doc_id"], r["text"]) for r in left.select("doc_id", "text").collect()}
    assert all(sum((d, t) in kept for d, t in set(v)) == 1 for v in groups.values())


def test_shingle_sets_equal_word_tuples():
    texts = [r[1] for r in brute.odd_rows()]
    for k in (1, 4, 5):
        sets = [brute.shingles(t, k) for t in texts]
        own = [shingles.shingle_set(t, k) for t in texts]
        assert [len(s) for s in own] == [len(s) for s in sets]
        for i in range(0, len(texts), 7):
            for j in range(len(texts)):
                assert len(np.intersect1d(own[i], own[j])) == len(sets[i] & sets[j])


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(5)
    names = [int(x) for x in rng.permutation(1000)]
    edges = list(zip(names[:300], names[1:301])) + [(names[400], x) for x in names[401:600]] + [(7, 7)]
    got = {r["node"]: r["label"] for r in
           components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({got[x] for x in names[:301]}) == 1 and len({got[x] for x in names[400:600]}) == 1
    assert len(set(got.values())) == 2


# preferences --------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, part string"


def test_preferences_of_odd_turns(spark):
    rows = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "yo", "x"), (1, 1, "assistant", "yo", "x"),
            (1, 2, "user", None, "x"), (1, 3, "assistant", "end", "x"), (2, 0, "user", "alone", "x"),
            (3, None, None, "t", None), (3, 5, "assistant", "t", None), (None, 0, "user", "n", "x"),
            (None, 1, "assistant", "m", "x"), (4, 0, "assistant", "same", "x")]
    turns = spark.createDataFrame(rows, TURNS)
    got = preference.format_preferences(*preference.echo_pairs(preference.numbered_turns(turns))).collect()
    parts = {}
    for r in sorted(got, key=lambda r: (r["pair_id"] is None, r["pair_id"], r["part"], r["pos"])):
        key = (r["pair_id"], r["part"])
        assert r["start"] == len(parts.get(key, ""))
        parts[key] = parts.get(key, "") + r["rendered"]
        assert r["end"] == len(parts[key])
        assert r["masked"] == (r["part"] == "prompt" or r["role"] != "assistant")

    def said(*turns):
        return "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)

    assert parts == {
        (1, "prompt"): said(("user", "hi"), ("assistant", "yo"), ("user", "")),
        (1, "chosen"): said(("assistant", "end")), (1, "rejected"): said(("assistant", "hi")),
        (2, "chosen"): said(("user", "alone")),
        (3, "prompt"): said(("", "t"), ("assistant", "t")),
        (None, "prompt"): said(("user", "n")), (None, "chosen"): said(("assistant", "m")),
        (None, "rejected"): said(("assistant", "n")), (4, "prompt"): said(("assistant", "same"))}
    assert preference.numbered_turns(turns.limit(0)).count() == 0


def test_a_long_conversation_is_numbered_in_blocks(spark):
    turns = spark.range(1000).select(F.lit(1).alias("conv_id"), (F.col("id") * 3).alias("turn"),
                                     F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = {r["text"]: r["pos"] for r in preference.numbered_turns(turns).collect()}
    assert got == {str(i): i for i in range(1000)}


# pipeline -----------------------------------------------------------------

def test_pipeline_stages(spark, tmp_dir):
    docs = table(spark, SF_SMALL, "documents")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
        if k < 4:
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    want = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "ids_crc32", "length")
    assert as_set(want.collect()) == as_set(docs.select("doc_id", "ids_crc32", "length").collect())
