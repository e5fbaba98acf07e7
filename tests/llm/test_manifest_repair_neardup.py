"""Merkle manifest, conversation repair and vector near-duplicates against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from semrec.llm import merkle, neardup, queries, repair
from semrec.llm.common import table
from semrec.llm.numbering import numbered

import brute
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(brute.odd_rows(), brute.SCHEMA).repartition(3)


def as_set(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


# numbering ------------------------------------------------------------------

def test_numbers_are_dense_in_groups_over_many_ranges(spark):
    rows = [(g, i % 50, i) for i in range(700) for g in (("hot",) if i % 7 else ("hot", f"g{i}"))]
    df = spark.createDataFrame(rows, "g string, o int, __n int").repartition(5)
    got = {}
    for r in numbered(df, "g", ["o"]).collect():
        got.setdefault(r["g"], []).append((r["pos"], r["o"]))
    assert len(got["hot"]) == 700
    for v in got.values():
        assert [p for p, _ in sorted(v)] == list(range(len(v)))
        assert [o for _, o in sorted(v)] == sorted(o for _, o in v)
    assert numbered(df.limit(0), "g", ["o"]).count() == 0


# Merkle manifest --------------------------------------------------------------

def proved(rows, changed=None, **more):
    m = merkle.manifest(rows, changed=changed, **more)
    out = m.select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof"),
                   merkle.folded(F.col("changed_leaf"), F.col("path")).alias("folded"))
    return [(*r, r["folded"] == r["root"]) for r in out.collect()]


@pytest.mark.parametrize("step", [1, 2, 3, 8])
def test_manifest_of_odd_rows(odd, step):
    rows = [r.asDict() for r in odd.select(*merkle.FIELDS).collect()]
    bad = [i for i, r in enumerate(rows) if r["doc_id"] is not None and r["doc_id"] % 3 == 0]
    n = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = proved(odd, {"n_chars": n}, step=step)
    assert as_set(got) == as_set(brute.merkle(rows, set(bad)))
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_few_rows(spark, odd):
    for n in (0, 1, 2, 3):
        some = [r.asDict() for r in odd.select(*merkle.FIELDS).limit(n).collect()]
        df = spark.createDataFrame([tuple(r.values()) for r in some],
                                   "doc_id bigint, source string, lang string, n_chars bigint, text string")
        assert as_set(proved(df)) == as_set(brute.merkle(some))


def test_manifest_of_wider_runs_folds_to_its_root(odd):
    got = proved(odd, fanout=3, step=2)
    assert len(got) == odd.count() and all(r[-1] for r in got)


def test_only_every_few_levels_are_stored(spark):
    leaves = spark.range(300).select(F.lit("t").alias("tree"), F.col("id").alias("idx"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    m = merkle.grow(leaves, step=3)
    assert [d.count() for d in m.stored] == [300, 38, 5, 1]


def test_manifest_query_against_brute_force(spark):
    rows = [r.asDict() for r in table(spark, SF_SMALL, "documents", *merkle.FIELDS).collect()]
    bad = {i for i, r in enumerate(rows) if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, SF_SMALL).collect()]
    assert as_set(got) == as_set(brute.merkle(rows, bad))


# conversation repair ------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, key string, pos string, code string"


def random_turns(seed=5):
    rnd = random.Random(seed)
    said = ["Yes.", "No!", "why", "", " \n", "Really? ", "a b c.", "x", None, "long " * 4000 + "end."]
    rows = []
    for c in [*range(60), None]:
        for t in range(rnd.randint(0, 9)):
            rows.append((c, rnd.choice([t, t, t, t + 2, None]),
                         rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rnd.choice(said), "x", None, "y"))
    return rows + rows[:3] + [(77, t, rnd.choice(["user", "assistant"]), f"{t % 9}.", "x", "y", "z") for t in range(300)]


def expected(turns, ids):
    out = []
    for c in ids:
        got = brute.repair_one([r for r in turns if r[0] == c])
        text = "\n".join(f"{role}:{text}" for role, text in got[-1])
        out.append((c, *got[:-1], hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block", [1, 3, 256])
def test_repair_of_odd_conversations(spark, block):
    rows = random_turns()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    hurt = brute.damage([r[:4] for r in rows])
    assert as_set(repair.damaged(df).collect()) == as_set(hurt)
    reports, turns = repair.repair(repair.damaged(df), df, block)
    want = expected(hurt, {r[0] for r in rows})
    assert as_set(reports.collect()) == as_set(want)
    texts = {}
    for r in sorted(turns.collect(), key=lambda r: r["at"]):
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    digest = {w[0]: w[-1] for w in want}
    assert all(hashlib.sha256("\n".join(t).encode()).hexdigest() == digest[c] for c, t in texts.items())


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    reports, turns = repair.repair(none, none)
    assert reports.count() == 0 and turns.count() == 0
    ids = spark.createDataFrame([(1,), (None,)], "conv_id bigint")
    empty = hashlib.sha256(b"").hexdigest()
    assert as_set(repair.repair(none, ids)[0].collect()) == as_set(
        [(1, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)])


def test_search_finds_the_cheapest_and_least_audit():
    rnd = random.Random(8)
    kinds = [("system", "s."), ("user", "u."), ("assistant", "a."), ("tool", "t."), ("system", "s"), ("user", "u"),
             ("assistant", "a"), ("tool", "t")]
    for _ in range(400):
        picked = [rnd.randrange(8) for _ in range(rnd.randint(1, 12))]
        rows = [(0, i, kinds[k][0], f"{i} {kinds[k][1]}") for i, k in enumerate(picked)]
        rows = [(0, i, r, "" if rnd.random() < 0.1 else t) for _, i, r, t in rows]
        codes = "".join(chr(97 + k % 8 + (8 if not r[3] else 0)) if r[3] else chr(97 + (k & 3) + 8)
                        for k, r in zip(picked, rows))
        costs, audits = repair.block_paths(codes, True, True)
        assert (costs[0], audits[0]) == brute.repair_one(rows)[5:7], codes


def test_repair_query_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations", "conv_id", "turn", "role", "text").collect()]
    want = expected(brute.damage(rows), {r[0] for r in rows})
    assert as_set(queries.op12_conversation_repair(spark, SF_SMALL).collect()) == as_set(want)


# near-duplicate vectors ------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, cls string, lab string, v string"


def check_near(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", None, "y") for r in rows], VECTORS).repartition(3)
    got = neardup.near_duplicates(df, **more).collect()
    want = brute.near(rows, more.get("threshold", 0.93))
    assert as_set(got) == as_set([(r[0], *want[i]) for i, r in enumerate(rows)])


def test_near_duplicates_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [-1.0, 0.0], 1), (13, [1.0, 0.39], 1), (14, [1.0, 0.8], 1),
            (15, [1e300, -0.0], 1), (16, [1e-310, 0.0], 1), (None, [1.0, 0.0], 2), (None, [5.0, 5.0], 3),
            (None, None, None), (1, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (0, [0.0, 0.0], 1)]
    check_near(spark, rows, recall=0.99999)
    none = spark.createDataFrame([], VECTORS)
    assert neardup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("chunk", [3, 40, 1024])
def test_near_duplicates_in_large_groups(spark, chunk):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((4, 16))
    rows = []
    for i in range(240):
        v = base[i % 4] + rng.standard_normal(16) * (0.02 if i % 4 < 2 else 0.2)
        rows.append((i * 7 % 241, [float(x) for x in v], i % 2))
    rows += [(500 + i, rows[0][1], rows[0][2]) for i in range(40)]
    check_near(spark, rows, chunk=chunk, bits=3, tables=60)


def test_planned_tables_reach_their_recall():
    rng = np.random.default_rng(9)
    a = rng.standard_normal((20_000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * side  # exactly at the threshold
    for classes in (100, 5_000, 1_000_000):
        bits, tables = neardup.table_plan(classes, 0.93)
        planes = neardup.hyperplanes(32, bits, tables, 1)
        met = (neardup.sign_hashes(a, planes, bits) == neardup.sign_hashes(b, planes, bits)).any(axis=1)
        assert met.mean() > 0.95, (classes, bits, tables)


def test_near_duplicate_query_against_all_pairs(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "embeddings", "vec_id", "embedding", "label").collect()]
    want = brute.near(rows, 0.93)
    got = queries.op13_embedding_near_dedup(spark, SF_SMALL).collect()
    assert as_set(got) == as_set([(r[0], *want[i]) for i, r in enumerate(rows)])
