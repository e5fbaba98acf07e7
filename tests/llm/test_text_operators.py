"""Operators on single texts against the libraries and plain Python versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from semrec.llm import packing, pii, quality, queries, spm, token_counts, toxicity
from semrec.llm.common import table, vocabulary

from brute import BASE, SCHEMA, base_spans, odd_rows, statistics
from conftest import SF_SMALL

PACK, COUNT, MODEL = map(vocabulary, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def raw(ids):
    return np.array(ids, dtype="<u4").tobytes()


def check_packing(docs, pieces, capacity):
    lib = Tokenizer.from_file(PACK)
    want = sorted(((d, raw(lib.encode(t or "", add_special_tokens=False).ids + [0])) for d, t in docs),
                  key=str)
    places = {}
    for r in pieces:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    made = []
    for d, b in want:
        for k, at in enumerate(range(0, len(b), 4 * capacity)):
            part = b[at:at + 4 * capacity]
            made.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
    got = [tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in pieces]
    assert sorted(got, key=str) == sorted(made, key=str)
    return len(places)


def test_packing_of_odd_rows(odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows = packing.pack_documents(odd, PACK, capacity=64, open_bins=8).collect()
    check_packing(docs, rows, 64)
    assert packing.pack_documents(empty, PACK).count() == 0
    ids = packing.pack_documents(odd, PACK, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in ids)


def test_packing_uses_few_sequences_whatever_the_partitions(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents", "doc_id", "text").collect()]
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = queries.op1_best_fit_packing(spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
    n = check_packing(docs, rows, packing.CAPACITY)
    least = -(-sum(r["length"] for r in rows) // packing.CAPACITY)
    assert n <= least * 1.02 + 1


def test_packing_deals_many_sequences_to_several_tasks(spark, monkeypatch):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text")
    pieces = packing.token_pieces(docs, PACK)
    least = pieces.agg({"length": "sum"}).first()[0] // packing.CAPACITY
    monkeypatch.setattr(packing, "TASK_SEQUENCES", 10)
    assert packing.pack_tasks(pieces) == min(8, least // 10) > 1


def test_document_ids_over_two_to_the_53_survive_beside_null(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, "one"), (None, "two"), (-big, None)], "doc_id bigint, text string").coalesce(1)
    assert {r["doc_id"] for r in packing.pack_documents(df, PACK).collect()} == {big, None, -big}


def test_bounded_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    b = packing.BestFit(10, open_bins=2)
    assert [b.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert b.n_open == 0
    b = packing.BestFit(10, open_bins=2)
    assert [b.place(n) for n in (5, 6, 7)] == [(0, 0), (1, 0), (2, 0)]
    assert b.n_open == 2  # the bin with 3 left closed
    assert b.place(3) == (1, 6)


def test_word_encoder_equals_the_library():
    lib, own, rnd = Tokenizer.from_file(PACK), packing.WordEncoder(PACK), random.Random(5)
    letters = "aAbBzZ .,.,\n\t'\"-_1ñÉßΣİ̱́é日<|>½²ǅ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    texts += ["İ. x", "ΑΣ. b", "f<|endoftext|>. g", "ﬁ. ǅ,"]
    want = [raw(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert list(own.encode_all(texts)) == want


def test_word_encoder_matches_added_tokens_in_the_raw_text():
    lib, own, rnd = Tokenizer.from_file(PACK), packing.WordEncoder(PACK), random.Random(9)
    parts = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>",
             "<|", "|>", "a", "The", "É", " ", " ", ". ", ", ", "\n"]
    texts = ["a <|ENDOFTEXT|> b"] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12)))
                                     for _ in range(3000)]
    want = [raw(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert list(own.encode_all(texts)) == want


def test_token_counts_of_odd_rows(odd, empty):
    lib = Tokenizer.from_file(COUNT)
    texts = [r["text"] or "" for r in odd.select("text").collect()]
    want = sorted((len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids)) for t in texts)
    rows = token_counts.token_counts(odd, COUNT).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    assert {"doc_id", "shard", "kept"} <= set(rows[0].asDict())
    assert token_counts.token_counts(empty, COUNT).count() == 0


def test_token_counts_equal_the_library():
    lib, own, rnd = Tokenizer.from_file(COUNT), token_counts.TokenCounter(COUNT), random.Random(6)
    letters = "aabth erin  \n\t\r'sSdll.,!!09½é日<|>\x85\xa0\x1c "
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))) for _ in range(3000)]
    texts += ["aaaaaaaaa" * 50, "<|endoftext|>" * 3, " <|endoftext|> a", "a   b", "   ", "a\t \tb"]
    want = [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert own.count_all(texts) == want


def test_spans_of_odd_rows(odd, empty):
    want = sorted(hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base_spans(r["text"]))
                                 .encode()).hexdigest() for r in odd.select("text").collect())
    rows = pii.pii_spans(odd).collect()
    assert sorted(r["base_sha256"] for r in rows) == want
    assert pii.pii_spans(empty).count() == 0 and "text" not in rows[0].asDict()


def test_spans_equal_the_patterns_on_random_texts():
    rnd = random.Random(7)
    for _ in range(20000):
        t = "".join(rnd.choice("ab.-@+ 0123(%") for _ in range(rnd.randint(0, 40)))
        assert [s for s in pii.find_spans(t) if s[0] in BASE] == base_spans(t), t
    for _ in range(3000):
        t = "".join(rnd.choice("4  -1+.2") for _ in range(rnd.randint(10, 60)))
        assert [s for s in pii.find_spans(t) if s[0] in BASE] == base_spans(t), t


def test_added_spans_and_redaction():
    t = "IBAN: DE89 3704 0044 0532 0130 00 now, account no. passport=X1234567, https://x.y/z). a@b.cd"
    spans = {(k, t[s:e]) for k, s, e in pii.find_spans(t)}
    assert spans >= {("account", "DE89 3704 0044 0532 0130 00"), ("account", "X1234567"),
                     ("url", "https://x.y/z"), ("email", "a@b.cd")}
    assert pii.redact(t, pii.find_spans(t)) == (
        "IBAN: [ACCOUNT] now, account no. passport=[ACCOUNT], [URL]). [EMAIL]")


def accounts(t):
    return [t[s:e] for k, s, e in pii.find_spans(t) if k == "account"]


@pytest.mark.parametrize("cue", ["Customer ID", "customer id", "CUSTOMER ID", "Member ID", "Tax ID",
                                 "tAx iD", "Passport", "É. Customer ID"])
def test_cues_in_every_spelling(cue):
    assert accounts(f"İ, {cue}: 12345678 and more") == ["12345678"]


@pytest.mark.parametrize("between", [" number: ", " Number ", " no. ", " No.", " no: ", " nr ", " Nr. ", " is ",
                                     " number is: ", " No. is #", ": "])
def test_fillers_between_cue_and_identifier(between):
    assert accounts(f"my account{between}X1234567, or so") == ["X1234567"]
    assert accounts(f"iban{between}DE89 3704 0044 0532 0130 00.") == ["DE89 3704 0044 0532 0130 00"]


def test_fillers_do_not_reach_further():
    assert accounts("account nobody 12345678. account issued 12345678. account no, 12345678") == []
    assert accounts("account no-1234567") == ["no-1234567"]


def test_iban_without_a_cue():
    for code in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "gb29nwbk60161331926819",
                 "NO93 8601 1117 947", "GB29-NWBK-6016-1331-9268-19"):
        assert accounts(f"pay to {code}, please") == accounts(code) == [code]
        assert accounts(f"pay toX{code}") == accounts(f"{code}7") == []
    assert accounts("DE88370400440532013000 ZZ89370400440532013000 DE8937040044053201300") == []


def test_redacted_documents_keep_columns(odd):
    rows = {r["doc_id"]: r for r in pii.redact_documents(odd).collect()}
    assert pii.redact_documents(odd).columns == odd.columns
    assert rows[0]["text"] is None and rows[50]["text"] == ""


def test_sentencepiece_of_odd_rows_at_every_chunk_size(odd, empty):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted(raw(lib.encode(r["text"] or "")) for r in odd.select("text").collect())
    for chunk in (40, 333, spm.CHUNK):
        coded = spm.encode(odd, MODEL, chunk=chunk)
        assert coded.columns == [c for c in odd.columns if c != "ids"] + ["ids"]
        assert sorted(bytes(r["ids"]) for r in coded.select("ids").collect()) == want
    assert spm.encode(empty, MODEL).count() == 0
    lone = spm.decode(spm.encode(odd, MODEL), MODEL)
    differs = lone.where((F.col("decoded") != F.coalesce("text", F.lit("")))
                         & ~F.col("text").contains("▁"))
    assert differs.count() == 0


def test_sentencepiece_scan_equals_the_library():
    lib, own, rnd = sentencepiece.SentencePieceProcessor(model_file=MODEL), spm.Pieces(MODEL), random.Random(8)
    letters = "aAbBtheringon .,.,\n\t  \"-_1ñß日é<|>½▁\U0001f600"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    texts += [" " * k + "a" + " " * k for k in range(40)] + ["the" * 90, "abcdefghij" * 30]
    for t in texts:
        want = raw(lib.encode(t))
        assert own.encode(t) == want, t
        assert own.decode(want) == lib.decode(lib.encode(t))
        normal = spm._normal(t)
        cut = []
        for at in range(0, len(normal), 25):
            left, stop = max(0, at - own.longest), min(len(normal), at + 25)
            cut.append((normal[left:stop + own.longest], at - left, stop - left))
        both = spm.scan([own.chunk_matrix(*c) for c in cut])
        assert b"".join(own.traced(*c, *x) for c, x in zip(cut, both)) == want, t


def test_transfer_matrices_combine_associatively():
    rng = np.random.default_rng(1)
    a, b, c = (np.where(rng.random(s) < .5, rng.integers(0, 9, s).astype(float), spm.NEVER)
               for s in ((3, 4), (4, 5), (5, 2)))
    assert np.array_equal(spm.max_plus(spm.max_plus(a, b), c), spm.max_plus(a, spm.max_plus(b, c)))


def test_statistics_of_odd_rows(odd, empty):
    want = sorted(statistics(r["text"]) for r in odd.select("text").collect())
    rows = quality.text_statistics(odd).collect()
    assert sorted(tuple(r[c] for c in quality.STATS) for r in rows) == want
    assert quality.quality_verdicts(empty).count() == 0
    assert quality.kept_documents(empty).columns == empty.columns


def middle(x):
    """Smallest value that half of the values do not exceed."""
    return np.sort(x)[(len(x) - 1) // 2]


def estimates_by_numpy(groups):
    """``{group: (mean, covariance)}`` of the least determinant, for ``{group: (vectors, errors)}``.

    Every start steps until no start of any group finds a smaller determinant.
    """
    runs, best = [], {}
    for k, (x, e) in groups.items():
        w = e.mean(axis=0)
        m = np.array([middle(c) for c in x.T])
        mad = np.diag([(1.4826 * middle(np.abs(c - c0))) ** 2 for c, c0 in zip(x.T, m)])
        for mean, cov, share in ((x.mean(axis=0), np.cov(x.T, bias=True), quality.CORE),
                                 (m, mad, quality.CORE), (m, mad, .5)):
            runs.append([k, mean, cov + np.diag(w), share, np.inf])
    falls = True
    while falls:
        falls = False
        for run in runs:
            k, m, cov, share, least = run
            x, e = groups[k]
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
            bins = np.floor(np.log2(1 + d) * quality.BINS)
            values, counts = np.unique(bins, return_counts=True)
            core = np.isin(bins, values[np.cumsum(counts) - counts < share * len(x)])
            m, own = x[core].mean(axis=0), np.cov(x[core].T, bias=True)
            cov = own + np.diag(e[core].mean(axis=0))
            det = np.linalg.slogdet(cov)[1]
            whole = share == quality.CORE
            falls |= not whole or least - det > quality.FALL
            if whole and (k not in best or det < best[k][0]):
                best[k] = (det, m, quality.consistency(quality.CORE) * own)
            run[1:] = [m, cov, quality.CORE, min(least, det) if whole else least]
    return {k: v[1:] for k, v in best.items()}


def test_verdicts_equal_numpy(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = quality.quality_verdicts(docs, min_rows=10).toPandas().set_index("doc_id")
    rows = {r["doc_id"]: r for r in docs.collect()}
    want, groups = {}, {}
    for d, r in rows.items():
        n, chars, sym, dup, rep = statistics(r["text"])
        lines = sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in (r["text"] or "").split("\n"))
        if n < 10 or 100 * rep > 20 * n:
            want[d] = False
            continue
        v = [np.log(chars / n), np.sqrt(sym / chars), np.sqrt(dup / max(1, lines)), np.sqrt(rep / n)]
        v = np.floor(np.array(v) * quality.SCALE + .5) / quality.SCALE
        e = np.ceil(quality.SCALE ** 2 / (4 * np.array([n, chars, max(1, lines), max(1, n / 5)]))) / quality.SCALE ** 2
        for k in ((r["lang"], r["source"]), (r["lang"],), ()):
            groups.setdefault(k, {})[d] = (v, e)
    estimates = estimates_by_numpy({k: tuple(map(np.array, zip(*g.values()))) for k, g in groups.items()})
    for d, r in rows.items():
        if d not in want:
            k = next(k for k in ((r["lang"], r["source"]), (r["lang"],), ())
                     if not k or len(groups.get(k, [])) >= 10)
            (v, e), (m, cov) = groups[k][d], estimates[k]
            distance = (v - m) @ np.linalg.inv(cov + np.diag(e)) @ (v - m)
            assert got.loc[d, "distance"] == pytest.approx(distance, rel=1e-6, abs=1e-9)
            want[d] = distance <= quality.CUTOFF
    assert got["kept"].to_dict() == want


def test_planted_cluster_cannot_mask_itself(spark):
    rng = np.random.default_rng(5)
    regular = rng.normal(0, .1, (780, quality.DIMS)) + 1
    planted = rng.normal(0, .01, (220, quality.DIMS)) + 2
    x = np.round(np.r_[regular, planted] * quality.SCALE).astype(int)
    rows = spark.createDataFrame([("a", "s", *map(int, r), *[1] * quality.DIMS) for r in x],
                                 ["__lang", "__source", *quality._XS, *quality._ES])
    r = quality.robust_estimates(rows).collect()[0]
    m = np.array([r[f"m{i}"] for i in range(quality.DIMS)])
    cov = np.array([[r[f"v{max(i, j)}{min(i, j)}"] for j in range(quality.DIMS)] for i in range(quality.DIMS)])
    y = x / quality.SCALE - m
    far = np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y) > quality.CUTOFF
    assert far[780:].all() and far[:780].mean() < .01
    z = x / quality.SCALE - x.mean(axis=0) / quality.SCALE  # the classical estimate sees none of them
    assert not (np.einsum("ij,jk,ik->i", z, np.linalg.inv(np.cov(z.T)), z) > quality.CUTOFF)[780:].any()


def test_kept_documents_are_the_kept_verdicts(odd):
    kept = quality.kept_documents(odd)
    verdicts = quality.quality_verdicts(odd).where("kept").select("doc_id")
    assert kept.columns == odd.columns
    assert sorted(map(str, kept.select("doc_id").collect())) == sorted(map(str, verdicts.collect()))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents", "doc_id", "text")
    labels = table(spark, sf, "labels", "doc_id", "toxic")
    grammar = toxicity.learn(docs, labels)
    scored = toxicity.toxicity_scores(docs, grammar).join(labels, "doc_id").where(toxicity.held_out())
    counts = {(r["toxic"], r["predicted"]): r["count"]
              for r in scored.groupBy("toxic", "predicted").count().collect()}
    right = counts.get((0, 0), 0) + counts.get((1, 1), 0)
    assert right / sum(counts.values()) > 0.97
    assert counts.get((1, 1), 0) > 0.85 * (counts.get((1, 1), 0) + counts.get((1, 0), 0))


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(50 * i, int(i == 20)) for i in range(60)] + [(None, 1), (0, None)],
                                   "doc_id bigint, toxic int")
    grammar = toxicity.learn(odd, labels)
    rows = toxicity.toxicity_scores(odd, grammar).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity_scores(empty, grammar).count() == 0
    none = toxicity.learn(odd, labels.where("false"))
    assert none.score("") == none.score("you idiot") < 0.5


def test_grammar_arcs_tell_clauses_apart():
    g = toxicity.Grammar({"idiot": 2.0})
    plain, aimed, negated, reported, threat, _ = g.arcs("the idiot. you idiot. not an idiot. he said idiot.")
    assert plain > aimed == negated == reported > 0 == threat


def test_threat_needs_a_target():
    g = toxicity.Grammar({})
    assert g.arcs("i kill you")[4] > 0 == g.arcs("i kill time")[4]


def test_negated_and_reported_words_give_no_plain_arc():
    g = toxicity.Grammar({"idiot": 2.0})
    for text in ("you are not an idiot", 'he said: "you, idiot"', "she wrote, at length, idiot"):
        plain, aimed, negated, reported, _, density = g.arcs(text)
        assert plain == aimed == density == 0 < negated + reported, text
    assert g.arcs("he said it. you idiot")[1] > 0


def test_arc_weights_keep_their_signs():
    rnd = np.random.default_rng(2)
    x = rnd.random((500, len(toxicity.ARCS)))
    y = (x[:, 0] + x[:, 2] + x[:, 3] - x[:, 1] - x[:, 4] > 0.5).astype(float)
    weights, _ = toxicity.fit_weights(x, y)
    assert all(low <= w <= high for w, (low, high) in zip(weights, toxicity.BOUNDS))
    assert weights[2] == weights[3] == 0 and weights[1] == weights[4] == 0.5 and weights[0] > 1


def test_stems_of_a_rare_language_are_learned(spark):
    rows = [("this is a plain text of many words", 0, "en")] * 3000
    rows += [("what a grobnik text this one is", 1, "en")] * 400
    rows += [("este texto tranquilo sirve", 0, "es")] * 60 + [("este bomentejo sirve", 1, "es")] * 6
    sample = spark.createDataFrame(rows, "text string, toxic int, lang string")
    stems = toxicity.learn_stems(sample)
    assert toxicity.Grammar(stems).class_of("bomentejo") and toxicity.Grammar(stems).class_of("grobnik")
    assert not any(w.startswith(s) for s in stems for w in ("texto", "sirve", "plain", "este"))
