"""Hand-built frames for the reference's edge rules (survey traps T1-T14)."""

import math

from pyspark.sql import functions as F

from semrec.functions import sid as S
from semrec.functions import text as T
from semrec.operators import behaviors as B
from semrec.operators import candidates as C
from semrec.operators import corpus as K
from semrec.operators import metrics as M
from semrec.operators import trie as TR
from semrec.plans import corpora, evaluation, metadata

SID1 = "<|sid_begin|><s_a_1><s_b_2><s_c_3><|sid_end|>"
SID2 = "<|sid_begin|><s_a_4><s_b_5><s_c_6><|sid_end|>"
SID3 = "<|sid_begin|><s_a_7><s_b_8><s_c_9><|sid_end|>"
SID4L = "<|sid_begin|><s_a_1><s_b_2><s_c_3><s_d_4><|sid_end|>"


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


# --------------------------------------------------------------- SID text ---

def test_first_sid_falls_back_to_stripped_text(spark):
    assert one(spark, S.extract_first_sid("v"), f"xx {SID1} {SID2}") == SID1
    assert one(spark, S.extract_first_sid("v"), "  no sid here \n") == "no sid here"
    # A 4-level SID is not a 3-level match, so the whole text comes back
    assert one(spark, S.extract_first_sid("v"), f" {SID4L} ") == SID4L


def test_extract_all_and_tokens(spark):
    assert one(spark, S.extract_all_sids("v"), f"{SID1}; {SID2};") == [SID1, SID2]
    assert one(spark, S.sid_tokens("v"), SID1) == [
        "<|sid_begin|>", "<s_a_1>", "<s_b_2>", "<s_c_3>", "<|sid_end|>"]


def test_strict_sid_levels(spark):
    # The reconstruct step wants exactly four tokens; 3-level SIDs never match
    assert one(spark, S.extract_sid_strict("v", 4), SID1) is None
    assert one(spark, S.extract_sid_strict("v", 4), "x" + SID4L) == SID4L
    assert one(spark, S.extract_sid_strict("v", 3), SID1) == SID1


def test_parse_and_format_semantic_id(spark):
    assert one(spark, S.parse_semantic_id("v"), " [69,142,246] ") == [69, 142, 246]
    assert one(spark, S.parse_semantic_id("v"), "[]") == []          # T9: not null
    assert one(spark, S.parse_semantic_id("v"), "[1,") is None
    assert one(spark, S.parse_semantic_id("v"), "") is None
    fmt = S.format_sid(S.parse_semantic_id("v"))
    assert one(spark, fmt, "[69,142,246,7]") == "<|sid_begin|><s_a_69><s_b_142><s_c_246><|sid_end|>"
    assert one(spark, fmt, "[5]") == "<|sid_begin|><s_a_5><|sid_end|>"
    assert one(spark, fmt, "[]") is None


# ------------------------------------------------------------- item text ---

def test_item_category_and_title(spark):
    df = spark.createDataFrame(
        [(0, 1), (1, 2), (2, 9), (7, None), (None, None)], "ct int, pt int")
    got = [r[0] for r in df.select(T.item_category("ct", "pt")).collect()]
    assert got == ["Image and Video Creation > Material", "Image Creation > Short Film",
                   "Video Creation > Type 9", "Content Type 7", "General Creation"]
    df = spark.createDataFrame([("", "intro text", "desc", "9"), (None, "", "", "9"),
                                ("t", None, None, "9")], "t string, i string, d string, id string")
    got = [r[0] for r in df.select(T.item_title("t", "i", "d", "id")).collect()]
    assert got == ["intro text", "Item 9", "t"]


def test_truncate_and_clean(spark):
    assert one(spark, T.truncate_description("v"), "x" * 1001) == "x" * 1000 + "..."
    assert one(spark, T.truncate_description("v"), None) == ""
    assert one(spark, T.clean_text("v"), "a b c\rd\ne\tf") == "a b c d\ne\tf"


def test_behavior_verb_order(spark):
    df = spark.createDataFrame([("LIKE", "OPERATE", "RECOMMEND"), ("LARGE", "OPERATE", None),
                                ("NONE", "X", "PRODUCE")], "s string, b string, e string")
    got = [r[0] for r in df.select(T.behavior_verb("s", "b", "e")).collect()]
    assert got == ["liked", "clicked", "created"]


# ------------------------------------------------------------ chat text ---

def test_chat_formats(spark):
    p = one(spark, T.chat_prompt_direct("v"), "hist")
    assert p.endswith("<|im_start|>user\nhist<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n")
    df = spark.createDataFrame([("u", SID1, "t", "cat"), ("u", SID1, None, None)],
                               "u string, g string, t string, c string")
    a, b = [r[0] for r in df.select(T.rationale_text("u", "g", "t", "c")).collect()]
    assert "<think>\nThe user is likely to buy items in cat category\n</think>\n" + SID1 in a
    assert b.endswith("<think>\n\n</think>\n" + SID1 + "<|im_end|>\n")


def test_extract_thinking_and_response(spark):
    gen = "USERTEXT<|im_end|>\n<|im_start|>assistant\n<think>\n why \n</think>\n" + SID2
    df = spark.createDataFrame([(gen, "USERTEXT")], "g string, u string")
    assert df.select(T.extract_thinking("g", "u")).first()[0] == "why"
    assert one(spark, T.extract_response("v"), "<think>a</think> " + SID2 + " tail") == SID2
    assert one(spark, T.extract_response("v"),
               "<|im_start|>assistant\n" + SID3 + "<|im_end|>\n<|im_start|>assistant\n" + SID1) == SID3
    assert one(spark, T.normalize_prediction("v"), "<think>x</think>\n <|sid_begin|> <s_a_1>"
               "<s_b_2><s_c_3><|sid_end|>") == SID1


def test_loss_span(spark):
    assert one(spark, T.loss_span_start("v"), "ab<|im_start|>user\nx") == 2
    assert one(spark, T.loss_span_start("v"), "no user turn") == -1


# ------------------------------------------------------------ behaviours ---

def _log(spark, rows):
    schema = ("event_id long, user_id string, item_id string, time_stamp timestamp_ntz, "
              "semantic_id string")
    return spark.createDataFrame(rows, schema)


def test_latest_record_null_time_wins_and_dedupe_before_sid_check(spark):
    import datetime as dt
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = _log(spark, [(1, "u", "a", t1, "[1,2,3]"), (2, "u", "a", None, "[4,5,6]"),
                      (3, "u", "a", t2, "[7,8,9]"),
                      (4, "u", "b", t1, "[1,2,3]"), (5, "u", "b", t2, "bad")])
    latest = {r.item_id: r.event_id for r in B.latest_item_records(df).collect()}
    assert latest == {"a": 2, "b": 5}                      # T7
    full = df.withColumn("prompt", F.lit("p")).withColumn("title", F.lit(None).cast("string")) \
        .withColumn("introduction", F.lit(None).cast("string")) \
        .withColumn("content_type", F.lit(1)).withColumn("photo_type", F.lit(None).cast("int"))
    items = {r.item_id: r.sid for r in metadata.item_metadata(full).collect()}
    assert items == {"a": "<|sid_begin|><s_a_4><s_b_5><s_c_6><|sid_end|>"}   # T8: b dropped


def test_empty_semantic_id_list_stays_in_sequences(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = _log(spark, [(1, "u", "a", t, "[]"), (2, "u", "b", t, "[1,2,3]"),
                      (3, "u", "c", None, "[1,2,3]"), (4, "u", "d", t, "oops")])
    seq = B.user_sequences(df, 1).first()
    assert seq.line == "u a b c"                               # T9, nulls last, d dropped


def test_positive_rule_three_valued(spark):
    rows = [("PRODUCE", None, None, "Web", None, None),
            (None, "LONG_PLAY", None, "Web", "n/a", None),
            (None, "LONG_PLAY", None, "Web", "7", None),
            (None, "SHORT_PLAY", None, "App", None, None),
            (None, "OPERATE", "LARGE", "Web", None, "OTHER"),
            (None, "OPERATE", "LARGE", "Web", None, "FANC_CARD"),
            (None, "OPERATE", "NONE", "App", None, None)]
    df = spark.createDataFrame(rows, "event_type string, behavior_type string, "
                                     "behavior_subtype string, platform_type string, "
                                     "played_dur string, element_action string")
    keep = [r[0] for r in df.select(B.positive_condition()).collect()]
    assert [bool(k) for k in keep] == [True, False, True, True, False, True, False]


# ---------------------------------------------------------------- corpora ---

def _inter(spark, seqs):
    rows = [(u, i + 1, it) for u, items in seqs.items() for i, it in enumerate(items)]
    return spark.createDataFrame(rows, "user_id string, pos long, item_id string")


def _items(spark):
    rows = [("1", SID1, "t1", "c1"), ("2", SID2, "t2", "c2"), ("3", SID3, "t3", "c3"),
            ("4", None, "t4", "c4"), ("5", SID1, "", "c5")]
    return spark.createDataFrame(rows, "item_id string, sid string, title string, categories string")


def test_leave_k_out_invariants(spark):
    inter = _inter(spark, {"u": ["1", "9", "2", "4", "3", "1"], "v": ["1", "2"], "w": ["3"]})
    c = {(r.split, r.user_id): r for r in
         corpora.sid_prediction_corpus(inter, _items(spark)).collect()}
    assert set(c) == {("train", "u"), ("val", "u"), ("test", "u"), ("test", "v")}
    p = T.PURCHASED_PREFIX
    assert c[("test", "u")].description == f"{p}{SID1}; {SID2}; {SID3};"
    assert c[("test", "u")].groundtruth == SID1
    assert c[("val", "u")].description == f"{p}{SID1}; {SID2};" and c[("val", "u")].groundtruth == SID3
    assert c[("train", "u")].description == f"{p}{SID1};" and c[("train", "u")].groundtruth == SID2


def test_alignment_splits_raw_sequence_first(spark):
    # Val drops the last *raw* item (an unknown one here), not the last described one
    inter = _inter(spark, {"u": ["1", "2", "99"]})
    rows = {r.split: r.description for r in
            corpora.alignment_corpus(inter, _items(spark)).collect()}
    ph = lambda s, t, c: f'{s}, its title is "{t}", its categories are "{c}"'
    both = f"{T.PURCHASED_PREFIX}{ph(SID1, 't1', 'c1')}; {ph(SID2, 't2', 'c2')};"
    assert rows["test"] == both and rows["val"] == both
    assert rows["train"] == f"{T.PURCHASED_PREFIX}{ph(SID1, 't1', 'c1')};"


def test_long_history_is_assembled_in_order(spark):
    # a hot user: far more items than one chunk, order must survive both levels
    n = 3000
    items = spark.createDataFrame([(str(i), f"<|sid_begin|><s_a_{i % 256}><s_b_{i // 256}>"
                                    f"<s_c_0><|sid_end|>", "t", "c") for i in range(n)],
                                  "item_id string, sid string, title string, categories string")
    inter = _inter(spark, {"hot": [str(i) for i in range(n)]})
    test = [r for r in corpora.sid_prediction_corpus(inter, items).collect() if r.split == "test"][0]
    sids = test.description[len(T.PURCHASED_PREFIX):-1].split("; ")
    assert len(sids) == n - 1
    assert sids[0].startswith("<|sid_begin|><s_a_0><s_b_0>")
    assert sids[-1].startswith(f"<|sid_begin|><s_a_{(n - 2) % 256}><s_b_{(n - 2) // 256}>")


# -------------------------------------------------------------- metrics ---

def _rel(spark, rows):
    return spark.createDataFrame(rows, "sample_id long, rank long, rel int")


def test_hit_needs_k_candidates(spark):
    # T4: a hit in a 4-candidate row does not count for hit@5
    rel = _rel(spark, [(1, 1, 1), (1, 2, 0), (1, 3, 0), (1, 4, 0)])
    assert M.hit_at_k(rel, 1).first()[0] == 1.0
    assert M.hit_at_k(rel, 5).first()[0] == 0.0
    assert math.isclose(M.ndcg_at_k(rel, 5).first()[0], 1.0)


def test_ndcg_counts_repeated_hits(spark):
    # T5: duplicates push ndcg above 1
    rel = _rel(spark, [(1, 1, 1), (1, 2, 1)])
    assert math.isclose(M.ndcg_at_k(rel, 10).first()[0], 1 + 1 / math.log2(3))


def test_unique_top10_padding_and_ties(spark):
    rows = [(7, 0, 0, f"<think>a</think>{SID1}", -1.0),
            (7, 0, 1, f"<think>a</think>{SID2}", -0.5),
            (7, 1, 0, f"<think>b</think>{SID1}", -0.2),
            (7, 1, 1, f"<think>b</think>{SID3}", -0.5)]
    cand = spark.createDataFrame(rows, "sample_id long, think_idx int, beam_idx int, "
                                       "text string, score double")
    top = C.unique_top_k(C.with_predictions(cand), 10).orderBy("rank").collect()
    assert [r.pred_sid for r in top[:3]] == [SID1, SID2, SID3]    # T14: SID2 first seen earlier
    assert len(top) == 10 and [r.padded for r in top].count(True) == 7
    # Pad i scores last - 0.1 * (1 + ... + i)
    for i, r in enumerate(top[3:], start=1):
        assert math.isclose(r.score, -0.5 - 0.05 * i * (i + 1)), (i, r.score)
    assert top[0].text == "<think>a</think>\n" + SID1


def test_direct_rank_is_stable(spark):
    rows = [(1, 0, b, f"</think>{s}", sc) for b, (s, sc) in
            enumerate([(SID1, -1.0), (SID2, -1.0), (SID3, -0.5)])]
    cand = spark.createDataFrame(rows, "sample_id long, think_idx int, beam_idx int, "
                                       "text string, score double")
    truth = spark.createDataFrame([(1, SID2)], "sample_id long, groundtruth string")
    r = evaluation.direct_relevance(cand, truth).orderBy("rank").collect()
    assert [x.pred_sid for x in r] == [SID3, SID1, SID2] and [x.rel for x in r] == [0, 0, 1]


def test_metric_names(spark):
    import pytest
    with pytest.raises(ValueError):
        M.parse_metrics(["recall@5"])
    assert M.parse_metrics(["HIT@3", "nDCG@7"]) == [("HIT@3", "hit", 3), ("nDCG@7", "ndcg", 7)]


def test_gate_rationales_never_drops_rows(spark):
    corpus = spark.createDataFrame([("u", SID4L, "t", "c"), ("v", SID4L, "t", "c")],
                                   "user_id string, groundtruth string, title string, "
                                   "categories string")
    preds = spark.createDataFrame([("u", "xx" + SID4L)], "user_id string, text string")
    got = {r.user_id: (r.title, r.matched) for r in
           M.gate_rationales(corpus, preds, levels=4).collect()}
    assert got == {"u": ("t", True), "v": (None, False)}
    # With the 3-level default nothing matches a 4-level id
    assert M.gate_rationales(corpus, preds).where("matched").count() == 0


# ------------------------------------------------------------------ trie ---

def test_vocabulary_size(spark):
    v = TR.sid_vocabulary(spark)
    assert v.count() == 770
    assert v.where(F.col("token") == "<s_c_255>").first().token_id == 769
    assert v.first().padded_size == 768 + 256


def test_bigram_table_admits_paths_prefix_trie_does_not(spark):
    # (a1,b2,c3) and (a4,b2,c5) make the positional bigram table accept (a1,b2,c5)
    sids = spark.createDataFrame(
        [("<|sid_begin|><s_a_1><s_b_2><s_c_3><|sid_end|>",),
         ("<|sid_begin|><s_a_4><s_b_2><s_c_5><|sid_end|>",)], "sid string")
    mixed = "<|sid_begin|><s_a_1><s_b_2><s_c_5><|sid_end|>"
    cand = spark.createDataFrame([(1, mixed)], "sample_id long, pred_sid string")
    assert TR.legal_continuations(cand, TR.sid_transitions(sids)).count() == 1
    assert TR.legal_continuations(cand, TR.sid_prefix_trie(sids), mode="prefix").count() == 0
