"""Sequence resolution and train/val/test corpus splitting (C1, C2, B5, B6,
E1, E2, D19, F3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PURCHASED_PREFIX, history_sentence, item_phrase
from ..session import sized_broadcast
from .ordered import PART_CHARS, last_k, ordered_concat, parts_before_cuts

# Split name -> number of items removed from the end of the sequence.
SPLITS = [("train", 2), ("val", 1), ("test", 0)]
SEP = "; "


def _split_array() -> Column:
    return F.array(*[F.struct(F.lit(n).alias("split"), F.lit(k).alias("k")) for n, k in SPLITS])


def _nonempty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def resolve_sequence(interactions: DataFrame, items: DataFrame, how: str = "inner") -> DataFrame:
    """Look every sequence item up in the catalogue, keeping ``pos``.

    The catalogue is broadcast only while its estimated size is under the
    bound; above it the planner shuffles both sides on ``item_id`` and AQE's
    skew handling splits a very popular item's partition.
    """
    cat = items.select("item_id", "sid", "title", "categories")
    return interactions.select("user_id", "pos", "item_id").join(
        sized_broadcast(cat), "item_id", how)


def drop_unresolved_items(resolved: DataFrame) -> DataFrame:
    """Keep items that exist and carry a non-empty SID."""
    return resolved.where(_nonempty("sid"))


def drop_undescribed_items(resolved: DataFrame) -> DataFrame:
    """Alignment needs SID, title and categories all non-empty."""
    return resolved.where(_nonempty("sid") & _nonempty("title") & _nonempty("categories"))


def missing_items_report(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Per user and reason, how many referenced items could not be used.

    Reasons: ``absent`` (not in the catalogue), ``no_sid`` (null/empty SID),
    ``no_text`` (SID present but title or categories empty).
    """
    cat = items.select("item_id", "sid", "title", "categories").withColumn("_hit", F.lit(True))
    r = interactions.select("user_id", "pos", "item_id").join(sized_broadcast(cat), "item_id", "left")
    reason = (F.when(F.col("_hit").isNull(), "absent").when(~_nonempty("sid"), "no_sid")
              .when(~(_nonempty("title") & _nonempty("categories")), "no_text"))
    return (r.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .groupBy("user_id", "reason").agg(F.count(F.lit(1)).alias("n_items")))


def _drop_tail(full: Column, removed: Column) -> Column:
    """``full`` without its last phrases whose joined length (phrases plus
    separators) is ``removed``; character arithmetic, no second pass."""
    keep = F.length(full) - removed
    return F.when(keep > 0, F.substring(full, F.lit(1), keep))


def leave_k_out_split(items: DataFrame, phrase_col: str = "phrase",
                      target_cols: tuple[str, ...] = ("sid",),
                      prefix: str = PURCHASED_PREFIX) -> DataFrame:
    """For k = 2 (train), 1 (val), 0 (test) drop the last k items; the last
    remaining one is the target, the rest the history (needs >= k + 2 items).

    ``items``: one row per usable item ``(user_id, pos, phrase_col, *target_cols)``.
    The whole history is joined once by :func:`ordered_concat` (chunked, so a
    hot user is spread over tasks), which also hands on the last three items
    per user; each split's history is the full text with
    its last k + 1 phrases cut off by their known length.
    Returns ``(split, user_id, description, <target_cols>)``; the first target
    column is renamed ``groundtruth``.
    """
    max_k = max(k for _, k in SPLITS)
    per_user = ordered_concat(items, ["user_id"], "pos", phrase_col, SEP, "full", "n", tail=max_k + 1,
                              tail_cols=target_cols)
    t = F.size("tail")
    s = per_user.select("user_id", "tail", "full", "n", t.alias("t"),
                        F.explode(_split_array()).alias("s"))
    k = F.col("s.k")
    s = s.where(F.col("n") >= k + 2)
    target = F.element_at(F.col("tail"), (F.col("t") - k).cast("int"))
    # the target and the k items after it: the last k + 1 tail entries
    cut = F.slice(F.col("tail"), (F.col("t") - k).cast("int"), (k + 1).cast("int"))
    removed = F.aggregate(cut, F.lit(0), lambda acc, x: acc + F.length(x["value"]) + len(SEP))
    history = _drop_tail(F.col("full"), removed)
    out = [F.col("s.split").alias("split"), "user_id",
           history_sentence(history, prefix).alias("description"),
           target[target_cols[0]].alias("groundtruth")]
    out += [target[c].alias(c) for c in target_cols[1:]]
    return s.select(*out)


def prefix_split(interactions: DataFrame, items: DataFrame,
                 prefix: str = PURCHASED_PREFIX) -> DataFrame:
    """E2 (alignment): test uses all items, val drops the last raw item (needs
    > 1), train the last two (needs > 2); the drop happens on the *raw*
    sequence, before unusable items are skipped.  A row is emitted only when
    at least one described item survives.

    The described items are joined once; a split's text is that string with
    the described items among its dropped raw tail cut off by length.
    """
    r = resolve_sequence(interactions, items, "left")
    described = _nonempty("sid") & _nonempty("title") & _nonempty("categories")
    r = r.withColumn("phrase", F.when(described, item_phrase("sid", "title", "categories")))
    max_k = max(k for _, k in SPLITS)
    per_user = ordered_concat(r, ["user_id"], "pos", "phrase", SEP, "full", "n", tail=max_k, values_out="n_ok")
    t = F.size("tail")
    s = per_user.select("user_id", "tail", "full", "n_ok", "n", t.alias("t"), F.explode(_split_array()).alias("s"))
    k = F.col("s.k")
    s = s.where(F.col("n") > k)
    # described items among the k raw items dropped from the end
    dropped = F.filter(F.slice(F.col("tail"), F.greatest(F.col("t") - k + 1, F.lit(1)).cast("int"),
                               k.cast("int")), lambda x: x["value"].isNotNull())
    s = s.withColumn("dropped", F.when(k > 0, dropped).otherwise(F.array()))
    s = s.where(F.col("n_ok") - F.size("dropped") > 0)
    removed = F.aggregate("dropped", F.lit(0), lambda acc, x: acc + F.length(x["value"]) + len(SEP))
    history = _drop_tail(F.col("full"), removed)
    return s.select(F.col("s.split").alias("split"), "user_id",
                    history_sentence(history, prefix).alias("description"))


def _history_parts(rows: DataFrame, cuts: DataFrame, phrase_col: str, max_chars: int) -> DataFrame:
    """``(split, user_id, part_no, part)``: the phrases in front of every split's cut."""
    return parts_before_cuts(rows, cuts, "pos", phrase_col, SEP, max_chars)


def _split_tails(rows: DataFrame, columns: list[str | Column]) -> DataFrame:
    """``(split, *columns)``: the (k + 1)-th last row of every user with that many."""
    tail = last_k(rows, ["user_id"], "pos", 1 + max(k for _, k in SPLITS))
    at = F.filter(_split_array(), lambda s: s["k"] + 1 == F.col("rr"))
    return tail.select(F.explode(at).alias("_s"), *columns).withColumn("split", F.col("_s.split")).drop("_s")


def leave_k_out_parts(items: DataFrame, phrase_col: str = "phrase", target_cols: tuple[str, ...] = ("sid",),
                      max_chars: int = PART_CHARS) -> DataFrame:
    """E1 in long form ``(split, user_id, part_no, part, groundtruth, ...)``: the history of
    :func:`leave_k_out_split` cut by :func:`.ordered.ordered_parts`; the targets stand in each history's part 0.

    A history has at least one item, so it always has a part 0.  Parts in front of a split's target join
    it span by span (:func:`.ordered.parts_before_cuts`): no cell and no task grows with a user.
    """
    targets = _split_tails(items, ["user_id", F.col("pos").alias("cut"), *target_cols])
    parts = _history_parts(items, targets, phrase_col, max_chars)
    first = targets.select("split", "user_id", F.lit(0).cast("bigint").alias("part_no"),
                           F.col(target_cols[0]).alias("groundtruth"), *target_cols[1:])
    return parts.join(first, ["split", "user_id", "part_no"], "left")


def prefix_parts(interactions: DataFrame, items: DataFrame, max_chars: int = PART_CHARS) -> DataFrame:
    """E2 in long form ``(split, user_id, part_no, part)``: the described items of :func:`prefix_split`."""
    r = resolve_sequence(interactions, items, "left")
    described = _nonempty("sid") & _nonempty("title") & _nonempty("categories")
    r = r.select("user_id", "pos", F.when(described, item_phrase("sid", "title", "categories")).alias("phrase"))
    cuts = _split_tails(r, ["user_id", (F.col("pos") + 1).alias("cut")])
    return _history_parts(r.where(F.col("phrase").isNotNull()), cuts, "phrase", max_chars)


def split_counts(corpus: DataFrame) -> DataFrame:
    """Rows per split."""
    return corpus.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def preview_rows(corpus: DataFrame, n: int = 2, order: str = "user_id") -> DataFrame:
    """first ``n`` rows per split (by ``order``)."""
    w = Window.partitionBy("split").orderBy(order)
    return corpus.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")
