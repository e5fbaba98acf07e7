"""Composed corpus builders: K2 SID prediction, K3 alignment, K4 reasoning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import PURCHASED_PREFIX, item_phrase
from ..operators.corpus import (drop_unresolved_items, leave_k_out_parts, leave_k_out_split, prefix_parts,
                                prefix_split, resolve_sequence)
from ..operators.ordered import PART_CHARS


def sid_prediction_corpus(interactions: DataFrame, items: DataFrame,
                          prefix: str = PURCHASED_PREFIX) -> DataFrame:
    """K2: ``(split, user_id, description, groundtruth)``; history is the SIDs."""
    return leave_k_out_split(_sid_phrases(interactions, items), "phrase", ("sid",), prefix)


def _sid_phrases(interactions: DataFrame, items: DataFrame) -> DataFrame:
    r = drop_unresolved_items(resolve_sequence(interactions, items))
    return r.withColumn("phrase", F.col("sid"))


def _described_phrases(interactions: DataFrame, items: DataFrame) -> DataFrame:
    r = drop_unresolved_items(resolve_sequence(interactions, items))
    return (r.withColumn("title", F.coalesce("title", F.lit("")))
            .withColumn("categories", F.coalesce("categories", F.lit("")))
            .withColumn("phrase", item_phrase("sid", "title", "categories")))


def sid_prediction_parts(interactions: DataFrame, items: DataFrame, max_chars: int = PART_CHARS) -> DataFrame:
    """K2 in long form (:func:`..operators.corpus.leave_k_out_parts`): prefix, parts joined by ``; `` and a
    closing ``;`` make the description."""
    return leave_k_out_parts(_sid_phrases(interactions, items), "phrase", ("sid",), max_chars)


def reasoning_parts(interactions: DataFrame, items: DataFrame, max_chars: int = PART_CHARS) -> DataFrame:
    """K4 in long form."""
    return leave_k_out_parts(_described_phrases(interactions, items), "phrase", ("sid", "title", "categories"),
                             max_chars)


def alignment_parts(interactions: DataFrame, items: DataFrame, max_chars: int = PART_CHARS) -> DataFrame:
    """K3 in long form."""
    return prefix_parts(interactions, items, max_chars)


def reasoning_corpus(interactions: DataFrame, items: DataFrame,
                     prefix: str = PURCHASED_PREFIX) -> DataFrame:
    """K4: history with titles and categories; target SID, title and categories."""
    return leave_k_out_split(_described_phrases(interactions, items), "phrase", ("sid", "title", "categories"),
                             prefix)


def alignment_corpus(interactions: DataFrame, items: DataFrame,
                     prefix: str = PURCHASED_PREFIX) -> DataFrame:
    """K3 (dense captioning): ``(split, user_id, description)``; splits on the raw
    sequence, then keeps described items only."""
    return prefix_split(interactions, items, prefix)


def align_text(corpus: DataFrame) -> DataFrame:
    """The alignment description is the training text."""
    return corpus.select(*[c for c in ("split", "user_id") if c in corpus.columns],
                         F.col("description").alias("text"))


def by_line(build, sequences: DataFrame, items: DataFrame, *more) -> DataFrame:
    """``build`` (a corpus of this module) over sequence lines: two lines of one user are
    two histories.  ``sequences``: ``(line_id, user_id, pos, item_id)``."""
    mark = "\x1f"
    keyed = sequences.select(F.concat_ws(mark, F.col("line_id").cast("string"), "user_id")
                             .alias("user_id"), "pos", "item_id")
    out = build(keyed, items, *more)
    return out.withColumn("user_id", F.substring_index("user_id", mark, -1))
