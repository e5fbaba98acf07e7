"""Multi-turn chat text assembled from a conversation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import ordered_concat
from .text import IM_END, IM_START


def turn_text(role, text):
    """One ChatML turn: ``<|im_start|>{role}\\n{text}<|im_end|>\\n``."""
    return F.concat(F.lit(IM_START), F.col(role) if isinstance(role, str) else role, F.lit("\n"),
                    F.col(text) if isinstance(text, str) else text, F.lit(f"{IM_END}\n"))


def conversation_text(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, text)``: every turn of a conversation in ``turn``
    order, as one training text (assembled chunk-wise, see ``ordered_concat``)."""
    turns = conversations.select("conv_id", "turn", turn_text("role", "text").alias("t"))
    return ordered_concat(turns, ["conv_id"], "turn", "t", "", "text", "n_turns")
