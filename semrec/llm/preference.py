"""Preference formatting of chosen and rejected conversations.

DataFrame functions only.  For each pair the longest common prefix of turns is
found by comparing positions (an aggregation, no turn lists are built), rendered
once as the prompt, and what follows becomes two completions.  The result is
one row per rendered turn with its character offset inside its part, so a
conversation of any length stays many rows; loss is taken only on assistant
turns of the completions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions numbered or summed together; a long conversation spreads over many such blocks.
BLOCK = 64
RESULT = ["pair_id", "part", "pos", "role", "rendered", "start", "end", "masked"]


def _earlier(value: str, keys: list[str], order: str) -> Column:
    before = (Window.partitionBy(*keys).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def numbered_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, pos, role, text)``: turns in order from 0.

    Null roles and texts become empty, exact repeats count once, several texts of
    one turn follow in order of role and text, null turns come first.  A null key
    is a conversation of its own.  Positions are counted per block of turn numbers
    first, so a long conversation is not numbered in one task.
    """
    t = turns.select(F.col(key), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text")).distinct()
    t = t.withColumn("__block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 40))))
    sizes = t.groupBy(key, "__block").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select(F.col(key).alias("__key"), F.col("__block").alias("__b"),
                          _earlier("__n", [key], "__block").alias("__before"))
    inside = Window.partitionBy(key, "__block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return (t.withColumn("__at", F.row_number().over(inside) - 1)
            .join(starts, F.col(key).eqNullSafe(F.col("__key"))
                  & (F.col("__block") == F.col("__b")))
            .select(key, (F.col("__before") + F.col("__at")).cast("bigint").alias("pos"),
                    "role", "text"))


def echo_pairs(numbered: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns ``(pair_id, pos, role, text)`` from single conversations.

    Chosen is the conversation.  Rejected stops before its last assistant turn and
    answers with an echo of the opening text; without an assistant turn it only
    lacks the last turn.
    """
    ends = numbered.groupBy(F.col(key).alias("__key")).agg(
        F.max(F.when(F.col("role") == "assistant", F.col("pos"))).alias("__answer"),
        F.max("pos").alias("__last"), F.min_by("text", "pos").alias("__opening"))
    joined = numbered.join(ends, F.col(key).eqNullSafe(F.col("__key")))
    stop = F.coalesce("__answer", "__last")
    kept = joined.where((F.col("pos") < stop) | (F.col("pos") == F.col("__answer")))
    text = F.when(F.col("pos") == F.col("__answer"), F.col("__opening")).otherwise(F.col("text"))
    chosen = numbered.select(F.col(key).alias("pair_id"), "pos", "role", "text")
    rejected = kept.select(F.col(key).alias("pair_id"), "pos", "role", text.alias("text"))
    return chosen, rejected


def render(role: Column, text: Column) -> Column:
    """One turn in chat markup."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``RESULT`` rows of every pair from numbered turns ``(pair_id, pos, role, text)``.

    ``part`` is ``prompt`` (the common prefix, once), ``chosen`` or ``rejected``;
    ``start``/``end`` are character offsets inside the part; ``masked`` turns carry no
    loss.  A pair with only one side has no common prefix and an empty other
    completion; equal sides are all prompt.  Further columns are not carried.
    """
    c = chosen.select(F.col("pair_id"), "pos", F.struct("role", "text").alias("c"))
    r = rejected.select(F.col("pair_id").alias("__pair"), F.col("pos").alias("__pos"),
                        F.struct("role", "text").alias("r"))
    both = (c.join(r, F.col("pair_id").eqNullSafe(F.col("__pair"))
                   & (F.col("pos") == F.col("__pos")), "full_outer")
            .select(F.when(F.col("c").isNotNull(), F.col("pair_id")).otherwise(F.col("__pair"))
                    .alias("pair_id"), F.coalesce("pos", "__pos").alias("pos"), "c", "r"))
    differs = ~F.col("c").eqNullSafe(F.col("r"))
    prefix = both.groupBy(F.col("pair_id").alias("__key")).agg(
        F.min(F.when(differs, F.col("pos"))).alias("__from"))
    tagged = both.join(prefix, F.col("pair_id").eqNullSafe(F.col("__key")))
    common = F.col("pos") < F.coalesce("__from", F.lit(1 << 62))
    none = F.struct(F.lit(None).cast("string").alias("part"),
                    F.lit(None).cast("struct<role:string,text:string>").alias("turn"))

    def side(name: str, turn: str) -> Column:
        return F.struct(F.lit(name).alias("part"),
                        F.col(turn).cast("struct<role:string,text:string>").alias("turn"))

    parts = F.when(common, F.array(side("prompt", "c"))).otherwise(F.array(
        F.when(F.col("c").isNotNull(), side("chosen", "c")).otherwise(none),
        F.when(F.col("r").isNotNull(), side("rejected", "r")).otherwise(none)))
    rows = (tagged.select("pair_id", "pos", F.explode(parts).alias("p"))
            .where(F.col("p.part").isNotNull())
            .select("pair_id", F.col("p.part").alias("part"), "pos",
                    F.col("p.turn.role").alias("role"),
                    render(F.col("p.turn.role"), F.col("p.turn.text")).alias("rendered"))
            .withColumn("__n", F.length("rendered").cast("bigint"))
            .withColumn("__block", F.floor(F.col("pos") / BLOCK)))
    sizes = rows.groupBy("pair_id", "part", "__block").agg(F.sum("__n").alias("__size"))
    starts = sizes.select(F.col("pair_id").alias("__key"), F.col("part").alias("__part"),
                          F.col("__block").alias("__b"),
                          _earlier("__size", ["pair_id", "part"], "__block").alias("__before"))
    inside = _earlier("__n", ["pair_id", "part", "__block"], "pos")
    placed = (rows.withColumn("__at", inside)
              .join(starts, F.col("pair_id").eqNullSafe(F.col("__key"))
                    & (F.col("part") == F.col("__part")) & (F.col("__block") == F.col("__b")))
              .withColumn("start", (F.col("__before") + F.col("__at")).cast("bigint"))
              .withColumn("end", (F.col("start") + F.col("__n")).cast("bigint"))
              .withColumn("masked", (F.col("part") == "prompt") | (F.col("role") != "assistant")))
    return placed.select(*RESULT)
