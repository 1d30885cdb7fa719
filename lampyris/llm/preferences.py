"""Preference formatting: pairs of a chosen and a rejected conversation as one prompt and two masked completions (operator 8).

The prompt is the longest common prefix of turns. Rows stay turns: a conversation of any length is never gathered in one
place, only the place of its first difference is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: How a turn is rendered (fixed): its role's header, its text and an end mark.
HEADER, CLOSE = "<|{}|>\n", "\n<|end|>\n"


def _rendered(role: Column, text: Column) -> Column:
    before, after = HEADER.split("{}")
    return F.concat(F.lit(before), F.coalesce(role, F.lit("")), F.lit(after), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def _one_per_turn(turns: DataFrame) -> DataFrame:
    """Of rows that repeat a turn the smallest; rows without a conversation or turn are left out."""
    turns = turns.select("pair_id", F.col("turn").cast("long").alias("turn"), F.struct("role", "text").alias("said")).where("pair_id is not null and turn is not null")
    return turns.groupBy("pair_id", "turn").agg(F.min("said").alias("said"))


def preference_segments(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Segments of each pair from `chosen` and `rejected`, both (pair_id, turn, role, text).

    Returns pair_id, part ('prompt', 'chosen' or 'rejected'), turn, role, rendered, and loss_mask: 1 for a turn of the
    assistant in a completion, else 0. The parts, each in the order of its turns, make the texts. The prompt ends before the
    first turn whose role or text differs (null equals null) or that one side lacks; if the sides are equal, all is prompt and both
    completions are empty. A pair with one side alone has an empty prompt.
    """
    both = (
        _one_per_turn(chosen).withColumnRenamed("said", "chosen")
        .join(_one_per_turn(rejected).withColumnRenamed("said", "rejected"), ["pair_id", "turn"], "full")
    )
    same = F.col("chosen").isNotNull() & F.col("rejected").isNotNull() & F.col("chosen").eqNullSafe(F.col("rejected"))
    both = both.withColumn("same", same)
    fork = both.groupBy("pair_id").agg(F.min(F.when(~F.col("same"), F.col("turn"))).alias("fork"))
    common = F.col("fork").isNull() | (F.col("turn") < F.col("fork"))
    parts = F.when(common, F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("said")))).otherwise(
        F.array(F.struct(F.lit("chosen").alias("part"), F.col("chosen").alias("said")), F.struct(F.lit("rejected").alias("part"), F.col("rejected").alias("said")))
    )
    each = both.join(fork, "pair_id").select("pair_id", "turn", F.explode(parts).alias("p")).where("p.said is not null")
    role = F.col("p.said.role")
    learnt = (F.col("p.part") != "prompt") & F.coalesce(role == "assistant", F.lit(False))
    return each.select("pair_id", F.col("p.part").alias("part"), "turn", role.alias("role"), _rendered(role, F.col("p.said.text")).alias("rendered"), learnt.cast("int").alias("loss_mask"))


def last_reply_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from (conv_id, turn, role, text): each conversation up to its last reply of the assistant, against
    the same with the last reply of the conversation whose id differs in the lowest bit. Without such a reply nothing is
    rejected in its place; conversations without a reply make no pair."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").where("conv_id is not null and turn is not null")
    replies = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    cut = replies.select("conv_id", F.col("last.turn").alias("at"), F.col("last.text").alias("reply"))
    kept = turns.join(cut.select("conv_id", "at"), "conv_id").where("turn <= at")
    chosen = kept.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    other = cut.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("other"))
    swapped = cut.join(other, "conv_id").select(F.col("conv_id").alias("pair_id"), F.col("at").alias("turn"), F.lit("assistant").alias("role"), F.col("other").alias("text"))
    rejected = kept.where("turn < at").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text").unionByName(swapped)
    return chosen, rejected
