"""Preference formatting of chosen and rejected conversations.

The two conversations of a pair share a longest common prefix of turns: all turns
before the first turn number at which they differ. The prefix is rendered once, as the prompt; what follows on
either side is that side's completion, with the assistant's words marked to be learned and all else masked.

Turns stay rows from first to last (a pair is never gathered into one row or task): a
digest of every turn is compared by (pair, turn number), the first difference is the least of a grouped
aggregate, and a join on the pair puts every turn into its part. DataFrame functions only.

Defined cases: turns of equal number are one step that agrees when both sides hold the same
turns, however often repeated; a null turn number comes last and is never part of a prefix; null texts
and roles render as empty ones but differ from them; two equal conversations are all prompt, a
side without its other is all completion; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, ROLE_END, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED = "assistant"
_LAST = (1 << 63) - 1


def render(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(F.lit(OPEN), F.coalesce(role, empty), F.lit(ROLE_END), F.coalesce(text, empty), F.lit(CLOSE))


def format_preferences(turns: DataFrame) -> DataFrame:
    """(pair_id, part, turn, role, rendered, learn_from, learn_to) of turns (pair_id, side, turn, role, text).

    ``side`` is chosen or rejected; ``part`` is prompt, chosen or rejected. A part's text is
    its ``rendered`` in the order of turn; characters learn_from to learn_to of each are learned (none: 0 and 0).
    """
    t = turns.select("pair_id", "side", F.coalesce("turn", F.lit(_LAST)).alias("step"), "turn", "role", "text")
    null = F.lit("\0")  # tells null from empty
    digest = F.sha2(F.concat(F.coalesce(F.col("role"), null), F.lit("\0\0"), F.coalesce(F.col("text"), null)), 256)
    same = t.groupBy("pair_id", "step", digest.alias("digest")).agg(
        F.bool_or(F.col("side") == "chosen").alias("c"), F.bool_or(F.col("side") == "rejected").alias("r"))
    differ = same.where(~F.col("c") | ~F.col("r") | (F.col("step") == _LAST)).groupBy("pair_id").agg(F.min("step").alias("first"))
    differ = differ.withColumnRenamed("pair_id", "_pair")
    placed = t.join(differ, F.col("pair_id").eqNullSafe(F.col("_pair")), "left").withColumn(
        "shared", F.coalesce(F.col("step") < F.col("first"), F.lit(True)))
    part = F.when(F.col("shared"), F.lit("prompt")).otherwise(F.col("side"))
    text = render(F.col("role"), F.col("text"))
    learn = ~F.col("shared") & F.coalesce(F.col("role") == LEARNED, F.lit(False))
    head = len(OPEN) + len(LEARNED) + len(ROLE_END)
    zero = F.lit(0)
    return (placed.where(~F.col("shared") | (F.col("side") == "chosen"))
            .select("pair_id", part.alias("part"), "turn", "role", text.alias("rendered"),
                    F.when(learn, F.lit(head)).otherwise(zero).alias("learn_from"),
                    # the mark that closes the turn is learned, the line feed after it is not
                    F.when(learn, F.length(text) - 1).otherwise(zero).alias("learn_to")))
