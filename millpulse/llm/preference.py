"""Preference pairs: one prompt, and a chosen and a rejected completion with loss masks.

Everything stays one row per turn. A conversation of any length is never gathered into one row, group or task:
the longest common prefix is the smallest turn at which two conversations differ, which is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
UNKNOWN_ROLE = "unknown"
END = "<|end|>\n"


def tidy_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row (key, turn, role, text) per turn.

    Rows without key or turn belong to no conversation and take no part. Of several rows for one turn the smallest
    (role, text) stands; a NULL role is "unknown", a NULL text is empty.
    """
    said = F.struct(F.coalesce("role", F.lit(UNKNOWN_ROLE)).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where(F.col(key).isNotNull() & F.col("turn").isNotNull())
    rows = rows.select(F.col(key).alias("pair_id"), F.col("turn").cast("long").alias("turn"), said.alias("said"))
    return rows.groupBy("pair_id", "turn").agg(F.min("said").alias("said")).select("pair_id", "turn", "said.role", "said.text")


def with_replaced_answers(turns: DataFrame) -> DataFrame:
    """The rejected side of each conversation, made from the table alone: up to its last assistant turn, and there the
    last answer of the conversation whose id is one larger (empty if there is none). Conversations without an answer
    are returned as they are, and later find themselves identical."""
    answer = F.max(F.when(F.col("role") == TRAINED_ROLE, F.struct("turn", "text")))
    last = turns.groupBy("pair_id").agg(answer.alias("answer"))
    other = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("answer.text").alias("other_text"))
    last = last.select("pair_id", F.col("answer.turn").alias("last_turn")).join(other, "pair_id", "left")
    joined = turns.join(last, "pair_id").where(F.col("last_turn").isNull() | (F.col("turn") <= F.col("last_turn")))
    text = F.when(F.col("turn") == F.col("last_turn"), F.coalesce("other_text", F.lit(""))).otherwise(F.col("text"))
    return joined.select("pair_id", "turn", "role", text.alias("text"))


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit(END))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per rendered turn: pair_id, part (prompt, chosen, rejected), turn, role, rendered, loss_start, loss_end.

    Both sides have the columns of `tidy_turns`. The prompt holds the turns before the first one that differs or that
    only one side has. It is rendered once and carries no loss. In the completions the loss covers the text and end
    mark of assistant turns, as a half-open span of code points of `rendered`; other turns have an empty span.
    Identical conversations leave a prompt and no completion.
    """
    left = chosen.select("pair_id", "turn", F.struct("role", "text").alias("chosen"))
    right = rejected.select("pair_id", "turn", F.struct("role", "text").alias("rejected"))
    both = left.join(right, ["pair_id", "turn"], "full")
    split = both.groupBy("pair_id").agg(
        F.min(F.when(~F.col("chosen").eqNullSafe(F.col("rejected")), F.col("turn"))).alias("split_turn")
    )
    aligned = both.join(split, "pair_id")
    shared = F.col("split_turn").isNull() | (F.col("turn") < F.col("split_turn"))
    part = lambda name, said: F.struct(F.lit(name).alias("part"), said.alias("said"))
    parts = F.when(shared, F.array(part("prompt", F.col("chosen")))).otherwise(
        F.filter(F.array(part("chosen", F.col("chosen")), part("rejected", F.col("rejected"))), lambda x: x.said.isNotNull())
    )
    rows = aligned.select("pair_id", "turn", F.explode(parts).alias("p")).select(
        "pair_id", "p.part", "turn", "p.said.role", "p.said.text"
    )
    rows = rows.withColumn("rendered", _render(F.col("role"), F.col("text")))
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED_ROLE)
    start = F.length("role") + 5
    stop = F.length("rendered")
    return rows.select(
        "pair_id", "part", "turn", "role", "rendered",
        F.when(trained, start).otherwise(stop).cast("int").alias("loss_start"), stop.cast("int").alias("loss_end"),
    )
