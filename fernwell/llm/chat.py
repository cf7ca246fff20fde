"""Preference formatting with DataFrame functions only.

Input: two tables of turns (pair_id, turn, role, text), the chosen and the rejected conversations.
For each pair the longest common prefix of turns is rendered once as the prompt; what follows it is
rendered twice, as the chosen and the rejected completion, each with the character spans that carry
loss (the bodies of assistant turns with their end mark).

Cases: a null role is `user`, a null text is empty; turns are ordered by number, then role, then
text; repeated rows count once; null turns come first; a pair found on one side only has an empty
other side; equal conversations have two empty completions; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks of the rendered text.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def turns_of(table: DataFrame, side: str, key: str = "pair_id") -> DataFrame:
    """(pair_id, side array): the turns of each pair in order, without repeated rows."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return (
        table.select(F.col(key).cast("long").alias("pair_id"), turn.alias("t"))
        .groupBy("pair_id")
        .agg(F.array_sort(F.collect_set("t")).alias(side))
    )


def _prefix_length(a: str, b: str) -> Column:
    same = f"zip_with({a}, {b}, (x, y) -> x.role <=> y.role AND x.text <=> y.text)"
    return F.expr(
        f"CASE WHEN array_position({same}, false) = 0 THEN greatest(size({a}), size({b}))"
        f" ELSE array_position({same}, false) - 1 END"
    ).cast("int")


def _render(turns: str) -> Column:
    return F.concat_ws(
        "",
        F.transform(
            F.col(turns),
            lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE)),
        ),
    )


def _loss_spans(turns: str) -> Column:
    """start:end of the loss-bearing characters of a rendered completion, comma-joined."""
    head, tail = len(OPEN) + len(MIDDLE), len(CLOSE)
    return F.expr(
        f"""array_join(aggregate({turns},
            struct(0 AS at, cast(array() AS array<string>) AS out),
            (s, t) -> struct(
              s.at + {head} + length(t.role) + length(t.text) + {tail} AS at,
              CASE WHEN t.role = 'assistant' THEN array_append(s.out, concat(
                  cast(s.at + {head} + length(t.role) AS string), ':',
                  cast(s.at + {head} + length(t.role) + length(t.text) + {tail} - 1 AS string)))
              ELSE s.out END AS out),
            s -> s.out), ',')"""
    )


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, chosen_loss, rejected, rejected_loss."""
    none = F.expr("cast(array() AS array<struct<turn: bigint, role: string, text: string>>)")
    both = (
        turns_of(chosen, "c")
        .join(turns_of(rejected, "r"), "pair_id", "full_outer")
        .select("pair_id", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r"))
    )
    split = both.withColumn("n_prompt_turns", _prefix_length("c", "r")).select(
        "pair_id",
        "n_prompt_turns",
        F.expr("slice(c, 1, n_prompt_turns)").alias("p"),
        F.expr("slice(c, n_prompt_turns + 1, greatest(size(c), 1))").alias("c"),
        F.expr("slice(r, n_prompt_turns + 1, greatest(size(r), 1))").alias("r"),
    )
    return split.select(
        "pair_id",
        F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
        _render("p").alias("prompt"),
        _render("c").alias("chosen"),
        _loss_spans("c").alias("chosen_loss"),
        _render("r").alias("rejected"),
        _loss_spans("r").alias("rejected_loss"),
    )


def mismatched_replies(conversations: DataFrame) -> DataFrame:
    """Rejected conversations (conv_id, turn, role, text) for a table that has none: each
    conversation with its last assistant reply replaced by that of its neighbour, whose id differs
    in the last bit. Where either has no assistant turn, the conversation stays as it is."""
    c = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    last = (
        c.where("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("l"))
        .select("conv_id", F.col("l.turn").alias("last_turn"), F.col("l.text").alias("reply"))
    )
    other = last.select(F.expr("conv_id ^ 1L").alias("conv_id"), F.col("reply").alias("other_reply"))
    swap = last.join(other, "conv_id", "left").select("conv_id", "last_turn", "other_reply")
    return c.join(swap, "conv_id", "left").select(
        "conv_id",
        "turn",
        "role",
        F.when(
            (F.col("turn").eqNullSafe(F.col("last_turn"))) & (F.col("role") == "assistant") & F.col("other_reply").isNotNull(),
            F.col("other_reply"),
        )
        .otherwise(F.col("text"))
        .alias("text"),
    )
