"""Chat formatting: preference pairs with a shared prompt.

A pair is a chosen and a rejected conversation.  Their longest common
prefix of turns (same role and text) is rendered once as the prompt; what
remains of either is rendered as a completion with a mask: the spans, in
characters of the completion, that carry loss (texts and end marks of the turns
whose role is in ``train_roles``).

DataFrame functions only.  Both sides are aggregated in one shuffle by
pair, with one row of arrays a pair as the outcome asks for; turns of a
conversation are the unit that has to fit into a task.

Defined cases: turns are ordered by number (NULL first), then role, then
text, so ties and repeated rows have one order and stay repeated.  A NULL
role is rendered and compared as the empty text, a NULL text likewise.  A
pair that lacks one side has no common turns and an empty completion on
that side; equal conversations have empty completions.  Rows whose pair
is NULL are left out (they belong to no pair).  Only the named columns are
read, so extra columns never clash; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks around a turn.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAIN_ROLES = ("assistant",)


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def render_turns(turns: Column) -> Column:
    """Concatenation of rendered turns (an array of structs role, text)."""
    return F.array_join(F.transform(turns, _render), "")


def loss_spans(turns: Column, train_roles: Sequence[str]) -> Column:
    """``array<struct<start,stop>>`` of the trained texts, end mark
    included, in characters of ``render_turns(turns)``."""
    head = len(OPEN) + len(MIDDLE)
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans"))

    def add(acc: Column, turn: Column) -> Column:
        begin = acc["at"] + F.length(turn["role"]) + F.lit(head)
        stop = begin + F.length(turn["text"]) + F.lit(len(CLOSE))
        span = F.array(F.struct(begin.alias("start"), stop.alias("stop")))
        trained = turn["role"].isin(*train_roles)
        return F.struct(
            stop.alias("at"), F.when(trained, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")
        )

    return F.aggregate(turns, start, add, lambda acc: acc["spans"])


def format_preferences(
    chosen: DataFrame,
    rejected: DataFrame,
    *,
    pair_col: str = "pair_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    train_roles: Sequence[str] = TRAIN_ROLES,
) -> DataFrame:
    """``pair_id, n_chosen, n_rejected, n_common, prompt, chosen,
    rejected, chosen_spans, rejected_spans``, one row a pair."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col(pair_col).alias("pair_id"),
            F.struct(
                F.col(turn_col).cast("bigint").alias("turn"),
                F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
            ).alias("t"),
            F.lit(name).alias("side"),
        ).where(F.col("pair_id").isNotNull())

    def turns(name: str) -> Column:  # collect_list leaves NULLs out
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, F.col("t"))))

    both = side(chosen, "c").unionByName(side(rejected, "r"))
    pairs = both.groupBy("pair_id").agg(turns("c").alias("c"), turns("r").alias("r"))
    differs = F.filter(
        F.sequence(F.lit(1), F.least(F.size("c"), F.size("r"))),
        lambda i: (F.element_at("c", i)["role"] != F.element_at("r", i)["role"])
        | (F.element_at("c", i)["text"] != F.element_at("r", i)["text"]),
    )
    shorter = F.least(F.size("c"), F.size("r"))
    pairs = pairs.withColumn(
        "n", F.when(shorter == 0, 0).otherwise(F.coalesce(F.array_min(differs) - 1, shorter)).cast("int")
    )

    def rest(c: str) -> Column:
        return F.slice(F.col(c), F.col("n") + 1, F.size(c))

    return pairs.select(
        "pair_id",
        F.size("c").alias("n_chosen"),
        F.size("r").alias("n_rejected"),
        F.col("n").alias("n_common"),
        render_turns(F.slice(F.col("c"), F.lit(1), F.col("n"))).alias("prompt"),
        render_turns(rest("c")).alias("chosen"),
        render_turns(rest("r")).alias("rejected"),
        loss_spans(rest("c"), train_roles).alias("chosen_spans"),
        loss_spans(rest("r"), train_roles).alias("rejected_spans"),
    )


def with_swapped_reply(conversations: DataFrame, *, role: str = "assistant") -> DataFrame:
    """Rejected conversations by mismatch: the turns before a
    conversation's last ``role`` turn, then the last ``role`` turn of the
    conversation whose id follows by one (none: nothing follows).
    Columns ``conv_id, turn, role, text``; a conversation without such a
    turn keeps all its turns."""
    turns = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    last = (
        turns.where((F.col("role") == role) & F.col("turn").isNotNull())
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
        .select("conv_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("last_text"))
    )
    before = (
        turns.join(last.select("conv_id", "last_turn"), "conv_id", "left")
        .where("last_turn is null or turn is null or turn < last_turn")
        .select("conv_id", "turn", "role", "text")
    )
    partner = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last_text").alias("text"))
    reply = last.select("conv_id", F.col("last_turn").alias("turn")).join(partner, "conv_id")
    return before.unionByName(reply.select("conv_id", "turn", F.lit(role).alias("role"), "text"))
