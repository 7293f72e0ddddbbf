"""Preference formatting: paired conversations to prompt and masked completions.

`chosen` and `rejected` hold turns (pair_id, turn, role, text). Their longest
common prefix of equal turns (role and text) is rendered once as the prompt;
the turns after it are each side's completion. A turn renders as
`<|role|>\\n` text `<|end|>\\n`. A completion's mask is the character spans of
its assistant turns (text and end mark): those are trained on, everything else
is not.

Everything is DataFrame functions: one grouped list of turns per pair and
side (a rendered conversation is one row by nature), a merge join of the two
sides, and array functions for the prefix. Turns sort by (turn, role, text);
repeated rows of a turn stay; null roles and texts render as empty and equal
each other. A pair with one side only has an empty other side; a pair whose
sides are equal has empty completions. A null pair id is a pair of its own.
Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED = "assistant"


def _turns(rows: DataFrame, key: str, name: str) -> DataFrame:
    item = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy(F.col(key).alias("pair_id")).agg(F.transform(F.array_sort(F.collect_list(item)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name))


def render(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def mask(turns: Column) -> Column:
    """Spans [start, end) of the trained characters, as `start-end` joined by `;`."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.length(t["role"]) + 5
        end = acc["at"] + F.length(render(t))
        span = F.concat((begin).cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] != TRAINED, acc["spans"]).when(acc["spans"] == "", span)
                        .otherwise(F.concat(acc["spans"], F.lit(";"), span)).alias("spans"))

    return F.aggregate(turns, first, step, lambda acc: acc["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """(pair_id, prompt, chosen, rejected, chosen_mask, rejected_mask, prefix_turns, chosen_turns, rejected_turns)."""
    a, b = _turns(chosen, key, "a"), _turns(rejected, key, "b").withColumnRenamed("pair_id", "_pair")
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = a.join(b, F.col("pair_id").eqNullSafe(F.col("_pair")) , "full").select(
        F.coalesce("pair_id", "_pair").alias("pair_id"), F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    short = F.least(F.size("a"), F.size("b"))
    differ = F.array_position(F.transform(F.arrays_zip(F.slice("a", 1, short).alias("x"), F.slice("b", 1, short).alias("y")), lambda z: z["x"] == z["y"]), False)
    p = F.when(differ == 0, short).otherwise((differ - 1).cast("int"))
    both = both.withColumn("prefix_turns", p)
    rest = lambda c: F.slice(c, F.col("prefix_turns") + 1, F.greatest(F.size(c) - F.col("prefix_turns"), F.lit(0)))
    return (both.withColumn("p", F.slice("a", 1, F.col("prefix_turns"))).withColumn("x", rest("a")).withColumn("y", rest("b"))
            .select("pair_id", _rendered(F.col("p")).alias("prompt"), _rendered(F.col("x")).alias("chosen"), _rendered(F.col("y")).alias("rejected"),
                    mask(F.col("x")).alias("chosen_mask"), mask(F.col("y")).alias("rejected_mask"), "prefix_turns",
                    F.size("x").alias("chosen_turns"), F.size("y").alias("rejected_turns")))


def stale_reply_pairs(conversations: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Pairs for a table without preferences: chosen is the conversation as it
    is; in rejected the last assistant turn repeats the conversation's first
    assistant text (a stale reply), or is missing where there is only one."""
    c = conversations.select(F.col(key).alias("pair_id"), "turn", "role", "text")
    ends = (c.where(F.col("role") == TRAINED).groupBy("pair_id").agg(
        F.min(F.struct("turn", F.coalesce("text", F.lit("")).alias("t"))).alias("first"), F.max("turn").alias("last"))
        .select(F.col("pair_id").alias("_pair"), F.col("first.turn").alias("_first"), F.col("first.t").alias("_text"), F.col("last").alias("_last")))
    r = c.join(ends, F.col("pair_id").eqNullSafe(F.col("_pair")), "left")
    final = F.coalesce((F.col("role") == TRAINED) & F.col("turn").eqNullSafe(F.col("_last")), F.lit(False))
    r = r.where(~(final & F.col("_first").eqNullSafe(F.col("_last")))).select("pair_id", "turn", "role", F.when(final, F.col("_text")).otherwise(F.col("text")).alias("text"))
    return c, r
