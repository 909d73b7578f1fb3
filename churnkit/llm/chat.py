"""Preference formatting of chosen and rejected conversations, with DataFrame functions only.

A conversation is an array of turns (role, text). The longest common turn prefix of the two conversations
of a pair is rendered once as the prompt; what follows in each is rendered as a completion, in segments of which
only assistant replies (with their end marker) are trained. Work is per row: no shuffle beyond the assembly of the turns.

Null text: empty. Null role: ``user``. A null, empty or missing conversation has no turns: an empty prompt and
completion. Equal conversations: all turns are prompt, both completions empty, ``differs`` false. Ties in the
turn number go by role, then text; repeated rows are turns each; a null turn number comes first. Rows without a
conversation id belong to no conversation and are left out. Markers inside a text are broken by a space, so no text
can end its turn. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, END = "<|im_start|>", "<|im_end|>"
NO_TURNS = "array<struct<role:string,text:string>>"


def turns(turn: Column, role: Column, text: Column, when: Column | None = None) -> Column:
    """Aggregate: the turns of a group in order, as array<struct<role, text>>; rows not ``when`` are skipped."""
    one = F.struct(turn.alias("turn"), F.coalesce(role, F.lit("user")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    rows = F.sort_array(F.collect_list(one if when is None else F.when(when, one)))
    return F.transform(rows, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal in both."""
    n = F.least(F.size(a), F.size(b))
    differ = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x != y), True)
    return F.when(differ > 0, (differ - 1).cast("int")).otherwise(n)


def _safe(text: Column) -> Column:
    for mark in (BEGIN, END):
        text = F.replace(text, F.lit(mark), F.lit(mark.replace("<|", "<| ", 1)))
    return text


def segments(turn_array: Column) -> Column:
    """array<struct<text, train>>: the header of each turn, then its content with the end marker."""
    def two(t: Column) -> Column:
        header = F.concat(F.lit(BEGIN), _safe(t["role"]), F.lit("\n"))
        body = F.concat(_safe(t["text"]), F.lit(END))
        return F.array(F.struct(header.alias("text"), F.lit(False).alias("train")),
                       F.struct(body.alias("text"), (t["role"] == "assistant").alias("train")),
                       F.struct(F.lit("\n").alias("text"), F.lit(False).alias("train")))
    return F.flatten(F.transform(turn_array, two))


def rendered(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda s: s["text"]), "")


def mask(parts: Column) -> Column:
    """The segments' lengths in code points, each with t (trained) or m (masked), comma-joined."""
    return F.array_join(F.transform(parts, lambda s: F.concat(
        F.length(s["text"]).cast("string"), F.when(s["train"], "t").otherwise("m"))), ",")


def format_preferences(pairs: DataFrame, keep: list[str], chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``keep`` columns, then n_prefix, differs, prompt, and text and mask of both completions.

    ``chosen`` and ``rejected`` are turn arrays."""
    empty = F.array().cast(NO_TURNS)
    a, b = F.coalesce(F.col(chosen), empty), F.coalesce(F.col(rejected), empty)
    rows = pairs.select(*keep, a.alias("__a"), b.alias("__b")).withColumn("__n", common_prefix(F.col("__a"), F.col("__b")))
    def rest(c: str) -> Column:
        return F.slice(F.col(c), F.col("__n") + 1, F.greatest(F.size(c) - F.col("__n"), F.lit(0)))
    rows = rows.select(*keep, F.col("__n").cast("long").alias("n_prefix"),
                       ((F.size("__a") > F.col("__n")) | (F.size("__b") > F.col("__n"))).alias("differs"),
                       rendered(segments(F.slice("__a", 1, F.col("__n")))).alias("prompt"),
                       segments(rest("__a")).alias("__a"), segments(rest("__b")).alias("__b"))
    return rows.select(*keep, "n_prefix", "differs", "prompt",
                       rendered(F.col("__a")).alias("chosen"), mask(F.col("__a")).alias("chosen_mask"),
                       rendered(F.col("__b")).alias("rejected"), mask(F.col("__b")).alias("rejected_mask"))


def swapped_replies(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """(conv_id, chosen, rejected): each conversation against itself with its last assistant reply taken from its
    neighbour (ids 2k and 2k + 1; ids that are no integers have none). Without a neighbour or a reply on either side, rejected
    ends before the reply."""
    name = F.col(f"`{conv_id}`")
    numbered = isinstance(conversations.schema[conv_id].dataType, T.IntegralType)
    rows = conversations.where(name.isNotNull()).select(name.alias("c"), (F.shiftright(name, 1) if numbered else name).alias("pair"),
                                                        F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    def side(odd: int) -> Column:
        return turns(F.col("turn"), F.col("role"), F.col("text"), F.col("c").bitwiseAND(F.lit(1)) == odd if numbered else F.lit(odd == 0))

    both = rows.groupBy("pair").agg(side(0).alias("even"), side(1).alias("odd"))

    def last_reply(a: Column) -> Column:           # 1-based place of the last assistant turn, 0 without one
        back = F.array_position(F.transform(F.reverse(a), lambda t: t["role"] == "assistant"), True)
        return F.when(back > 0, F.size(a) - back + 1).otherwise(0).cast("int")

    def against(own: Column, other: Column, odd: int) -> Column:
        at, reply = last_reply(own), F.slice(other, F.greatest(last_reply(other), F.lit(1)), F.when(last_reply(other) > 0, 1).otherwise(0))
        kept = F.slice(own, 1, F.when(at > 0, at - 1).otherwise(F.size(own)))
        after = F.slice(own, at + 1, F.when(at > 0, F.size(own) - at).otherwise(0))
        return F.struct((F.shiftleft("pair", 1) + odd if numbered else F.col("pair")).alias("conv_id"), own.alias("chosen"),
                        F.when(at > 0, F.concat(kept, reply, after)).otherwise(own).alias("rejected"))

    even, odd = F.col("even"), F.col("odd")
    out = both.select(F.explode(F.array(against(even, odd, 0), against(odd, even, 1))).alias("p")).select("p.*")
    return out.where(F.size("chosen") > 0).withColumnRenamed("conv_id", conv_id)
