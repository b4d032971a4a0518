"""Preference formatting of conversation pairs (native).

A pair has a chosen and a rejected conversation.  Their longest common prefix
of turns (equal role and text) is rendered once, as the prompt; what follows on
either side is rendered as that side's completion.  Each completion carries its
loss mask as the spans (start, end; code points of the completion) that an
assistant wrote: training counts those and nothing else.

All of it is array expressions over one row per conversation, inside whole
stages; the turns are scanned and exchanged once to meet their conversation (in
``pairs_by_last_answer``, it and its neighbour).  A conversation is one value of
the result, so its turns come together in one row by the nature of the output
and the longest conversation bounds a row; no key other than the conversation's
own is used, so a first turn or a whole conversation that many share costs nothing.

Edge cases: a turn without a conversation's key is a conversation of its own
(however many there are, they share no group); turns are ordered by (turn, role, text), so ties have a fixed
order; a null role is rendered as ``unknown`` and a null text as empty; an
empty side has an empty completion; a pair without difference has two empty
completions and ``usable`` false; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def _turn() -> list[Column]:
    return [F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text")]


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: ``key, turns`` (sorted array of turn, role, text)."""
    one = F.struct(*_turn())
    named = turns.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return named.unionByName(turns.filter(F.col(key).isNull()).select(key, F.array(one).alias("turns")))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns two turn arrays share."""
    shortest = F.least(F.size(a), F.size(b))
    at = F.when(shortest > 0, F.sequence(F.lit(0), shortest - 1)).otherwise(F.array().cast("array<int>"))
    differs = F.filter(at, lambda i: (F.get(a, i)["role"] != F.get(b, i)["role"])
                       | (F.get(a, i)["text"] != F.get(b, i)["text"]))
    return F.coalesce(F.array_min(differs), shortest)


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), turn["role"], F.lit("\n"), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def loss_spans(turns: Column) -> Column:
    """Spans of the rendered turns that an assistant wrote, end mark included."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc, turn):
        end = acc["at"] + F.length(_rendered(turn))
        head = acc["at"] + F.length(turn["role"]) + F.lit(len(BEGIN) + 1)
        span = F.array(F.struct(head.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(turn["role"] == "assistant", F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(turns, start, add)["spans"]


def format_preferences(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """``pairs``: key, chosen, rejected (turn arrays).  Per pair: the prompt,
    both completions with their loss spans, the number of prompt turns and
    whether the sides differ in something an assistant wrote."""
    none = F.array().cast(TURNS)
    p = pairs.select(key, F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    p = p.withColumn("n", common_prefix(F.col("c"), F.col("r")))

    def after(side: str) -> Column:
        return F.slice(F.col(side), F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))

    p = p.select(key, "n", F.slice("c", F.lit(1), F.col("n")).alias("same"),
                 after("c").alias("c"), after("r").alias("r"))
    return p.select(
        key, F.col("n").alias("prompt_turns"), render(F.col("same")).alias("prompt"),
        render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
        loss_spans(F.col("c")).alias("chosen_loss"), loss_spans(F.col("r")).alias("rejected_loss")) \
        .withColumn("usable", (F.size("chosen_loss") > 0) & (F.size("rejected_loss") > 0))


def pairs_by_last_answer(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Preference pairs out of the turns of plain conversations: chosen is the
    conversation, rejected is the same up to its last assistant turn, which is
    answered by the last assistant turn of its neighbour (key with the lowest bit
    flipped, so keys must be whole numbers).  Without a neighbour or an answer of
    its own, the rejected side ends before that turn (or equals the chosen one)."""
    kind = turns.schema[key].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"pairs_by_last_answer needs whole-number keys, {key} is {kind.simpleString()}; "
                        "build the pairs yourself and give them to format_preferences")
    number = F.col(key).cast("long")
    # neighbours share all but the lowest bit: one exchange brings both together
    side = F.struct(number.bitwiseAND(F.lit(1).cast("long")).alias("bit"), *_turn())
    both = turns.filter(F.col(key).isNotNull()).groupBy(F.shiftright(number, 1).alias("__pair")) \
        .agg(F.sort_array(F.collect_list(side)).alias("both"))
    both = both.select("__pair", "both", F.explode(F.array_distinct(F.transform("both", lambda t: t["bit"]))).alias("__bit"))

    def of(mine: bool) -> Column:
        rows = F.filter("both", lambda t: (t["bit"] == F.col("__bit")) == F.lit(mine))
        return F.transform(rows, lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text")))

    own = both.select(F.shiftleft("__pair", 1).bitwiseOR(F.col("__bit")).cast(kind).alias("pair_id"),
                      of(True).alias("chosen"), of(False).alias("mate"))
    own = own.unionByName(turns.filter(F.col(key).isNull()).select(
        F.col(key).alias("pair_id"), F.array(F.struct(*_turn())).alias("chosen"), F.array().cast(TURNS).alias("mate")))

    def last(side: str) -> Column:
        spots = F.transform(F.col(side), lambda t, i: F.when(t["role"] == "assistant", i))
        return F.array_max(F.filter(spots, lambda i: i.isNotNull()))

    own = own.withColumns({"at": last("chosen"), "other": F.get("mate", last("mate"))["text"]})
    swapped = F.struct(F.get("chosen", F.col("at"))["turn"].alias("turn"), F.lit("assistant").alias("role"),
                       F.col("other").alias("text"))
    head = F.slice("chosen", F.lit(1), F.col("at"))
    rejected = F.when(F.col("at").isNull(), F.col("chosen")).when(F.col("other").isNull(), head) \
        .otherwise(F.concat(head, F.array(swapped)))
    return own.select("pair_id", "chosen", rejected.alias("rejected"))
