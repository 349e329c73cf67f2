"""Preference formatting: one prompt and two masked completions per pair, in DataFrame
functions only.

The prompt is the longest common prefix of the turns of the chosen and the rejected
conversation, rendered once; what is left of each is its completion. Masks are the
character ranges of a completion that are learned from: the texts of assistant turns and
the marks that end them, neither role headers nor other roles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks around a turn.
HEAD, AFTER_ROLE, END = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order.

    Turns with the same number stand in order of role and text, repeated rows once; a null
    number comes first; null roles and texts are empty. Rows without a conversation id
    belong to none and are left out. A conversation is the unit of training and is
    gathered in one row.
    """
    one = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), one.alias("t"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_set("t")).alias("turns"))
    return gathered.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).cast(TURNS).alias("turns"))


def reply_pairs(talks: DataFrame) -> DataFrame:
    """``conv_id, chosen, rejected``: each conversation up to its last assistant turn against
    the same with another reply in that turn's place: the assistant's reply before it, or
    where there is none an echo of the turn before. Conversations without an assistant
    turn that follows another turn give no pair.
    """
    place = F.transform("turns", lambda t, i: F.when(t["role"] == LEARNED, i + 1))
    spots = talks.withColumn("at", F.array_compact(place)).withColumn("last", F.element_at("at", -1)).where("size(at) > 0 and last > 1")
    before = F.when(F.size("at") > 1, F.element_at("turns", F.try_element_at("at", F.lit(-2)))["text"]).otherwise(F.element_at("turns", F.col("last") - 1)["text"])
    reply = F.struct(F.lit(LEARNED).alias("role"), before.alias("text"))
    return spots.select(
        "conv_id",
        F.slice("turns", 1, F.col("last")).alias("chosen"),
        F.concat(F.slice("turns", 1, F.col("last") - 1), F.array(reply)).cast(TURNS).alias("rejected"),
    )


def _turn(t: Column) -> Column:
    return F.concat(F.lit(HEAD), t["role"], F.lit(AFTER_ROLE), t["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def mask(turns: Column) -> Column:
    """Character ranges of the rendered turns that are learned from, end exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(t["role"]) + len(HEAD + AFTER_ROLE)
        end = begin + F.length(t["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == LEARNED, F.concat(a["out"], span)).otherwise(a["out"]).alias("out"))

    return F.aggregate(turns, start, step)["out"]


def preferences(pairs: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``conv_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    ``pairs`` has an id and two arrays of (role, text), ``chosen`` and ``rejected``. Turns are equal if
    role and text are. If one conversation is a prefix of the other its completion is
    empty, if both are equal both are. A null conversation is an empty one. Pairs that
    repeat are formatted alike. Nothing is shuffled.
    """
    turns = lambda c: F.coalesce(F.col(c).cast(TURNS), F.array().cast(TURNS))
    given = pairs.select(F.col(id_col), turns("chosen").alias("a"), turns("rejected").alias("b"))
    same = F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y))
    differ = F.array_position(same, F.lit(False)).cast("int")
    short = F.least(F.size("a"), F.size("b"))
    common = given.withColumn("n_common", F.when(differ == 0, short).otherwise(F.least(differ - 1, short)))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    cut = common.withColumns({"p": F.slice("a", 1, F.col("n_common")), "a": rest("a"), "b": rest("b")})
    return cut.select(
        F.col(id_col).alias("conv_id"),
        "n_common",
        render(F.col("p")).alias("prompt"),
        render(F.col("a")).alias("chosen"),
        render(F.col("b")).alias("rejected"),
        mask(F.col("a")).alias("chosen_mask"),
        mask(F.col("b")).alias("rejected_mask"),
    )
