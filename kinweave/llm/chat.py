"""Chat formatting by perspective rotation: every participant of a dialogue is the assistant once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What stands around a message.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _escaped(text: Column) -> Column:
    """Text in which no marker can be read: a backslash parts the marker's first two characters."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|im_", r"<\\|im_")


def _name(who: Column) -> Column:
    """A speaker's name as it stands in a head: without markers, and on one line."""
    return F.regexp_replace(_escaped(who), r"[\x00-\x1F\x7F\x{85}\x{2028}\x{2029}]+", " ")


def rotate_perspectives(conversations: DataFrame) -> DataFrame:
    """Each dialogue once for each of its participants, rendered with that speaker as assistant.

    ``conversations`` has conv_id, turn, role (the speaker) and text; other columns are ignored. Returns one row per
    conversation and participant: conv_id, perspective, n_turns, n_own, rendered, mask (array of start and size, in
    characters of rendered: the assistant's words and the closing marker, what a model is to learn), n_masked. Others
    appear as users with a name. Turns go by turn number, ties by role and text; a null text is empty; a turn without a
    role is spoken by ``unknown``; rows without conv_id take no part; repeated rows
    repeat; names are written on one line and without markers, so that no name can open a message. A conversation's messages
    meet in one row, as they must in the result. Built-in functions only.
    """
    speaker = F.when(F.length(F.trim("role")) > 0, F.trim("role")).otherwise("unknown")
    turns = conversations.where("conv_id is not null").select("conv_id", F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), speaker.alias("who"), _escaped(F.col("text")).alias("text")).alias("m"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("messages"))
    seen = whole.select("conv_id", "messages", F.explode(F.array_distinct("messages.who")).alias("perspective"))

    # Numbers of a perspective's head and of its body by turn; each is a sum over all turns before, from one pass by a window.
    own = F.col("m")["who"] == F.col("perspective")
    head = F.when(own, F.lit(f"{OPEN}assistant\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), _name(F.col("m")["who"]), F.lit("\n")))
    body = F.concat(F.col("m")["text"], F.lit(CLOSE))
    turns_ = seen.select("conv_id", "perspective", F.posexplode("messages").alias("at", "m")).select("conv_id", "perspective", "at", own.alias("own"), head.alias("head"), body.alias("body"))
    before = Window.partitionBy("conv_id", "perspective").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns_.withColumn("start", F.coalesce(F.sum(F.length("head") + F.length("body")).over(before), F.lit(0)) + F.length("head"))
    made = placed.groupBy("conv_id", "perspective").agg(
        F.count("*").alias("n_turns"),
        F.count_if("own").alias("n_own"),
        F.sort_array(F.collect_list(F.struct("at", F.concat("head", "body").alias("part")))).alias("parts"),
        F.sort_array(F.collect_list(F.when(F.col("own"), F.struct(F.col("start").cast("int").alias("start"), F.length("body").alias("size"))))).alias("mask"),
        F.coalesce(F.sum(F.when(F.col("own"), F.length("body"))), F.lit(0)).cast("long").alias("n_masked"),
    )
    return made.select("conv_id", "perspective", "n_turns", "n_own", F.array_join("parts.part", "").alias("rendered"), "mask", "n_masked")
