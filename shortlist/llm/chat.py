"""Multi-party dialogues seen by each of their participants, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortlist.plans.ordering import global_row_number
from shortlist.session import durable

PART_TURNS = 64  # turns in one output row

# fixed: the markup of a turn
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def _segment(turn: Column, speaker: Column) -> Column:
    own = turn["speaker"] == speaker
    head = F.when(own, F.lit(BEGIN + "assistant\n")).otherwise(
        F.concat(F.lit(BEGIN + "user name="), F.regexp_replace(turn["speaker"], r"\s+", "_"), F.lit("\n")))
    return F.struct(own.alias("own"), head.alias("head"), F.concat(turn["text"], F.lit(END)).alias("body"))


def _masks(segments: Column) -> Column:
    """(start, end) code points of what is trained on: the body of the participant's own turns."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def add(acc: Column, s: Column) -> Column:
        begin = acc["at"] + F.char_length(s["head"])
        end = begin + F.char_length(s["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(s["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(segments, start, add)["spans"]


def perspectives(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, speaker, part, n_turns, n_own, text, masks: every dialogue as each participant sees it.

    The participants of a dialogue are the distinct values of ``role`` in it. For each of them its
    turns are rendered with role assistant and all others as users with their name (white space in
    a name becomes an underscore). ``masks`` holds the code-point spans of ``text`` to train on: the
    text and end mark of the participant's own turns. Turns are ordered by turn number, then role,
    then text; nulls come first. Rows that are equal in all four columns count once. A null role is
    the participant '', a null text is empty, rows without conv_id belong to no dialogue and are left
    out, and an empty table gives an empty result. Other columns are not read.

    A row of the result holds at most ``part_turns`` turns; the parts of a dialogue in order make
    the whole, and a participant gets each part, also those where it is silent. Turns are numbered
    by a range sort of all rows, so a dialogue with any share of them is never in one task.
    """
    turns = conversations.where("conv_id is not null").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    placed = durable(global_row_number(turns, [F.col(c) for c in ("conv_id", "turn", "speaker", "text")], "place", small=0))
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    parts = (
        placed.join(first, "conv_id").withColumn("part", F.floor((F.col("place") - F.col("first")) / part_turns).cast("int"))
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("place", "speaker", "text"))).alias("turns"))
    )
    speakers = placed.select("conv_id", "speaker").distinct()
    seen = parts.join(speakers, "conv_id")
    segments = seen.withColumn("segments", F.transform("turns", lambda t: _segment(t, F.col("speaker"))))
    text = F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "")
    own = F.size(F.filter("segments", lambda s: s["own"]))
    return segments.select(
        "conv_id", "speaker", "part", F.size("segments").cast("long").alias("n_turns"), own.cast("long").alias("n_own"),
        text.alias("text"), _masks(F.col("segments")).alias("masks"),
    )
