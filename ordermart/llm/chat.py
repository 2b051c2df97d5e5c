"""Chat formatting by multi-party perspective rotation (DataFrame functions only).

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant and all others as named users; the loss mask
covers the assistant's words and end marks. System turns belong to every
perspective as context and are nobody's perspective.

Cases. NULL speaker: a participant named ``unknown``. NULL text: an empty
turn. NULL conversation id: a conversation of its own. Order: turn, speaker,
text (NULL first); repeated rows are repeated turns. A conversation without
participants gives no row; an empty table gives an empty result. Extra columns
are not read. A conversation of more than ``part_turns`` turns is rendered in
consecutive parts, so that no task or row ever holds an unbounded conversation.
A part is rendered for those who speak in it: for others it would hold no word
of the loss. So the output grows with the turns, by ``part_turns`` at most,
and not with turns x participants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.plans.session import cut_lineage

#: Turns in a row of the result.
PART_TURNS = 256
SYSTEM = "system"
UNNAMED = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _numbered(long: DataFrame) -> DataFrame:
    """Turn numbers within long conversations without gathering one: the
    turns are range-partitioned in dialogue order, numbered in each piece,
    and shifted by what the pieces before it hold of the conversation."""
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(),
             F.col("who").asc_nulls_first(), F.col("said").asc_nulls_first()]
    pieces = cut_lineage(long.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()))
    counts = pieces.groupBy("conv", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("conv").alias("s_conv"), F.col("piece").alias("s_piece"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inner = Window.partitionBy("conv", "piece").orderBy(*order[1:])
    return (pieces.withColumn("rn", F.row_number().over(inner))
            .join(starts, F.col("conv").eqNullSafe(F.col("s_conv")) & (F.col("piece") == F.col("s_piece")))
            .withColumn("nr", F.col("rn") + F.col("start") - 1)
            .select("conv", "turn", "who", "said", "nr"))


def parts(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv, part, dialogue): up to ``part_turns`` turns in order."""
    counts = turns.groupBy(F.col("conv").alias("c_conv")).agg(F.count("*").alias("n_turns"))
    sized = turns.join(counts, F.col("conv").eqNullSafe(F.col("c_conv"))).drop("c_conv")
    short = sized.where(F.col("n_turns") <= part_turns).select("conv", F.lit(0).cast("long").alias("part"), "turn", "who", "said")
    long = _numbered(sized.where(F.col("n_turns") > part_turns)) \
        .select("conv", F.floor(F.col("nr") / part_turns).cast("long").alias("part"), "turn", "who", "said")
    return short.unionByName(long).groupBy("conv", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "who", "said"))).alias("dialogue"))


def _render(dialogue: Column, me: Column) -> Column:
    """Struct of the rendered text and its loss spans (start, end; code points)."""
    def turn(state: Column, t: Column) -> Column:
        head = F.concat(F.lit(OPEN), F.when(t["who"] == SYSTEM, F.lit("system"))
                        .when(t["who"] == me, F.lit("assistant"))
                        .otherwise(F.concat(F.lit("user name="), t["who"])), F.lit("\n"))
        body = F.concat(F.coalesce(t["said"], F.lit("")), F.lit(CLOSE))
        start = state["at"] + F.length(head)
        end = start + F.length(body)
        return F.struct(
            end.alias("at"),
            F.concat(state["pieces"], F.array(F.concat(head, body))).alias("pieces"),
            F.when((t["who"] == me) & (t["who"] != SYSTEM),
                   F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))))
            .otherwise(state["spans"]).alias("spans"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(dialogue, empty, turn, lambda s: F.struct(
        F.array_join(s["pieces"], "").alias("text"), s["spans"].alias("spans")))


def perspectives(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role",
                 text: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """(conversation, participant, part, n_turns, text, loss_spans), the first
    column under the input's name."""
    turns = conversations.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{speaker}`"), F.lit(UNNAMED)).alias("who"), F.col(f"`{text}`").alias("said"))
    speakers = F.array_sort(F.array_distinct(F.filter(F.transform("dialogue", lambda t: t["who"]), lambda w: w != SYSTEM)))
    return (parts(turns, part_turns).withColumn("participant", F.explode(speakers))
            .withColumn("r", _render(F.col("dialogue"), F.col("participant")))
            .select(F.col("conv").alias(conv), "participant", "part", F.size("dialogue").cast("long").alias("n_turns"),
                    F.col("r.text").alias("text"), F.col("r.spans").alias("loss_spans")))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), " ")


__all__ = ["perspectives", "parts", "spans_text"]
