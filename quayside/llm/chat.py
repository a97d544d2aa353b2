"""Chat formatting by perspective rotation, with DataFrame functions only.

A dialogue is rendered once for each of its speakers: that speaker is the assistant, all others
are users with their names, and the mask covers what the assistant says.

Long dialogues are rendered in blocks of BLOCK turns; the blocks of a perspective, one after the
other, are the whole text. The place of a turn comes from a range partitioning by dialogue and turn, which
divides dialogues of any length, and from counts for each partition; no dialogue is gathered in one
task.

Repeated rows (equal dialogue, turn, role and text) are one turn; turns with the same number are ordered
by role and text. A null text is empty. A null role is a user without a name and has no
perspective. Rows without a dialogue form one dialogue; a null turn comes first. Markers inside
texts and names are broken up by a space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import stored

BEGIN, END = "<|im_start|>", "<|im_end|>"
BLOCK = 256


def _plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def placed_turns(turns: DataFrame) -> DataFrame:
    """Distinct turns (conv_id, role, text) with their place in the dialogue, from 0."""
    distinct = stored(
        turns.select(
            "conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string")
        ).distinct(),
        "turns",
    )
    keys = ("conv_id", "turn", "role", "text")
    spread = stored(
        distinct.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()),
        "spread",
    )
    counts = spread.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn(
        "before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    ).select(F.col("conv_id").alias("conv"), F.col("part").alias("in_part"), "before")
    within = Window.partitionBy("part", "conv_id").orderBy("at")
    return (
        spread.withColumn("row", F.row_number().over(within) - 1)
        .join(before, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("in_part")))
        .select("conv_id", "role", "text", (F.col("row") + F.col("before")).alias("place"))
    )


def rotate(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Perspectives of dialogues (conv_id, turn, role, text).

    Returns conv_id, participant, block, n_turns, n_targets (turns of the participant), text and
    mask, the spans of text to learn (array<struct<start, end>> in characters of this block).
    """
    placed = placed_turns(turns)
    blocks = stored(
        placed.withColumn("block", F.floor(F.col("place") / block))
        .groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns")),
        "blocks",
    )
    speakers = (
        turns.select(F.col("conv_id").alias("conv"), F.col("role").cast("string").alias("participant"))
        .filter("participant is not null")
        .distinct()
    )

    def segment(turn: Column) -> Column:
        own = turn["role"].eqNullSafe(F.col("participant"))
        name = F.when(turn["role"].isNull(), F.lit("")).otherwise(F.concat(F.lit(" name="), _plain(turn["role"])))
        head = F.when(own, F.lit(BEGIN + "assistant\n")).otherwise(
            F.concat(F.lit(BEGIN + "user"), name, F.lit("\n"))
        )
        return F.struct(
            head.alias("head"),
            F.concat(_plain(turn["text"]), F.lit(END)).alias("body"),
            own.alias("own"),
        )

    spans = F.aggregate(
        "segments",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + F.char_length(x["head"]) + F.char_length(x["body"]) + 1).alias("at"),
            F.when(
                x["own"],
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + F.char_length(x["head"])).alias("start"),
                            (s["at"] + F.char_length(x["head"]) + F.char_length(x["body"])).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return (
        blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv")))
        .withColumn("segments", F.transform("turns", segment))
        .withColumn("mask", spans)
        .select(
            "conv_id",
            "participant",
            "block",
            F.size("turns").cast("long").alias("n_turns"),
            F.size("mask").cast("long").alias("n_targets"),
            F.array_join(
                F.transform("segments", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), ""
            ).alias("text"),
            "mask",
        )
    )
