"""Multi-party dialogues, rendered once per participant with that speaker as the assistant.

For each participant of a conversation the same turns are written anew: the participant's own turns as the
assistant's, everyone else's as those of a user with a name, instructions as system turns. The mask covers what
the assistant says, with the mark that ends its turn. One row per conversation, participant and turn carries the
rendered segment and where it and its mask lie in the whole rendered dialogue.

A conversation may be any share of the table. Rows are cut into ranges of the order (conversation, participant,
turn), running lengths are taken inside a range only, and the totals of earlier ranges are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natalis.llm.shared import saved

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
NARRATORS = ("system",)
UNKNOWN = "unknown"


def _plain(text: Column) -> Column:
    """The text with marks of the format broken up, so that no turn can end early."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("< |im_"))


def _name(role: Column) -> Column:
    """A speaker's name on one line: blanks become underscores; a NULL or blank role is one unknown speaker."""
    name = F.regexp_replace(F.trim(F.coalesce(role, F.lit(""))), r"\s+", "_")
    return F.when(name == "", F.lit(UNKNOWN)).otherwise(_plain(name))


def perspectives(
    turns: DataFrame,
    conversation_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    narrators: Sequence[str] = NARRATORS,
) -> DataFrame:
    """(conversation, perspective, position, turn, role, name, segment, start, stop, mask_start, mask_stop).

    Turns are ordered by number (NULL first), then speaker, then a digest of the text; repeated rows are turns
    of their own. Narrators are no participants; a conversation of narrators only has no rows. NULL texts are empty
    turns, and rows with a NULL conversation form one conversation. Positions and places count from 0, places in
    code points; the mask is NULL where the assistant does not speak.
    """
    spark = turns.sparkSession
    rows = turns.select(
        F.col(conversation_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        _name(F.col(role_col).cast("string")).alias("_speaker"),
        _plain(F.col(text_col).cast("string")).alias("_text"),
    ).withColumn("_order", F.md5(F.col("_text").cast("binary")))
    people = rows.filter(~F.col("_speaker").isin(*narrators)).select(F.col("_conv").alias("_of"), F.col("_speaker").alias("_self"))
    views = rows.join(people.distinct(), F.col("_conv").eqNullSafe(F.col("_of"))).drop("_of")
    own = F.col("_speaker") == F.col("_self")
    told = F.col("_speaker").isin(*narrators)
    role = F.when(own, F.lit("assistant")).when(told, F.col("_speaker")).otherwise(F.lit("user"))
    name = F.when(~own & ~told, F.col("_speaker"))
    head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    views = views.withColumns({"_role": role, "_name": name, "_head": F.length(head), "segment": F.concat(head, "_text", F.lit(CLOSE + "\n"))})
    key, order = ["_conv", "_self"], ["_turn", "_speaker", "_order"]
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = saved(views.repartitionByRange(parts, *key, *order).withColumn("_range", F.spark_partition_id()), "views")
    inside = Window.partitionBy("_range", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("segment").cast("long")
    totals = ranged.groupBy("_range", *key).agg(F.sum(size).alias("_size"), F.count("*").alias("_rows"))
    offsets = totals.select(
        F.col("_range").alias("_r"),
        F.col("_conv").alias("_c"),
        F.col("_self").alias("_s"),
        F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_size_ahead"),
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_rows_ahead"),
    )
    local = ranged.withColumns(
        {"_size_in": F.coalesce(F.sum(size).over(inside), F.lit(0)), "_rows_in": F.count("*").over(inside)}
    )
    same = (F.col("_range") == F.col("_r")) & F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_self") == F.col("_s"))
    start = F.col("_size_ahead") + F.col("_size_in")
    spoken = F.col("_role") == "assistant"
    return local.join(offsets, same).select(
        F.col("_conv").alias(conversation_col),
        F.col("_self").alias("perspective"),
        (F.col("_rows_ahead") + F.col("_rows_in")).alias("position"),
        F.col("_turn").alias("turn"),
        F.col("_role").alias("role"),
        F.col("_name").alias("name"),
        "segment",
        start.alias("start"),
        (start + size).alias("stop"),
        F.when(spoken, start + F.col("_head")).alias("mask_start"),
        F.when(spoken, start + size - 1).alias("mask_stop"),
    )
