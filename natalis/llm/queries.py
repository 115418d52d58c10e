"""One query per operator over the test tables; each takes (spark, folder) and returns the whole result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm import archives, collocations, decontaminate, golay, hilbert, line_rules, mixing, negatives, oracle, packing, perspectives, quality, substrings, wordpiece

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = oracle.TEXTS


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, f"{name}.parquet"))


@query
def op1_decontaminate(spark, base):
    return decontaminate.overlaps(table(spark, base, "documents"), table(spark, base, "benchmark"))


@query
def op2_quality(spark, base):
    return quality.scored(table(spark, base, "documents"), table(spark, base, "labels"))


@query
def op3_perspectives(spark, base):
    return perspectives.perspectives(table(spark, base, "conversations"))


@query
def op4_pack(spark, base):
    return packing.packed_documents(table(spark, base, "documents"))


@query
def op5_warc(spark, base):
    return archives.round_trip(table(spark, base, "pages"))


@query
def op6_line_rules(spark, base):
    return line_rules.judged(table(spark, base, "documents"), table(spark, base, "labels"))


@query
def op7_shards(spark, base):
    placed = hilbert.shards(table(spark, base, "documents"), ["lang", "source", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@query
def op8_token_counts(spark, base):
    return wordpiece.token_counts(table(spark, base, "documents"))


@query
def op9_lm_score(spark, base):
    return mixing.scored(table(spark, base, "documents"), learn=True)


@query
def op10_simhash(spark, base):
    found = golay.near_duplicates(table(spark, base, "documents"))
    return found.select("doc_id", golay.hex_fingerprint().alias("fingerprint"), "component_id")


@query
def op11_hard_negatives(spark, base):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, base, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op12_substrings(spark, base):
    return substrings.deduplicated(table(spark, base, "documents"))


@query
def op13_collocations(spark, base):
    return collocations.mined(table(spark, base, "documents"))
