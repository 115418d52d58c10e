"""The corpus pipeline: quality, line rules, near-duplicates, benchmark passages, packing.

Each stage reads what the stage before it kept, stored as Parquet in the shared folder, and hands on rows with all
columns of ``documents``; the last one returns the pieces of the packed sequences. A stage works on any table with
the columns doc_id and text: NULL, empty and blank texts fail the line rules at the latest, repeated rows are
decided alike, and an empty table passes through empty.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from natalis.llm import decontaminate, golay, line_rules, packing, quality
from natalis.llm.shared import saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts good."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def content_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, by the field that is fitted on labelled rows of the unfiltered table."""
    return line_rules.keep_content(docs, _table(spark, sf_dir, "labels"), examples=_table(spark, sf_dir, "documents"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return golay.one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontaminate.without_overlaps(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the training sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("rules", content_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: trained models, Golay keys and a tokenizer have no SQL form; tests hold each stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored before the next begins."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
