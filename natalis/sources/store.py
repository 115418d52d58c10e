"""Parquet tables in and out, and the one place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, f"{name}.parquet"))


def read_node(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_node(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Persist a step's result as a Parquet dataset and return its path.

    With ``partition_by`` the writer keeps the incoming distribution: a hot partition value is written
    by every task that holds some of it, so it is never gathered into one.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, set as the checkpoint folder if none is.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session without one gets a
    temporary folder; elsewhere such a folder would not be visible to all executors.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
        if not configured:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="natalis-checkpoint-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def fresh_node(spark: SparkSession, name: str) -> str:
    """Path of a new node in the shared folder; no two calls return the same."""
    return f"{checkpoint_folder(spark)}/node-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so that iterations do not recompute its inputs."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
