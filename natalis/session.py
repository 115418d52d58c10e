"""Session settings for local runs. On a cluster the session comes from the caller."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str | None = None, app: str = "natalis") -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or "8"
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
