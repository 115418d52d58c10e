"""Running totals, ranks and row numbers without a single-task window.

Each helper cuts the order into ranges whose totals are small, adds up the ranges before each one, and
runs ordinary windows inside the ranges only. Range edges steer the balance, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"


def quantile_edges(df: DataFrame, columns: Sequence[str], parts: int | None = None) -> dict[str, list[float]]:
    """Inner range edges of each column, from one map-side quantile sketch over all of them."""
    parts = parts or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    wanted = [i / parts for i in range(1, parts)]
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), wanted, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: sorted(set(row[f"q{i}"] or [])) for i, c in enumerate(columns)}


def with_range(df: DataFrame, column: str, edges: Sequence[float], out: str = RANGE) -> DataFrame:
    """Number of the range that holds the value; NULL stays NULL."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *edges, float("inf")]
    value = f"{out}_value"
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=out, handleInvalid="keep")
    ranged = cut.transform(df.withColumn(value, F.col(column).cast("double"))).drop(value)
    return ranged.withColumn(out, F.col(out).cast("int"))


def running_totals(
    distinct: DataFrame,
    value: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Sum of each measure over strictly smaller values, per ``by`` group.

    ``distinct`` has one row per group and value. ``sums`` maps a new column to the measure it sums up.
    ``edges=None`` computes range edges first; a table that already has a ``_range`` column keeps it.
    """
    if RANGE not in distinct.columns:
        if edges is None:
            edges = quantile_edges(distinct, [value])[value]
        distinct = with_range(distinct, value, edges)
    by = list(by)
    group = by or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    range_totals = distinct.groupBy(*by, RANGE).agg(*[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    offsets = range_totals.select(
        *by, RANGE, *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_o_{new}") for new in sums]
    )
    inside = Window.partitionBy(*by, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, RANGE]
    condition = None
    for k in keys:
        test = F.col(f"d.{k}").eqNullSafe(F.col(f"o.{k}"))
        condition = test if condition is None else condition & test
    joined = distinct.alias("d").join(offsets.alias("o"), condition, "inner")
    joined = joined.select("d.*", *[f"o._o_{new}" for new in sums])
    return joined.withColumns(
        {new: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_o_{new}") for new, c in sums.items()}
    ).drop(RANGE, *[f"_o_{new}" for new in sums])


def number_rows(
    df: DataFrame, key: str, by: Sequence[str] = (), out: str = "row_no", buckets: int | None = None, seed: int = 42
) -> DataFrame:
    """Gap-free numbers from 0 per ``by`` group, in the order of the MD5 digest of ``key`` and ``seed``.

    Rows of a group are spread over buckets, which are runs of that order: a bucket's numbers start where the
    earlier buckets end. A heavy group is so numbered by ``buckets`` tasks, and the order does not depend on the
    data's layout. A NULL is a ``by`` value like any other.
    """
    by = list(by)
    buckets = buckets or max(256, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    head = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long")
    hashed = hashed.withColumn("_bucket", F.floor(head * buckets / F.lit(1 << 32)).cast("int"))
    counts = hashed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = (
        Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select(
        *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)],
        F.col("_bucket").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash", key)
    same = F.col("_bucket") == F.col("_of")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    return (
        hashed.join(starts, same, "inner")
        .withColumn(out, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_hash", "_bucket", "_start", "_of", *[f"_by{i}" for i in range(len(by))])
    )
