"""Descriptive tables: counts, levels, moments and exact quantiles per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.operators.ordering import running_totals
from natalis.sources.store import cut_lineage


def level_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per level, rarest first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy("n", column)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def distinct_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long table of the levels of several columns from one scan; map-side de-duplicated."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").distinct()


def three_statistics(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd")
    )


def describe_by_group(
    df: DataFrame, group: str, column: str, quantiles: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Count, mean, sd, min, exact interpolated quantiles and max per group.

    The scan only counts distinct values per group, and all else is taken from these counts. Quantiles are picked from running totals of those
    counts, so a group with a large share of the rows, or of distinct values, is not gathered.
    """
    value = F.col(column).cast("double")
    rows = df.filter(value.isNotNull())
    counts = cut_lineage(rows.groupBy(group, value.alias("_v")).agg(F.count("*").alias("_c")))
    base = counts.groupBy(group).agg(
        F.sum("_c").alias("count"),
        (F.sum(F.col("_v") * F.col("_c")) / F.sum("_c")).alias("mean"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    ranked = running_totals(counts, "_v", {"_below": "_c"}, by=[group])
    same_group = F.col(f"r.{group}").eqNullSafe(F.col(f"b.{group}"))
    placed = ranked.alias("r").join(base.alias("b"), same_group, "inner").select("b.*", "r._v", "r._c", "r._below")
    picks = []
    for i, q in enumerate(quantiles):
        position = (F.col("count") - 1) * F.lit(float(q))
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            holds = (F.col("_below") <= at) & (at < F.col("_below") + F.col("_c"))
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{side}{i}"))
    away = F.col("_v") - F.col("mean")
    spread = F.sum(F.col("_c") * away * away)
    std = F.when(F.col("count") > 1, F.sqrt(spread / (F.col("count") - 1))).alias("std")
    table = placed.groupBy(group, "count", "mean", "min", "max").agg(*picks, std)

    def interpolated(i: int, q: float) -> Column:
        position = (F.col("count") - 1) * F.lit(float(q))
        return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (position - F.floor(position))

    return table.select(
        group,
        "count",
        "mean",
        "std",
        "min",
        *[interpolated(i, q).alias(f"p{round(q * 100)}") for i, q in enumerate(quantiles)],
        "max",
    )
