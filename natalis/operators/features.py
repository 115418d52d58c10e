"""Recoding, encoding, scaling and feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StandardScaler, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.functions import columns as fx
from natalis.plans.clinical import FEATURE_COLUMNS, RACE_LEVELS, RACE_RECODE, SEX_LEVELS


def recode(df: DataFrame, column: str = "race", mapping: Mapping[str, str] = RACE_RECODE) -> DataFrame:
    return df.replace(dict(mapping), subset=[column])


def discover_levels(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> dict[str, list[str]]:
    """Levels of several columns from one job. If a ``limit`` is given, a column with more levels is an error."""
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])).alias(
            "p"
        )
    )
    distinct = pairs.select("p.*").dropna().distinct()
    found = distinct.collect() if limit is None else distinct.take(limit * len(columns) + 1)
    levels = {c: sorted(r["v"] for r in found if r["c"] == c) for c in columns}
    wide = [c for c, v in levels.items() if limit is not None and len(v) > limit]
    if wide or (limit is not None and len(found) > limit * len(columns)):
        raise ValueError(f"too many levels for one-hot encoding: {wide or list(columns)}")
    return levels


def one_hot(
    df: DataFrame, levels: Mapping[str, Sequence[str]], drop: Sequence[str] = (), reference: Sequence[str] = ()
) -> DataFrame:
    """Add a 0/1 column ``<column>_<level>`` per level; then drop columns and reference levels if present."""
    encoded = df.withColumns(
        {f"{c}_{level}": fx.flag(F.col(c) == level) for c, values in levels.items() for level in values}
    )
    return encoded.drop(*drop, *reference)


def encode_demographics(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    encode: Sequence[str] = ("sex", "race"),
    levels: Mapping[str, Sequence[str]] | None = None,
    drop_reference_level: bool = True,
) -> DataFrame:
    """Recode race, one-hot the ``encode`` columns, drop raw race and the ``Unknown`` reference level.

    Declared levels cost no job; with ``levels={}`` they are read from the data in one job.
    """
    picked = recode(df.select(*columns) if columns else df)
    if levels is None:
        levels = {"sex": SEX_LEVELS, "race": RACE_LEVELS}
    elif not levels:
        levels = discover_levels(picked, encode)
    reference = ["race_Unknown"] if drop_reference_level else []
    return one_hot(picked, {c: levels[c] for c in encode}, drop=["race"], reference=reference)


def sex_as_flag(df: DataFrame, level: str = "FEMALE") -> DataFrame:
    """``sex`` becomes 1 for ``level`` and NULL otherwise: an INT column, never a mix of types."""
    return df.withColumn("sex", F.when(F.col("sex") == level, 1))


def combine_indicators(df: DataFrame, combined: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({new: fx.any_of(parts) for new, parts in combined.items()})


def privilege_flags(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Group flags for fairness work (male = 1, White = 1) in place of the raw attributes."""
    picked = recode(df.select(*columns), mapping={"Black or African American": "Black_or_African_American"})
    return picked.withColumns(
        {
            "sex_privilege": fx.flag(F.col("sex") == "MALE"),
            "race_privilege": fx.flag(F.col("race") == "White"),
        }
    ).drop("sex", "race")


def zscore(
    df: DataFrame, columns: Sequence[str] = ("age",), ddof: int = 1, replace: bool = False, prefix: str = "scaled_"
) -> DataFrame:
    """Standardised copies of columns (or the columns themselves with ``replace``).

    Mean and deviation of all columns come from one aggregate of a single row, which goes into the
    projection as constants. A constant column scales to 0, as both scalers of the ML libraries do.
    """
    sd = F.stddev_samp if ddof else F.stddev_pop
    stats = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[sd(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean, dev = stats[f"m{i}"], stats[f"s{i}"]
        centred = F.col(c).cast("double") - F.lit(mean).cast("double")
        scaled[c if replace else f"{prefix}{c}"] = centred / F.lit(float(dev)) if dev else centred * 0.0
    return df.withColumns(scaled)


def scaled_vector(
    df: DataFrame, columns: Sequence[str] = ("age",), threshold: float = 0.01, out: str = "features_selected"
) -> DataFrame:
    """Vector of standardised columns with the low-variance ones removed, by the MLlib estimators."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="skip").transform(df)
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(assembled)
    scaled = scaler.transform(assembled)
    selector = VarianceThresholdSelector(varianceThreshold=threshold, featuresCol="_scaled", outputCol=out)
    return selector.fit(scaled).transform(scaled).select(out)


def vector_element(df: DataFrame, vector: str, out: str, index: int = 0) -> DataFrame:
    return df.withColumn(out, vector_to_array(vector)[index])


def variances(df: DataFrame, columns: Sequence[str], ddof: int = 0) -> DataFrame:
    """Long table (feature, variance) from one aggregate over all columns."""
    var = "var_samp" if ddof else "var_pop"
    wide = df.agg(*[F.expr(f"{var}(`{c}`) AS `{c}`") for c in columns])
    return wide.unpivot([], list(columns), "feature", "variance")


def drop_quasi_constant(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = 0.01,
    ddof: int = 0,
    protect: Sequence[str] = (),
) -> DataFrame:
    """Drop columns whose variance does not exceed the threshold (0 removes constants only)."""
    names = [c for c in (columns or df.columns) if c not in protect]
    low = [r["feature"] for r in variances(df, names, ddof).collect() if r["variance"] is None or r["variance"] <= threshold]
    return df.drop(*low)


def scale_and_select(
    df: DataFrame, continuous: Sequence[str] = ("age",), threshold: float = 0.01, protect: Sequence[str] = ()
) -> DataFrame:
    """Population z-score in place, then the quasi-constant filter over every column."""
    return drop_quasi_constant(
        zscore(df, continuous, ddof=0, replace=True), threshold=threshold, protect=protect
    )


def age_bins(df: DataFrame, edges: Sequence[float], column: str = "age", out: str = "age_bin") -> DataFrame:
    """Number of the half-open bin [edge, next edge); 0 below the first edge, NULL for a NULL age."""
    total = F.lit(0)
    for edge in edges:
        total = total + F.when(F.col(column) >= edge, 1).otherwise(0)
    return df.withColumn(out, F.when(F.col(column).isNotNull(), total))
