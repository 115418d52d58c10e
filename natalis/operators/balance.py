"""Covariate balance before and after matching or weighting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.functions.columns import ratio
from natalis.operators.ordering import RANGE, quantile_edges, running_totals, with_range


def _moments(df: DataFrame, treated: str, covariates: Sequence[str], weight: str | None) -> DataFrame:
    """Long table (covariate, m1, m0, v1, v0, binary) from one aggregate over all covariates.

    The variance of a 0/1 covariate is p(1 - p); otherwise it is the sample variance, in the weighted
    case with the reliability-weight correction.
    """
    w = f"CAST(`{weight}` AS DOUBLE)" if weight else "1.0D"
    names = ["other"] + [f"{kind}{g}" for g in (0, 1) for kind in ("w", "ww", "wx", "wxx", "vp")]
    sums = []
    for i, c in enumerate(covariates):
        x = f"CAST(`{c}` AS DOUBLE)"
        texts = [f"CAST(count_if({x} NOT IN (0.0D, 1.0D)) AS DOUBLE)"]
        for g in (0, 1):
            here = f"FILTER (WHERE `{treated}` = {g} AND {x} IS NOT NULL)"
            texts += [
                f"sum({w}) {here}",
                f"sum({w} * {w}) {here}",
                f"sum({w} * {x}) {here}",
                f"sum({w} * {x} * {x}) {here}",
                f"var_pop({x}) {here}",
            ]
        sums += [F.expr(f"{text} AS {name}_{i}") for name, text in zip(names, texts)]
    entries = ", ".join(
        f"named_struct('covariate', '{c}', " + ", ".join(f"'{n}', {n}_{i}" for n in names) + ")"
        for i, c in enumerate(covariates)
    )
    long = df.agg(*sums).selectExpr(f"inline(array({entries}))")
    out = [F.col("covariate"), (F.col("other") == 0).alias("binary")]
    for g in (0, 1):
        total = F.col(f"w{g}")
        mean = ratio(F.col(f"wx{g}"), total)
        spread = F.greatest(ratio(F.col(f"wxx{g}"), total) - mean * mean, F.lit(0.0)) if weight else F.col(f"vp{g}")
        correction = F.lit(1.0) - ratio(F.col(f"ww{g}"), total * total)
        variance = F.when(F.col("other") == 0, mean * (1 - mean)).otherwise(ratio(spread, correction))
        out += [mean.alias(f"m{g}"), variance.alias(f"v{g}")]
    return long.select(*out)


def balance_table(
    before: DataFrame,
    after: DataFrame,
    treated: str,
    covariates: Sequence[str],
    weight: str | None = None,
    threshold: float = 0.1,
) -> DataFrame:
    """Means and standardised mean differences per covariate and stage.

    Both stages divide by the treated group's deviation before adjustment, so that a change is a change
    of the means. ``ok`` marks an absolute difference below the threshold.
    """
    raw = _moments(before, treated, covariates, None)
    scale = raw.select("covariate", F.sqrt("v1").alias("_sd"))
    stages = raw.withColumn("stage", F.lit("before")).unionByName(
        _moments(after, treated, covariates, weight).withColumn("stage", F.lit("after"))
    )
    smd = ratio(F.col("m1") - F.col("m0"), F.col("_sd"))
    return stages.join(scale, "covariate").select(
        "covariate",
        "stage",
        F.col("m1").alias("mean_treated"),
        F.col("m0").alias("mean_control"),
        smd.alias("smd"),
        F.abs(smd).alias("abs_smd"),
        F.when(F.col("binary"), None).otherwise(ratio(F.col("v1"), F.col("v0"))).alias("variance_ratio"),
        (F.abs(smd) < threshold).alias("ok"),
    )


def ecdf_distances(df: DataFrame, treated: str, covariates: Sequence[str]) -> DataFrame:
    """Mean and largest distance of the two groups' distribution functions over the distinct values."""
    edges = quantile_edges(df, covariates)
    ranged = df.select(treated, *covariates)
    for i, c in enumerate(covariates):
        ranged = with_range(ranged, c, edges[c], out=f"_r{i}")
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("covariate"), F.col(c).cast("double").alias("value"), F.col(f"_r{i}").alias(RANGE))
            for i, c in enumerate(covariates)
        ]
    )
    long = ranged.select(treated, F.explode(cells).alias("c")).select(treated, "c.*")
    counts = long.filter(F.col("value").isNotNull()).groupBy("covariate", "value", RANGE).agg(
        F.count_if(F.col(treated) == 1).alias("n1"), F.count_if(F.col(treated) == 0).alias("n0")
    )
    totals = counts.groupBy("covariate").agg(
        F.sum("n1").alias("all1"), F.sum("n0").alias("all0"), F.count("*").alias("n_values")
    )
    ranked = running_totals(counts, "value", {"b1": "n1", "b0": "n0"}, by=["covariate"])
    gap = F.abs(
        ratio(F.col("b1") + F.col("n1"), F.col("all1")) - ratio(F.col("b0") + F.col("n0"), F.col("all0"))
    )
    table = ranked.join(totals, "covariate").groupBy("covariate", "n_values").agg(
        F.max(gap).alias("ecdf_max"), F.avg(gap).alias("_mean")
    )
    two = F.col("n_values") <= 2
    return table.select(
        "covariate", F.when(two, F.col("ecdf_max")).otherwise(F.col("_mean")).alias("ecdf_mean"), "ecdf_max"
    )


def match_summary(before: DataFrame, after: DataFrame, treated: str, covariates: Sequence[str]) -> DataFrame:
    """Balance table extended by distribution-function distances."""
    table = balance_table(before, after, treated, covariates)
    distances = ecdf_distances(before, treated, covariates).withColumn("stage", F.lit("before")).unionByName(
        ecdf_distances(after, treated, covariates).withColumn("stage", F.lit("after"))
    )
    return table.join(distances, ["covariate", "stage"])


def sample_sizes(before: DataFrame, after: DataFrame, treated: str) -> DataFrame:
    """Units per group: all, matched, unmatched."""

    def sizes(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(
            F.count_if(F.col(treated) == 1).alias("treated"), F.count_if(F.col(treated) == 0).alias("control")
        ).withColumn("stage", F.lit(stage))

    both = sizes(before, "all").unionByName(sizes(after, "matched"))
    signed = F.when(F.col("stage") == "all", 1).otherwise(-1)
    rest = both.agg(
        F.sum(F.col("treated") * signed).alias("treated"), F.sum(F.col("control") * signed).alias("control")
    ).withColumn("stage", F.lit("unmatched"))
    return both.unionByName(rest).select("stage", "treated", "control")
