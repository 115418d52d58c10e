"""Classical tests. Each is one or two Spark aggregates; the result is a table of one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.functions.columns import p_label, ratio
from natalis.functions.tails import p_chi2, p_normal, p_rank_sum, p_t, p_t_greater, q_t
from natalis.operators.describe import describe_by_group, distinct_levels
from natalis.operators.ordering import running_totals

_INF = float("inf")
EXACT_ROWS = 50  # fixed value: from so many rows on a group's rank sum is approximated


def _t_statistic(shift: float = 0.0):
    """(mean - shift) / (sd / sqrt(n)); infinite for zero spread, NULL when the mean is the shift too."""
    gap = F.col("mean") - F.lit(float(shift))
    regular = ratio(gap, F.col("sd") / F.sqrt(F.col("n")))
    return F.when(F.col("sd") > 0, regular).when(gap > 0, F.lit(_INF)).when(gap < 0, F.lit(-_INF))


def t_one_sample(df: DataFrame, column: str, mu: float, alternative: str = "greater") -> DataFrame:
    stats = df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"))
    tested = stats.withColumn("t", _t_statistic(mu)).withColumn("df", F.col("n") - 1)
    df_ = F.col("df").cast("double")
    if alternative == "two_sided":
        return tested.withColumn("p_value", p_t(F.col("t"), df_))
    sign = 1.0 if alternative == "greater" else -1.0
    return tested.withColumn("p_value", p_t_greater(F.col("t") * sign, df_))


def t_paired(df: DataFrame, after: str, before: str, level: float = 0.95) -> DataFrame:
    """Two-sided paired t-test on complete pairs, with the confidence interval of the mean difference."""
    gap = F.col(after).cast("double") - F.col(before).cast("double")
    stats = df.agg(F.count(gap).alias("n"), F.avg(gap).alias("mean"), F.stddev_samp(gap).alias("sd"))
    return add_paired_test(stats, level)


def add_paired_test(stats: DataFrame, level: float = 0.95) -> DataFrame:
    """Test columns for a row with the ``n``, ``mean`` and ``sd`` of the differences."""
    tested = stats.withColumn("t", _t_statistic()).withColumn("df", F.col("n") - 1)
    df_ = F.col("df").cast("double")
    half = q_t(F.lit(0.5 + level / 2.0), df_) * F.col("sd") / F.sqrt(F.col("n"))
    tested = tested.withColumns({"p_value": p_t(F.col("t"), df_), "_half": half})
    return tested.withColumns({"ci_low": F.col("mean") - F.col("_half"), "ci_high": F.col("mean") + F.col("_half")}).drop(
        "_half"
    )


def t_welch(df: DataFrame, group: str, value: str, first: str, second: str) -> DataFrame:
    """Two-sample t-test with unequal variances between two levels of a group column."""
    sums = []
    for tag, level in (("1", first), ("2", second)):
        picked = F.when(F.col(group) == level, F.col(value))
        sums += [
            F.count(picked).alias(f"n{tag}"),
            F.avg(picked).alias(f"mean{tag}"),
            F.var_samp(picked).alias(f"var{tag}"),
        ]
    stats = df.filter(F.col(group).isin(first, second)).agg(*sums)
    e1, e2 = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    tested = stats.withColumns(
        {
            "t": ratio(F.col("mean1") - F.col("mean2"), F.sqrt(e1 + e2)),
            "df": ratio((e1 + e2) * (e1 + e2), e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1)),
        }
    )
    return tested.withColumn("p_value", p_t(F.col("t"), F.col("df")))


def age_report(df: DataFrame, first: str, second: str, group: str = "race_ethnicity", value: str = "age"):
    """Levels, grouped description and Welch test, as three tables."""
    return distinct_levels(df, [group]), describe_by_group(df, group, value), t_welch(df, group, value, first, second)


def chi_square_fit(
    df: DataFrame, column: str, probabilities: Mapping | None = None, keep_null: bool = False
) -> DataFrame:
    """Goodness of fit of a column's level counts.

    Without ``probabilities`` the column must have exactly two levels and is held against 50/50: other
    level counts give no statistic but NULL. NULL values are left out unless asked for.
    """
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count("*").alias("o"))
    if probabilities is None:
        share = F.lit(0.5)
    else:
        share = F.coalesce(*[F.when(F.col(column) == k, F.lit(float(v))) for k, v in probabilities.items()], F.lit(0.0))
    terms = counts.withColumn("p", share)
    table = terms.agg(
        F.sum("o").alias("n"),
        F.count("*").alias("k"),
        F.sum(ratio(F.col("o") * F.col("o"), F.col("p"))).alias("_q"),
        F.count_if(F.col("p") <= 0).alias("_unexpected"),
    )
    levels = F.lit(2 if probabilities is None else len(probabilities))
    usable = F.col("_unexpected") == 0
    if probabilities is None:
        usable = usable & (F.col("k") == levels)
    # sum (o - np)^2 / (np) = sum o^2 / (np) - n, which also covers levels nobody has
    statistic = F.when(usable, ratio(F.col("_q"), F.col("n")) - F.col("n"))
    tested = table.select(
        "n", F.col("k").alias("levels"), statistic.alias("chi_square"), (levels - 1).cast("int").alias("df")
    )
    return tested.withColumn("p_value", p_chi2(F.col("chi_square"), F.col("df").cast("double")))


def rank_sum(df: DataFrame, value: str, group: str, edges: Sequence[float] | None = None) -> DataFrame:
    """Wilcoxon rank-sum test of ``value ~ group`` for a 0/1 group: W of group 0 and mid-ranks.

    The p-value is exact where no value occurs twice and both groups have fewer than 50 rows; otherwise it is that of
    the normal approximation with tie and continuity correction, whose z is given in either case.

    Ranks are taken over distinct values with counts, and their running totals are range-wise, so neither
    many equal values nor many different ones end in one task.
    """
    rows = df.filter(F.col(value).isNotNull() & F.col(group).isin(0, 1))
    counts = rows.groupBy(F.col(value).cast("double").alias("v")).agg(
        F.count_if(F.col(group) == 0).alias("c0"), F.count("*").alias("c")
    )
    ranked = running_totals(counts, "v", {"below": "c"}, edges=edges)
    c = F.col("c").cast("double")
    mid = F.col("below") + (c + 1) / 2
    sums = ranked.agg(
        F.sum("c0").alias("n0"),
        F.sum(F.col("c") - F.col("c0")).alias("n1"),
        F.sum(mid * F.col("c0")).alias("r0"),
        F.sum(c * c * c - c).alias("ties"),
    )
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    n = n0 + n1
    scored = sums.select("n0", "n1", (F.col("r0") - n0 * (n0 + 1) / 2).alias("w"), "ties")
    gap = F.col("w") - n0 * n1 / 2
    sigma = F.sqrt(n0 * n1 / 12 * (n + 1 - ratio(F.col("ties"), n * (n - 1))))
    scored = scored.withColumn("z", ratio(gap - F.signum(gap) * 0.5, sigma))
    few = (F.col("ties") == 0) & (F.col("n0") < EXACT_ROWS) & (F.col("n1") < EXACT_ROWS) & (F.least("n0", "n1") > 0)
    counted = p_rank_sum(*[F.when(few, F.col(c)).otherwise(F.lit(0)).cast("double") for c in ("w", "n0", "n1")])
    return scored.withColumn("p_value", F.when(few, counted).otherwise(p_normal(F.col("z")))).drop("ties")


def wald_table(coefficients: DataFrame) -> DataFrame:
    """Odds ratio, 95 % interval, z and p for rows (term, estimate, std_error)."""
    est, se = F.col("estimate"), F.col("std_error")
    z = ratio(est, se)
    table = coefficients.select(
        "term",
        F.exp(est).alias("odds_ratio"),
        F.exp(est - 1.96 * se).alias("ci_low"),
        F.exp(est + 1.96 * se).alias("ci_high"),
        "estimate",
        "std_error",
        z.alias("z"),
    )
    return table.withColumn("p_value", p_normal(F.col("z")))


def effect_sizes(spark, log_odds: Mapping[str, Sequence[float]]) -> DataFrame:
    """Odds ratio and Cohen's d = ln(OR) / 1.81 for the log-odds of models 1, 2 and so on of each outcome."""
    rows = [(dv, f"Model {i + 1}", float(e)) for dv, values in log_odds.items() for i, e in enumerate(values)]
    return add_effect_size(spark.createDataFrame(rows, "dv string, model string, estimate double"))


def add_effect_size(estimates: DataFrame) -> DataFrame:
    est = F.col("estimate")
    return estimates.withColumns({"odds_ratio": F.exp(est), "cohen_d": F.round(est / 1.81, 3)})


def likelihood_ratio(fits: DataFrame) -> DataFrame:
    """Rows (dv_label, loglik_reduced, loglik_full, df_diff) with the chi-square comparison added."""
    chi = F.greatest(2 * (F.col("loglik_full") - F.col("loglik_reduced")), F.lit(0.0))
    tested = fits.withColumn("_chi", chi).withColumn("p_val", p_chi2(F.col("_chi"), F.col("df_diff").cast("double")))
    return tested.select(
        "dv_label",
        F.round("_chi", 2).alias("chi_sq"),
        "df_diff",
        "p_val",
        p_label(F.col("p_val")).alias("p_val_str"),
    )
