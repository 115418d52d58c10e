"""Group-wise rates, ratios and gaps of a binary prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.functions.columns import group_label, ratio
from natalis.operators.metrics import cell_counts

RATES = ("acc", "tpr", "fpr", "fnr", "ppp")
SEX, RACE = "sex_privilege", "race_privilege"


def rate_columns() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return {
        "acc": ratio(tp + tn, n),
        "tpr": ratio(tp, tp + fn),
        "fpr": ratio(fp, fp + tn),
        "fnr": ratio(fn, tp + fn),
        "ppp": ratio(tp + fp, n),
    }


def group_rates(df: DataFrame, group: str | Sequence[str], y: str = "y", pred: str = "y_pred") -> DataFrame:
    """Accuracy, TPR, FPR, FNR and share of positive predictions per group."""
    by = [group] if isinstance(group, str) else list(group)
    cells = cell_counts(df, y, pred, by)
    return cells.select(*by, (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n"), *_named(rate_columns()))


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def privilege_ratio(df: DataFrame, group: str, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """Rates of the unprivileged (0) over those of the privileged group (1), as one row."""
    rates = group_rates(df, group, y, pred)
    picked = rates.agg(
        *[F.max(F.when(F.col(group) == level, F.col(r))).alias(f"{r}{level}") for r in RATES for level in (0, 1)]
    )
    return picked.select(*[ratio(F.col(f"{r}0"), F.col(f"{r}1")).alias(f"{r}_ratio") for r in RATES])


def intersection_rates(df: DataFrame, y: str = "y", pred: str = "y_pred", sex: str = SEX, race: str = RACE) -> DataFrame:
    rates = group_rates(df, [sex, race], y, pred)
    return rates.select(group_label(sex, race).alias("intersection_group"), "n", *RATES)


def fairness_overview(
    df: DataFrame, y: str = "y", pred: str = "y_pred", sex: str = SEX, race: str = RACE
) -> DataFrame:
    """Race, sex and intersection groups in one table from one scan.

    Grouping sets run over the four-row table of cell counts, not over the data, so rows are not
    multiplied by the number of groupings.
    """
    cells = cell_counts(df, y, pred, [sex, race])
    sets = [[F.col(race)], [F.col(sex)], [F.col(sex), F.col(race)]]
    rolled = cells.groupingSets(sets, F.col(sex), F.col(race)).agg(
        F.grouping(sex).alias("_all_sex"),
        F.grouping(race).alias("_all_race"),
        *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")],
    )
    race_name = F.when(F.col(race) == 1, "White").otherwise("Non-White")
    sex_name = F.when(F.col(sex) == 1, "Male").otherwise("Female")
    family = F.when(F.col("_all_sex") == 1, "race").when(F.col("_all_race") == 1, "sex").otherwise("intersection")
    name = F.when(F.col("_all_sex") == 1, race_name).when(F.col("_all_race") == 1, sex_name).otherwise(
        group_label(sex, race)
    )
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return rolled.select(family.alias("family"), name.alias("group_name"), n.alias("n"), *_named(rate_columns()))


def _gap(rate: str) -> Column:
    return F.max(rate) - F.min(rate)


def demographic_parity_difference(
    df: DataFrame, group: str | Sequence[str], y: str = "y", pred: str = "y_pred"
) -> DataFrame:
    return group_rates(df, group, y, pred).agg(_gap("ppp").alias("demographic_parity_difference"))


def equalized_odds_difference(
    df: DataFrame, group: str | Sequence[str], y: str = "y", pred: str = "y_pred"
) -> DataFrame:
    return group_rates(df, group, y, pred).agg(
        F.greatest(_gap("tpr"), _gap("fpr")).alias("equalized_odds_difference")
    )


def before_after(
    df: DataFrame, group: str, y: str = "y", before: str = "y_pred", after: str = "y_pred_post"
) -> DataFrame:
    """Rates and gaps of two prediction columns side by side, from one scan over both."""
    both = df.select(
        group, y, F.explode(F.array(
            F.struct(F.lit("before").alias("stage"), F.col(before).cast("int").alias("_pred")),
            F.struct(F.lit("after").alias("stage"), F.col(after).cast("int").alias("_pred")),
        )).alias("p")
    ).select(group, y, "p.*")
    cells = cell_counts(both, y, "_pred", ["stage", group]).withColumns(
        {k: v for k, v in rate_columns().items() if k in ("ppp", "tpr", "fpr")}
    )
    stages = cells.groupBy("stage").agg(
        *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")],
        _gap("ppp").alias("demographic_parity_difference"),
        F.greatest(_gap("tpr"), _gap("fpr")).alias("equalized_odds_difference"),
    )
    return stages.select(
        "stage", "tn", "fp", "fn", "tp", rate_columns()["acc"].alias("accuracy"),
        "demographic_parity_difference", "equalized_odds_difference",
    )
