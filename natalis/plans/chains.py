"""The three end-to-end chains: cohort, classification/fairness, inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.functions.columns import flag
from natalis.operators import cohort, features
from natalis.operators.flags import column_range
from natalis.plans import clinical as cl


def conditions_of(facts: DataFrame) -> list[str]:
    return column_range(facts.columns, cl.FIRST_CONDITION, cl.LAST_CONDITION)


def summary(facts: DataFrame, people: DataFrame, deaths: DataFrame, unique_days: bool = False) -> DataFrame:
    """Person-days to one row per adult woman with an index event."""
    return cohort.patient_summary(facts, people, deaths, conditions_of(facts), unique_days=unique_days)


def incidence_by(history: DataFrame, outcome: str, group: str) -> DataFrame:
    """Persons, persons at risk and share with a first-time outcome, per group."""
    return history.groupBy(group).agg(
        F.count("*").alias("n_persons"), F.count(outcome).alias("n_at_risk"), F.avg(outcome).alias("share")
    )


def model_table(patients: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Outcomes, exposure, covariates and cluster of the inference chain, one row per person."""
    combined = features.combine_indicators(patients, cl.COMBINED)
    columns = [c for c in cl.FULL_TERMS if c not in ("age", "race_White", "total_visits")]
    return combined.select(
        "person_id",
        cl.CLUSTER,
        "age",
        "total_visits",
        flag(F.col("race") == "White").alias("race_White"),
        F.col(cl.HISTORY_COLUMNS["postpartum_depression"]).alias("postpartum_depression"),
        F.col(cl.HISTORY_COLUMNS["postpartum_csection"]).alias("postpartum_csection"),
        cl.PRE_ECLAMPSIA,
        *columns,
        *keep,
    )
