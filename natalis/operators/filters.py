"""Row filters of the cohort and the single-pass flow report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.functions.columns import is_one
from natalis.plans.clinical import COMMON_RACES, EVENTS, EventColumns


def any_event(df: DataFrame, ev: EventColumns = EVENTS) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [is_one(c) for c in ev.any_flags]))


def in_cohort(df: DataFrame, ev: EventColumns = EVENTS) -> DataFrame:
    return df.filter(is_one(ev.cohort_flag))


def cohort_days(df: DataFrame, ev: EventColumns = EVENTS) -> DataFrame:
    """``in_cohort(any_event(df))``, without the OR where the cohort flag implies it.

    Left to the optimizer, the OR stays in the pushed filters and its columns in the scan.
    """
    return in_cohort(df if ev.cohort_flag in ev.any_flags else any_event(df, ev), ev)


def index_rows(df: DataFrame, ev: EventColumns = EVENTS) -> DataFrame:
    return df.filter(is_one(ev.index_flag))


def adult_female(df: DataFrame, min_age: int = 18, sex: str = "FEMALE") -> DataFrame:
    return df.filter((F.col("age") >= min_age) & (F.col("sex") == sex))


def age_band(df: DataFrame, low: int = 18, high: int = 50) -> DataFrame:
    return df.filter(F.col("age").between(low, high))


def age_known(df: DataFrame, min_age: int = 1) -> DataFrame:
    return df.where(F.col("age") >= min_age)


def known_sex(df: DataFrame, levels: Sequence[str] = ("MALE", "FEMALE")) -> DataFrame:
    return df.filter(F.col("sex").isin(*levels))


def common_race(df: DataFrame, levels: Sequence[str] = COMMON_RACES) -> DataFrame:
    return df.filter(F.col("race").isin(*levels))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL (or NaN) in the columns.

    One conjunct per column: a single predicate over many computed columns, as ``dropna`` makes it, grows
    exponentially when the optimizer rewrites it through their aliases.
    """
    kinds = dict(df.dtypes)
    tests = [f"`{c}` IS NOT NULL" for c in columns]
    tests += [f"NOT isnan(`{c}`)" for c in columns if kinds[c] in ("double", "float")]
    return df.filter(" AND ".join(tests)) if tests else df


def visits_between(
    df: DataFrame, at_least: int | None = None, below: int | None = None, column: str = "total_visits"
) -> DataFrame:
    if at_least is not None:
        df = df.filter(F.col(column) >= at_least)
    if below is not None:
        df = df.filter(F.col(column) < below)
    return df


def flow_report(df: DataFrame, steps: Mapping[str, Column], key: str = "person_id") -> DataFrame:
    """Rows and persons left after each of the cumulative ``steps``, from one scan.

    The first grouping combines map-side to one row per person and partition, so a person with a large
    share of the rows costs no more than any other; no ``count(distinct)`` expansion is needed.
    """
    names = list(steps)
    passed, per_person = None, []
    for name in names:
        passed = steps[name] if passed is None else passed & steps[name]
        per_person.append(F.count_if(passed).alias(name))
    people = df.groupBy(key).agg(*per_person)
    totals = people.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i + 1).alias("step_no"),
                    F.lit(name).alias("step"),
                    F.coalesce(F.sum(name), F.lit(0)).alias("n_rows"),
                    F.count_if((F.col(name) > 0) & F.col(key).isNotNull()).alias("n_persons"),
                )
                for i, name in enumerate(names)
            ]
        ).alias("steps")
    )
    return totals.select(F.explode("steps").alias("s")).select("s.*")
