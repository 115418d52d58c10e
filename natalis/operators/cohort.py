"""Index events and the roll-up from person-days to persons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natalis.functions.columns import is_one
from natalis.operators import filters
from natalis.operators.flags import dummy_name, window_tests
from natalis.plans.clinical import (
    BASE_COLUMNS,
    EVENTS,
    HISTORY_COLUMNS,
    INCIDENT_OUTCOMES,
    SUMMARY_COLUMNS,
    WINDOWS,
    EventColumns,
    LabelWindow,
)

_BITS = 62


def index_dates(df: DataFrame, ev: EventColumns = EVENTS) -> DataFrame:
    """First index date per person; the partial aggregate leaves one row per person and partition."""
    return filters.index_rows(df, ev).groupBy(ev.person).agg(F.min(ev.date).alias(ev.index_date))


def attach_index(days: DataFrame, index: DataFrame, ev: EventColumns = EVENTS, spread: int = 8) -> DataFrame:
    """All day rows of persons that have an index date.

    The join key carries a salt taken from the date, and each index row is repeated once per salt. The
    rows of one heavy person thus land in ``spread`` partitions, and as the result is not partitioned by
    person alone, a later group-by on the person pre-aggregates before its own exchange and adaptive
    skew splitting stays possible. Small index tables are broadcast by Spark's own size estimate.
    """
    salt = F.pmod(F.xxhash64(F.col(ev.date)), F.lit(spread)).cast("int")
    salted_index = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    rest = [c for c in days.columns if c != ev.person]
    return (
        days.withColumn("_salt", salt)
        .join(salted_index, [ev.person, "_salt"], "inner")
        .select(ev.person, ev.index_date, *rest)
    )


def index_cohort(facts: DataFrame, ev: EventColumns = EVENTS) -> DataFrame:
    """Cohort rows of persons with an index event, each with the person's first index date."""
    days = filters.cohort_days(facts, ev)
    return attach_index(days, index_dates(days, ev), ev)


def indicator_name(condition: str, window: LabelWindow, label: str) -> str:
    return f"{condition}_{window.tag}_{label}_indicator"


def _extra_aggregates(columns: Sequence[str]) -> list[Column]:
    extra = []
    if "BMI_rounded" in columns:
        extra.append(F.max("BMI_rounded").alias("BMI_max_observed_or_calculated"))
    if "had_vaccine_administered" in columns:
        extra.append(F.sum("had_vaccine_administered").alias("total_number_of_COVID_vaccine_doses"))
    return extra


def indicator_rollup(
    flagged: DataFrame, conditions: Sequence[str], windows: Sequence[LabelWindow] = WINDOWS, ev: EventColumns = EVENTS
) -> DataFrame:
    """Ever/never indicator per person from the row-level dummies, plus BMI and dose count if present."""
    maxima = [
        F.expr(f"max(`{dummy_name(c, w, label)}`) AS `{indicator_name(c, w, label)}`")
        for c in conditions
        for w in windows
        for label in w.labels
    ]
    return flagged.groupBy(ev.person).agg(*maxima, *_extra_aggregates(flagged.columns))


def fused_rollup(
    facts: DataFrame,
    conditions: Sequence[str],
    windows: Sequence[LabelWindow] = WINDOWS,
    ev: EventColumns = EVENTS,
    unique_days: bool = False,
) -> DataFrame:
    """``indicator_rollup`` of the index cohort without label columns and without a self-join.

    The K condition columns are packed into one bit mask per 62 conditions right after the scan, so an
    exchanged row is the person, the date and a few numbers however wide the table is. Days are combined
    first (map-side, ``bit_or``): copies of a row vanish before the shuffle and a person is left with at
    most one row per calendar day, which bounds the per-person window that finds the first index date.
    The group-by after the window uses the window's partitioning. With ``unique_days`` the caller states
    that person and date are already unique, and the first exchange is left out.
    """
    days = filters.cohort_days(facts, ev).filter(F.col(ev.person).isNotNull())
    blocks = [list(conditions[i : i + _BITS]) for i in range(0, len(conditions), _BITS)]
    masks = [f"_mask{b}" for b in range(len(blocks))]
    has_bmi, has_dose = "BMI_rounded" in days.columns, "had_vaccine_administered" in days.columns

    def packed(names: Sequence[str]) -> str:
        return " + ".join(["0L", *[f"IF(`{name}` = 1, {1 << bit}L, 0L)" for bit, name in enumerate(names)]])

    narrow = days.select(
        ev.person,
        ev.date,
        is_one(ev.index_flag).alias("_index"),
        *[F.expr(f"{packed(names)} AS {mask}") for mask, names in zip(masks, blocks)],
        *([F.col("BMI_rounded")] if has_bmi else []),
        *([F.col("had_vaccine_administered").cast("long").alias("had_vaccine_administered")] if has_dose else []),
    )
    if not unique_days:
        narrow = narrow.groupBy(ev.person, ev.date).agg(
            F.max("_index").alias("_index"),
            *[F.bit_or(m).alias(m) for m in masks],
            *([F.max("BMI_rounded").alias("BMI_rounded")] if has_bmi else []),
            *([F.sum("had_vaccine_administered").alias("had_vaccine_administered")] if has_dose else []),
        )
    per_person = Window.partitionBy(ev.person)
    dated = narrow.withColumns(
        {
            ev.index_date: F.min(F.when(F.col("_index"), F.col(ev.date))).over(per_person),
            "_has_index": F.max("_index").over(per_person),
        }
    ).filter(F.col("_has_index"))

    tests = [(w, label, test) for w in windows for label, test in window_tests(w, ev).items()]
    hits = [
        F.expr(f"bit_or(IF({test}, {mask}, 0L)) AS _hit{t}_{b}")
        for t, (_, _, test) in enumerate(tests)
        for b, mask in enumerate(masks)
    ]
    people = dated.groupBy(ev.person).agg(*hits, *_extra_aggregates(narrow.columns))
    position = {name: (b, bit) for b, names in enumerate(blocks) for bit, name in enumerate(names)}
    number = {(w.tag, label): t for t, (w, label, _) in enumerate(tests)}

    def unpacked(condition: str, window: LabelWindow, label: str) -> str:
        block, bit = position[condition]
        hit = f"_hit{number[window.tag, label]}_{block}"
        return f"CAST(getbit({hit}, {bit}) AS INT) AS `{indicator_name(condition, window, label)}`"

    kept = [c for c in people.columns if c != ev.person and not c.startswith("_hit")]
    return people.selectExpr(
        f"`{ev.person}`", *[unpacked(c, w, lb) for c in conditions for w in windows for lb in w.labels], *kept
    )


def enrich(rollup: DataFrame, cohort: DataFrame, deaths: DataFrame, ev: EventColumns = EVENTS) -> DataFrame:
    """Add the death flag and the base attributes, and keep adult women.

    Deaths are reduced to one row per person first, so the join cannot multiply rows. The base cohort is
    filtered before an inner join: a filter on its columns makes the outer form inner anyway.
    """
    death = deaths.groupBy(ev.person).agg(F.max("patient_death").alias("patient_death_indicator"))
    women = filters.adult_female(cohort)
    return women.join(rollup.join(death, ev.person, "left"), ev.person, "inner")


def patient_summary(
    facts: DataFrame,
    cohort: DataFrame,
    deaths: DataFrame,
    conditions: Sequence[str],
    windows: Sequence[LabelWindow] = WINDOWS,
    ev: EventColumns = EVENTS,
    unique_days: bool = False,
) -> DataFrame:
    return enrich(fused_rollup(facts, conditions, windows, ev, unique_days), cohort, deaths, ev)


def history_table(
    summary: DataFrame,
    columns: Mapping[str, str] = HISTORY_COLUMNS,
    base: Sequence[str] = BASE_COLUMNS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Base columns and renamed outcome/history columns, with the first-time-case outcomes added."""
    picked = summary.select(*base, *[F.col(old).alias(new) for new, old in columns.items()], *keep)
    return exclude_prior(picked, {k: v for k, v in INCIDENT_OUTCOMES.items() if set(v) <= set(columns)})


def exclude_prior(df: DataFrame, outcomes: Mapping[str, tuple[str, str]]) -> DataFrame:
    """New outcome columns that are NULL where the prior history is 1; a NULL history excludes nobody."""
    return df.withColumns(
        {
            out: F.when(is_one(prior), F.lit(None).cast("int")).otherwise(F.col(outcome))
            for out, (outcome, prior) in outcomes.items()
        }
    )


def clean_patients(df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS, min_age: int = 1) -> DataFrame:
    """Model population: known age and sex, well-represented race."""
    return filters.common_race(filters.known_sex(filters.age_known(df.select(*columns), min_age)))


def age_band_cohort(df: DataFrame, columns: Sequence[str], low: int = 18, high: int = 50) -> DataFrame:
    return filters.age_band(df, low, high).select(*columns)


def clean_before_encoding(df: DataFrame, low: int = 18, high: int = 50) -> DataFrame:
    return filters.common_race(filters.known_sex(filters.age_band(df, low, high)))


def distinct_persons(df: DataFrame, key: str = "person_id", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.agg(count.alias("n_persons"))
