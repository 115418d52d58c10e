"""Window labels around the index date, as column expressions on rows that carry that date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.functions.columns import clean_name
from natalis.plans.clinical import EVENTS, WINDOWS, EventColumns, LabelWindow


def column_range(columns: Sequence[str], first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in table order, both included."""
    return list(columns[columns.index(first) : columns.index(last) + 1])


def lower_bound(window: LabelWindow, ev: EventColumns = EVENTS) -> str:
    if window.days_before:
        return f"date_sub(`{ev.index_date}`, {window.days_before})"
    return f"add_months(`{ev.index_date}`, {-window.months_before})"


def upper_bound(window: LabelWindow, ev: EventColumns = EVENTS) -> str:
    return f"add_months(`{ev.index_date}`, {window.months_after})"


def with_bounds(df: DataFrame, windows: Sequence[LabelWindow] = WINDOWS, ev: EventColumns = EVENTS) -> DataFrame:
    bounds = {}
    for w in windows:
        bounds[w.lower_column] = F.expr(lower_bound(w, ev))
        bounds[w.upper_column] = F.expr(upper_bound(w, ev))
    return df.withColumns(bounds)


def window_tests(window: LabelWindow, ev: EventColumns = EVENTS) -> dict[str, str]:
    """The date test behind each label of a family; a missing date satisfies none.

    Tests are SQL texts: hundreds of columns are built from them, and a text costs one call to the JVM.
    """
    day, index = f"`{ev.date}`", f"`{ev.index_date}`"
    low, high = lower_bound(window, ev), upper_bound(window, ev)
    end = "<=" if window.post_inclusive else "<"
    return {
        window.before: f"{day} < {low}",
        window.during: f"{day} >= {low} AND {day} < {index}",
        window.after: f"{day} >= {index} AND {day} {end} {high}",
    }


def window_label(condition: str, window: LabelWindow, ev: EventColumns = EVENTS) -> Column:
    """``no`` for value 0, one of the three window labels for value 1, else ``undefined``."""
    whens = " ".join(
        f"WHEN `{condition}` = 1 AND {test} THEN '{label}'" for label, test in window_tests(window, ev).items()
    )
    return F.expr(f"CASE WHEN `{condition}` = 0 THEN 'no' {whens} ELSE 'undefined' END")


def label_name(condition: str, window: LabelWindow) -> str:
    return f"{condition}_flag_{window.tag}"


def dummy_name(condition: str, window: LabelWindow, label: str) -> str:
    return f"{label_name(condition, window)}_{clean_name(label)}"


def with_labels(
    df: DataFrame, conditions: Sequence[str], windows: Sequence[LabelWindow] = WINDOWS, ev: EventColumns = EVENTS
) -> DataFrame:
    return df.withColumns({label_name(c, w): window_label(c, w, ev) for c in conditions for w in windows})


def with_dummies(df: DataFrame, conditions: Sequence[str], windows: Sequence[LabelWindow] = WINDOWS) -> DataFrame:
    """One 0/1 column per label that counts. The label domain is declared, so no discovery job runs."""
    return df.withColumns(
        {
            dummy_name(c, w, label): F.expr(f"IF(`{label_name(c, w)}` = '{label}', 1, 0)")
            for c in conditions
            for w in windows
            for label in w.labels
        }
    )


def flag_windows(
    df: DataFrame, conditions: Sequence[str], windows: Sequence[LabelWindow] = WINDOWS, ev: EventColumns = EVENTS
) -> DataFrame:
    """Bounds, labels and dummies for every condition: three projections that Catalyst merges."""
    return with_dummies(with_labels(with_bounds(df, windows, ev), conditions, windows, ev), conditions, windows)
