"""Small column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_one(name: str) -> Column:
    return F.col(name) == 1


def flag(condition: Column) -> Column:
    """1 where the condition is true, else 0; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def any_of(names: Sequence[str]) -> Column:
    """OR of 0/1 columns, NULL only when every component is NULL."""
    return F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE, NULL where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def p_label(p: Column) -> Column:
    return F.when(p < 0.001, F.lit("< 0.001")).otherwise(F.format_string("%.4f", p))


def binary_label(name: str, zero: str = "Negative", one: str = "Positive") -> Column:
    return F.when(F.col(name) == 1, one).when(F.col(name) == 0, zero)


def group_label(sex: str = "sex_privilege", race: str = "race_privilege") -> Column:
    """Intersection label such as ``Female_Non-White``."""
    return F.concat_ws(
        "_",
        F.when(is_one(sex), "Male").otherwise("Female"),
        F.when(is_one(race), "White").otherwise("Non-White"),
    )


def clean_name(value: str) -> str:
    return value.replace(" ", "_")


def linear(terms: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Weighted sum of columns, parsed from one text instead of built from a call per term."""
    parts = [f"{float(intercept)!r}D", *[f"CAST(`{n}` AS DOUBLE) * {float(w)!r}D" for n, w in terms.items()]]
    return F.expr(" + ".join(parts))


def logistic(eta: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def hash_uniform(*columns: Column, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed only, not on the data's layout.

    It is the first forty bits of the MD5 digest of the key's text, so that any SQL engine can state it too.
    """
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 10), 16, 10).cast("double") / F.lit(float(1 << 40))
