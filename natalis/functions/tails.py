"""Tail probabilities of the normal, t and chi-square laws for result rows.

Spark has no such functions. They are applied to result tables of a few rows only, through
Arrow-batched pandas UDFs; the statistics themselves are plain Spark aggregates.
"""

from __future__ import annotations

import math
from functools import lru_cache

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _fraction(term, tiny: float = 1e-300, limit: int = 10_000_000) -> float:
    """Value of a continued fraction b0 + a1/(b1 + a2/(b2 + ...)) by the modified Lentz rule.

    The number of terms grows with the root of the parameters. Not to converge is an error.
    """
    _, b = term(0)
    value = c = b or tiny
    d = 0.0
    for i in range(1, limit):
        a, b = term(i)
        d = 1.0 / ((b + a * d) or tiny)
        c = (b + a / c) or tiny
        step = c * d
        value *= step
        if abs(step - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"the continued fraction has not converged after {limit} terms")


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)

    def term(i: int) -> tuple[float, float]:
        if i < 2:
            return (1.0, float(i))
        m, odd = divmod(i - 1, 2)
        if odd:
            return (-(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0)
        return (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0)

    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(log_front) / a * _fraction(term)


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        part = total = 1.0 / a
        k = a
        while part > total * 1e-17:
            k += 1.0
            part *= x / k
            total += part
        return 1.0 - front * total

    def term(i: int) -> tuple[float, float]:
        if i == 0:
            return (0.0, x + 1.0 - a)
        return (-i * (i - a), x + 2.0 * i + 1.0 - a)

    return front / _fraction(term)


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def t_upper(t: float, df: float) -> float:
    half = t_two_sided(t, df) / 2.0
    return half if t > 0 else 1.0 - half


def t_quantile(p: float, df: float) -> float:
    """Inverse of the t distribution function for p > 0.5, by bisection."""
    low, high = 0.0, 1.0
    while 1.0 - t_upper(high, df) < p:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if 1.0 - t_upper(mid, df) < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def chi2_upper(x: float, df: float) -> float:
    return gamma_upper(df / 2.0, x / 2.0)


@lru_cache(maxsize=64)
def rank_sum_counts(m: int, n: int) -> list[int]:
    """In how many ways m of m + n ranks give each value 0 to m * n of the rank-sum statistic."""
    counts = [1] + [0] * (m * n)
    for i in range(1, m + 1):  # the Gaussian binomial, factor by factor
        for j in range(m * n, n + i - 1, -1):
            counts[j] -= counts[j - n - i]
        for j in range(i, m * n + 1):
            counts[j] += counts[j - i]
    return counts


def rank_sum_two_sided(w: float, m: float, n: float) -> float:
    """Exact p-value of the rank-sum statistic without ties."""
    counts = rank_sum_counts(int(m), int(n))
    at = round(w)
    extreme = sum(counts[at:]) if 2 * w > m * n else sum(counts[: at + 1])
    return min(1.0, 2 * extreme / sum(counts))


def _apply(fn, *columns: pd.Series) -> pd.Series:
    rows = zip(*columns)
    return pd.Series([None if any(pd.isna(v) for v in row) else fn(*row) for row in rows], dtype="float64")


@pandas_udf(DoubleType())
def p_normal(z: pd.Series) -> pd.Series:
    return _apply(normal_two_sided, z)


@pandas_udf(DoubleType())
def p_t(t: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(t_two_sided, t, df)


@pandas_udf(DoubleType())
def p_t_greater(t: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(t_upper, t, df)


@pandas_udf(DoubleType())
def q_t(p: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(t_quantile, p, df)


@pandas_udf(DoubleType())
def p_chi2(x: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(chi2_upper, x, df)


@pandas_udf(DoubleType())
def p_rank_sum(w: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    return _apply(rank_sum_two_sided, w, m, n)
