"""Bias mitigation: reweighted training under demographic parity, and equalised-odds thresholds."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.functions.columns import hash_uniform
from natalis.operators.metrics import roc_points
from natalis.operators.linear import LinearFit
from natalis.operators.models import patterns
from natalis.operators.newton import ridge_grid
from natalis.sources.store import cut_lineage

# --- reweighting --------------------------------------------------------------------------------------


def _l1_ball(dimensions: int, units: int) -> Iterator[tuple[int, ...]]:
    """Whole-number points whose absolute values add up to ``units`` at most, each visited once."""
    if dimensions == 0:
        yield ()
        return
    for first in range(-units, units + 1):
        for rest in _l1_ball(dimensions - 1, units - abs(first)):
            yield (first, *rest)


def multiplier_grid(dimensions: int, size: int, limit: float = 2.0) -> list[tuple[float, ...]]:
    """Lattice points of the L1 ball with radius ``limit``, on the coarsest lattice with at least ``size``."""
    units = 0
    while True:
        points = list(_l1_ball(dimensions, units))
        if len(points) >= size or dimensions == 0:
            return [tuple(v * limit / max(units, 1) for v in z) for z in points]
        units += 1


@dataclass
class ReweightedFit:
    best: LinearFit
    table: DataFrame
    multipliers: tuple[float, ...]
    groups: list[tuple]


def _group_chain(sensitive: Sequence[str], groups: Sequence[tuple], values: Sequence[float]) -> Column:
    out = None
    for g, v in zip(groups, values):
        test = None
        for c, level in zip(sensitive, g):
            here = F.col(c) == F.lit(level)
            test = here if test is None else test & here
        out = F.when(test, F.lit(float(v))) if out is None else out.when(test, F.lit(float(v)))
    return out


def reweighted_logistic(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    sensitive: Sequence[str],
    grid_size: int = 10,
    grid_limit: float = 2.0,
    constraint_weight: float = 0.5,
) -> ReweightedFit:
    """Refit under a grid of multipliers and keep the best trade-off of error and parity violation.

    A multiplier per group changes the sign and size of every row's weight: negative weights flip the
    label. Weights depend on group and label only, so all fits run on one table of pattern counts.
    """
    columns = list(dict.fromkeys([*features, target, *sensitive]))
    counts = cut_lineage(patterns(train, columns))
    sizes = sorted(counts.groupBy(*sensitive).agg(F.sum("n").alias("n")).collect(), key=lambda r: tuple(str(r[c]) for c in sensitive))
    groups = [tuple(r[c] for c in sensitive) for r in sizes]
    total = float(sum(r["n"] for r in sizes))
    shares = np.array([float(r["n"]) / total for r in sizes])
    grid = multiplier_grid(len(groups) - 1, grid_size, grid_limit)

    # signed weight of group g and label y: 2y - 1 plus the sum of multipliers minus the group's own over its share
    lam = np.column_stack([np.array(grid).reshape(len(grid), -1), np.zeros(len(grid))])
    pull = lam.sum(axis=1, keepdims=True) - lam / shares
    signed = np.stack([pull - 1.0, pull + 1.0], axis=2).reshape(len(grid), 2 * len(groups))
    cell = _group_chain(sensitive, groups, range(0, 2 * len(groups), 2)).cast("int") + F.col(target).cast("int")
    fits = ridge_grid(
        counts.withColumn("cell", cell), features, (signed > 0).astype("float64"), np.abs(signed)
    )

    guesses = counts.withColumns({f"_p{k}": F.when(f.eta() > 0, 1.0).otherwise(0.0) for k, f in enumerate(fits)})
    n = F.col("n")
    sums = guesses.groupBy(*sensitive).agg(
        F.sum("n").alias("n"),
        *[F.sum(n * F.col(f"_p{k}")).alias(f"s{k}") for k in range(len(fits))],
        *[F.sum(n * F.abs(F.col(f"_p{k}") - F.col(target))).alias(f"e{k}") for k in range(len(fits))],
    ).collect()
    rows = []
    for k, lam in enumerate(grid):
        rate = sum(r[f"s{k}"] for r in sums) / total
        violation = max(abs(r[f"s{k}"] / r["n"] - rate) for r in sums)
        error = sum(r[f"e{k}"] for r in sums) / total
        loss = constraint_weight * violation + (1.0 - constraint_weight) * error
        rows.append((k, [float(v) for v in lam], float(error), float(violation), float(loss)))
    best = min(rows, key=lambda r: (r[4], r[0]))[0]
    table = train.sparkSession.createDataFrame(
        rows, "point int, multipliers array<double>, error double, violation double, loss double"
    )
    return ReweightedFit(fits[best], table, grid[best], groups)


# --- equalised odds -----------------------------------------------------------------------------------


@dataclass
class GroupRule:
    """Positive with probability ``ignore * constant + (1 - ignore) * (p0 [s >= t0] + p1 [s >= t1])``."""

    t0: float
    t1: float
    p0: float
    p1: float
    ignore: float
    constant: float


@dataclass
class OddsRule:
    group: str
    rules: Mapping
    fpr: float
    tpr: float

    def probability(self, score: str) -> Column:
        out = None
        for level, r in self.rules.items():
            s = F.col(score)
            mixed = r.p0 * (s >= F.lit(r.t0)).cast("double") + r.p1 * (s >= F.lit(r.t1)).cast("double")
            value = F.lit(r.ignore * r.constant) + F.lit(1.0 - r.ignore) * mixed
            here = F.col(self.group) == F.lit(level)
            out = F.when(here, value) if out is None else out.when(here, value)
        return out

    def apply(self, df: DataFrame, score: str, key: str, out: str = "y_pred_post", seed: int = 42) -> DataFrame:
        """Randomised prediction; the draw is a hash of the row's key."""
        return df.withColumn(out, F.when(hash_uniform(F.col(key), seed=seed) < self.probability(score), 1).otherwise(0))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (str(k), *(None if np.isinf(t) else float(t) for t in (r.t0, r.t1)), r.p0, r.p1, r.ignore, r.constant)
            for k, r in self.rules.items()
        ]
        return spark.createDataFrame(
            rows,
            "group_value string, threshold_0 double, threshold_1 double, p_0 double, p_1 double, "
            "p_ignore double, constant double",
        )


def upper_hull(points: pd.DataFrame) -> pd.DataFrame:
    """Points (fpr, tpr, threshold) on the upper convex hull, by ascending fpr."""
    ordered = points.sort_values(["fpr", "tpr", "threshold"], ascending=[True, False, False])
    hull: list[int] = []
    x, y = ordered["fpr"].to_numpy(), ordered["tpr"].to_numpy()
    for i in range(len(x)):
        if hull and x[i] == x[hull[-1]]:
            continue
        while len(hull) >= 2:
            a, b = hull[-2], hull[-1]
            if (x[b] - x[a]) * (y[i] - y[a]) - (y[b] - y[a]) * (x[i] - x[a]) >= 0:
                hull.pop()
            else:
                break
        hull.append(i)
    return ordered.iloc[hull]


def roc_hulls(df: DataFrame, y: str, score: str, group: str) -> pd.DataFrame:
    """Upper ROC hull of every group.

    Each task reduces its share of the points to their hull, and the hull of these hulls is the hull of
    all points, so only hull corners are exchanged, however many scores there are.
    """
    points = roc_points(df, y, score, by=[group]).withColumn(
        "threshold", F.coalesce(F.col("threshold"), F.lit(float("inf")))
    )
    columns = [group, "fpr", "tpr", "threshold"]
    kind = dict(df.dtypes)[group]
    schema = f"`{group}` {kind}, fpr double, tpr double, threshold double"

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict = {}
        for batch in batches:
            for level, part in batch.groupby(group):
                both = part if level not in kept else pd.concat([kept[level], part])
                kept[level] = upper_hull(both)
        for part in kept.values():
            yield part[columns]

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        return upper_hull(part)[columns]

    corners = points.select(*columns).dropna(subset=["fpr", "tpr"]).mapInPandas(shrink, schema)
    return corners.groupBy(group).applyInPandas(finish, schema).toPandas()


def equalized_odds_rule(df: DataFrame, y: str, score: str, group: str, grid_size: int = 1000) -> OddsRule:
    """Thresholds per group with equal false and true positive rates and the best accuracy.

    The common point must lie under every group's ROC hull. It is searched on a grid of false positive
    rates; a group whose hull is higher there ignores its score with some probability.
    """
    counts = df.groupBy(group).agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) == 0).alias("n"))
    cells = counts.collect()  # a row per group, as in the resulting rule
    single = [r[group] for r in cells if not r["p"] or not r["n"]]
    if single:
        raise ValueError(f"groups with one class only have no ROC curve: {single}")
    hulls = roc_hulls(df, y, score, group)
    x = np.linspace(0.0, 1.0, grid_size + 1)
    curves = {}
    for level, part in hulls.groupby(group):
        part = part.sort_values("fpr")
        curves[level] = (part["fpr"].to_numpy(), part["tpr"].to_numpy(), part["threshold"].to_numpy())
    heights = {g: np.interp(x, c[0], c[1]) for g, c in curves.items()}
    lowest = np.min(list(heights.values()), axis=0)
    positives, negatives = sum(r["p"] for r in cells), sum(r["n"] for r in cells)
    best = int(np.argmax(positives * lowest + negatives * (1.0 - x)))
    fpr, tpr = float(x[best]), float(lowest[best])
    rules = {}
    for level, (cx, _, ct) in curves.items():
        right = int(np.clip(np.searchsorted(cx, fpr, side="left"), 1, len(cx) - 1))
        p1 = float((fpr - cx[right - 1]) / (cx[right] - cx[right - 1]))
        height = float(heights[level][best])
        ignore = (height - tpr) / (height - fpr) if height - fpr > 1e-12 else 0.0
        key = level.item() if hasattr(level, "item") else level
        rules[key] = GroupRule(float(ct[right - 1]), float(ct[right]), 1.0 - p1, p1, float(ignore), fpr)
    return OddsRule(group, rules, fpr, tpr)
