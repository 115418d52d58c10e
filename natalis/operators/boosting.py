"""Second-order gradient boosting of shallow trees on binned features.

Features are cut into bins once, and rows with equal bins become one row with its counts, so later passes read patterns.
A tree grows level by level. A level is one aggregation: every row adds its gradient and curvature to the cell
(node, feature, bin), combined map-side, and running sums over the bins of a cell's feature give the regularised gain of
every cut. The driver sees the best cut of each node, at most 2^depth rows, and the size of the shuffle depends on nodes,
features and bins only. Rows without a value go to the side of a cut where the gain is larger.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from natalis.functions.columns import logistic
from natalis.sources.store import cut_lineage

GAIN_DIGITS = 9


@dataclass(frozen=True)
class Node:
    """A node of a tree: its weight, and its cut unless it is a leaf. Node k has the children 2k and 2k + 1."""

    weight: float  # what a leaf adds to the margin
    curvature: float
    feature: str | None = None
    edge: float | None = None  # a value up to here goes to the child 2k
    place: int | None = None  # of the edge among the feature's edges
    missing_first: bool | None = None  # rows without a value go to the child 2k
    gain: float | None = None


Tree = Mapping[int, Node]


def _value(feature: str) -> str:
    """A feature as SQL: a double, NaN is a missing value."""
    name = feature.replace("`", "``")
    return f"nullif(CAST(`{name}` AS DOUBLE), double('NaN'))"


def _at_leaf(tree: Tree, test: Callable[[Node], str], leaf: Callable[[int], str], node: int = 1) -> str:
    """SQL of what ``leaf`` says about the leaf that a row reaches."""
    own = tree[node]
    if own.feature is None:
        return leaf(node)
    first, second = (_at_leaf(tree, test, leaf, 2 * node + k) for k in (0, 1))
    return f"CASE WHEN {test(own)} THEN {first} ELSE {second} END"


def _plain(own: Node) -> str:
    return f"coalesce({_value(own.feature)} <= {own.edge!r}D, {str(own.missing_first).lower()})"


@dataclass
class BoostedTrees:
    """Fitted trees, applied as one generated expression."""

    features: Sequence[str]
    trees: Sequence[Tree]

    def margin(self) -> Column:
        """Log-odds of class 1. A missing value takes the learned side."""
        parts = [_at_leaf(t, _plain, lambda k, t=t: f"{t[k].weight!r}D") for t in self.trees]
        return F.expr(" + ".join(["0.0D", *parts]))

    def transform(self, df: DataFrame, prediction: str = "y_pred", probability: str | None = "score") -> DataFrame:
        """Add the predicted class (probability above one half) and the probability."""
        margin = self.margin()
        columns = {prediction: F.when(margin > 0, 1).otherwise(0)}
        if probability:
            columns[probability] = logistic(margin)
        return df.withColumns(columns)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node; ``weight`` is NULL for nodes that are cut, the cut's columns for leaves."""
        rows = [
            (t, k, n.feature, n.edge, n.missing_first, n.gain, n.curvature, n.weight if n.feature is None else None)
            for t, tree in enumerate(self.trees, start=1)
            for k, n in sorted(tree.items())
        ]
        kinds = "tree int, node int, feature string, edge double, missing_first boolean, gain double, curvature double, weight double"
        return spark.createDataFrame(rows, kinds)

    def importance(self, spark: SparkSession) -> DataFrame:
        """Summed gain and number of cuts of each feature that is used."""
        cuts = self.table(spark).filter(F.col("feature").isNotNull())
        return cuts.groupBy("feature").agg(F.sum("gain").alias("gain"), F.count("*").alias("cuts"))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Edges of at most ``bins`` bins per feature: its values at equal shares of the rows, in one pass over all rows.

    Up to ``accuracy`` distinct values the shares are exact; beyond, they are off by one in ``accuracy`` at most.
    """
    shares = [k / bins for k in range(bins)]
    row = df.agg(*[F.percentile_approx(F.expr(_value(f)), shares, accuracy).alias(str(i)) for i, f in enumerate(features)]).first()
    return {f: sorted(set(row[i] or [])) for i, f in enumerate(features)}


def _binned(df: DataFrame, features: Sequence[str], target: str, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(b0, b1, ..., ones, n): patterns of bins with the rows of class 1 and all rows. A missing value has bin -1."""
    names = [f"b{i}" for i in range(len(features))]

    def bin_of(feature: str) -> Column:
        value, known = F.expr(_value(feature)), F.lit([float(e) for e in edges[feature]]).cast("array<double>")
        return F.when(value.isNull(), -1).otherwise(F.size(F.filter(known, lambda e: e < value)))

    bins = [bin_of(feature).alias(name) for name, feature in zip(names, features, strict=True)]
    rows = df.select(*bins, F.col(target).cast("double").alias("y")).filter(F.col("y").isin(0.0, 1.0))
    return rows.groupBy(*names).agg(F.sum("y").alias("ones"), F.count("*").cast("double").alias("n"))


def histograms(rows: DataFrame, features: int, node: Column) -> DataFrame:
    """(node, feature, bin, g, h): summed gradient and curvature of the loss at the rows' margins; NULL nodes are left out."""
    p = logistic(F.col("margin"))
    cells = rows.select(
        node.alias("node"),
        (F.col("n") * p - F.col("ones")).alias("g"),
        (F.col("n") * p * (1 - p)).alias("h"),
        F.posexplode(F.array(*[F.col(f"b{i}") for i in range(features)])).alias("feature", "bin"),
    )
    return cells.filter(F.col("node").isNotNull()).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def split_gains(cells: DataFrame, sizes: Sequence[int], penalty: float, least: float) -> DataFrame:
    """(node, feature, bin, missing_first, all_g, all_h, g, h, gain) of every cut; g and h are of the first child.

    ``sizes`` has the number of edges of each feature. The gain is NULL where a child's curvature is under ``least`` or
    zero, and rounded, so that equal cuts are equal whatever the order of summation was.
    """
    feature = Window.partitionBy("node", "feature")
    upto = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    has = F.col("bin") >= 0
    sums = {}
    for x in ("g", "h"):
        sums[f"all_{x}"] = F.sum(x).over(feature)
        sums[f"none_{x}"] = F.sum(F.when(~has, F.col(x)).otherwise(0.0)).over(feature)
        sums[f"run_{x}"] = F.sum(F.when(has, F.col(x)).otherwise(0.0)).over(upto)
    sides = F.explode(F.array(F.lit(False), F.lit(True)))
    cuts = cells.withColumns(sums).withColumn("missing_first", sides)
    for x in ("g", "h"):
        cuts = cuts.withColumn(x, F.col(f"run_{x}") + F.when(F.col("missing_first"), F.col(f"none_{x}")).otherwise(0.0))
    rest_g, rest_h = F.col("all_g") - F.col("g"), F.col("all_h") - F.col("h")

    def part(g: Column, h: Column) -> Column:
        return g * g / (h + F.lit(penalty))

    gain = (part(F.col("g"), F.col("h")) + part(rest_g, rest_h) - part(F.col("all_g"), F.col("all_h"))) / 2
    inner = has & (F.col("bin") < F.lit(list(sizes)).cast("array<int>")[F.col("feature")])
    wide = (F.col("h") >= least) & (rest_h >= least) & (F.col("h") > 1e-12) & (rest_h > 1e-12)
    cuts = cuts.withColumn("gain", F.when(inner & wide, F.round(gain, GAIN_DIGITS)))
    return cuts.select("node", "feature", "bin", "missing_first", "all_g", "all_h", "g", "h", "gain")


def _best(gains: DataFrame, least_gain: float) -> DataFrame:
    """The best cut of each node, with the node's own sums; of equal gains the first feature, lowest edge, missing last."""
    choice = F.struct(-F.col("gain"), "feature", "bin", "missing_first", "g", "h")
    return gains.groupBy("node").agg(
        F.min_by("all_g", F.struct("feature", "bin")).alias("all_g"),
        F.min_by("all_h", F.struct("feature", "bin")).alias("all_h"),
        F.min(F.when(F.col("gain") > least_gain, choice)).alias("cut"),
    )


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    rounds: int = 50,
    depth: int = 5,
    rate: float = 0.3,
    penalty: float = 1.0,
    least_curvature: float = 1.0,
    least_gain: float = 0.0,
    bins: int = 64,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> BoostedTrees:
    """Boosted trees for a target of 0 and 1; rows with another target are left out.

    A leaf's weight is ``-rate * g / (h + penalty)``. A node is cut where the gain is largest and above ``least_gain`` and
    both children have a curvature of at least ``least_curvature``. ``edges`` replaces ``bin_edges``. Without rows there
    are no trees, and the probability is one half.
    """
    if penalty <= 0:
        raise ValueError("the penalty must be positive")
    features = list(features)
    edges = {f: sorted(edges[f]) for f in features} if edges else bin_edges(df, features, bins)
    position = {f: i for i, f in enumerate(features)}
    sizes = [len(edges[f]) for f in features]
    rows = cut_lineage(_binned(df, features, target, edges).withColumn("margin", F.lit(0.0)))

    def binned(own: Node) -> str:
        name = f"b{position[own.feature]}"
        return f"CASE WHEN {name} < 0 THEN {str(own.missing_first).lower()} ELSE {name} <= {own.place} END"

    trees: list[Tree] = []
    for _ in range(rounds):
        tree: dict[int, Node] = {}
        for level in range(depth):
            open_ = 1 << level
            node = F.expr(_at_leaf(tree, binned, lambda k: str(k) if k >= open_ else "CAST(NULL AS INT)")) if tree else F.lit(1)  # noqa: B023
            found = _best(split_gains(histograms(rows, len(features), node), sizes, penalty, least_curvature), least_gain)
            cut_any = False
            for r in found.collect():  # a row per node of the level
                k, cut = r["node"], r["cut"]
                tree[k] = Node(-rate * r["all_g"] / (r["all_h"] + penalty), r["all_h"])
                if cut is None:
                    continue
                cut_any, name = True, features[cut["feature"]]
                tree[k] = Node(
                    tree[k].weight, r["all_h"], name, float(edges[name][cut["bin"]]), cut["bin"], cut["missing_first"], -cut[0]
                )
                for child, g, h in ((2 * k, cut["g"], cut["h"]), (2 * k + 1, r["all_g"] - cut["g"], r["all_h"] - cut["h"])):
                    tree[child] = Node(-rate * g / (h + penalty), h)
            if not cut_any:
                break
        if not tree:
            break
        if not all(math.isfinite(n.weight) for n in tree.values()):
            raise ArithmeticError("a leaf's weight is not finite")
        trees.append(tree)
        step = F.expr(_at_leaf(tree, binned, lambda k, t=tree: f"{t[k].weight!r}D"))
        if len(trees) < rounds:
            rows = cut_lineage(rows.withColumn("margin", F.col("margin") + step))
    return BoostedTrees(features, trees)


def first_gains(
    df: DataFrame, features: Sequence[str], target: str, edges: Mapping[str, Sequence[float]], penalty: float = 1.0, least_curvature: float = 1.0
) -> DataFrame:
    """(feature, edge, gain) of every cut of the first tree's root that leaves curvature on both sides, missing values last."""
    features = list(features)
    rows = _binned(df, features, target, edges).withColumn("margin", F.lit(0.0))
    cells = histograms(rows, len(features), F.lit(1))
    gains = split_gains(cells, [len(edges[f]) for f in features], penalty, least_curvature)
    names = F.lit(features)
    places = F.array(*[F.lit([float(e) for e in sorted(edges[f])]).cast("array<double>") for f in features])
    return gains.filter(F.col("gain").isNotNull() & ~F.col("missing_first")).select(
        names[F.col("feature")].alias("feature"), places[F.col("feature")][F.col("bin")].alias("edge"), "gain"
    )
