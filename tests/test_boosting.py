import math
import random

import pytest
from pyspark.sql import functions as F

from natalis.operators import boosting


def sums(rows, margins):
    g = sum(1 / (1 + math.exp(-m)) - r[-1] for r, m in zip(rows, margins))
    return g, sum((1 / (1 + math.exp(-m))) * (1 - 1 / (1 + math.exp(-m))) for m in margins)


def grown(rows, margins, edges, depth, penalty, least, rate, node=1):
    """Tree by trying every cut: {node: (feature, edge, missing first, gain) or weight}."""
    g, h = sums(rows, margins)
    best = None
    for f, own in enumerate(edges if depth else []):
        for edge in own:
            for missing in (False, True):
                side = [missing if r[f] is None else r[f] <= edge for r in rows]
                one = sums([r for r, s in zip(rows, side) if s], [m for m, s in zip(margins, side) if s])
                two = g - one[0], h - one[1]
                if min(one[1], two[1]) < max(least, 1e-12):
                    continue
                gain = (one[0] ** 2 / (one[1] + penalty) + two[0] ** 2 / (two[1] + penalty) - g * g / (h + penalty)) / 2
                key = (-round(gain, 9), f, edge, missing)
                if gain > 1e-9 and (best is None or key < best[0]):
                    best = key, side
    if best is None:
        return {node: -rate * g / (h + penalty)}
    (gain, f, edge, missing), side = best
    tree = {node: (f, edge, missing, -gain)}
    for k, wanted in enumerate((True, False)):
        part = [(r, m) for r, m, s in zip(rows, margins, side) if s == wanted]
        tree |= grown([r for r, _ in part], [m for _, m in part], edges, depth - 1, penalty, least, rate, 2 * node + k)
    return tree


def reached(tree, row):
    node = 1
    while isinstance(tree[node], tuple):
        f, edge, missing, _ = tree[node]
        node = 2 * node + (0 if (missing if row[f] is None else row[f] <= edge) else 1)
    return tree[node]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(500):
        x, z, flag = rng.choice([None, *range(8)]), rng.choice([None, 0.5, 1.5, 2.5]), rng.randint(0, 1)
        rows.append((x, z, flag, int(rng.random() < 1 / (1 + math.exp(-((x or 6) - 4 + 2 * flag * (z or 0) - 1))))))
    return rows, spark.createDataFrame(rows, "`a.x` int, z double, flag int, y int").repartition(5)


@pytest.mark.parametrize("penalty, least", [(1.0, 1.0), (0.1, 6.0)])
def test_trees_against_every_cut_tried(spark, table, penalty, least):
    rows, df = table
    names = ["a.x", "z", "flag"]
    model = boosting.fit_boosted(df, names, "y", rounds=3, depth=3, penalty=penalty, least_curvature=least)
    edges = [sorted({r[f] for r in rows if r[f] is not None}) for f in range(3)]
    margins = [0.0] * len(rows)
    for tree in model.trees:
        want = grown(rows, margins, edges, 3, penalty, least, 0.3)
        assert set(tree) == set(want)
        for k, n in tree.items():
            if n.feature is None:
                assert n.weight == pytest.approx(want[k])
            else:
                assert (names.index(n.feature), n.edge, n.missing_first) == want[k][:3] and n.gain == pytest.approx(want[k][3], abs=1e-8)
        margins = [m + reached(want, r) for m, r in zip(margins, rows)]
    scored = model.transform(df.withColumn("extra", F.lit("x"))).collect()
    key = lambda r: tuple((v is None, v or 0) for v in r)
    found = sorted(((*r[:4], r["score"]) for r in scored), key=key)
    for a, b in zip(found, sorted(((*r, 1 / (1 + math.exp(-m))) for r, m in zip(rows, margins)), key=key)):
        assert a == pytest.approx(b)
    assert {r["feature"] for r in model.importance(spark).collect()} <= set(names)
    assert sum(r["gain"] for r in model.importance(spark).collect()) == pytest.approx(
        sum(n.gain for t in model.trees for n in t.values() if n.feature)
    )


def test_loss_falls_and_missing_targets_stay_out(spark, table):
    rows, df = table
    loss = []
    noisy = df.unionByName(df.limit(50).withColumn("y", F.lit(None).cast("int")))
    for rounds in (1, 3, 8):
        model = boosting.fit_boosted(noisy, ["a.x", "z", "flag"], "y", rounds=rounds, depth=3)
        p = F.when(F.col("y") == 1, F.col("score")).otherwise(1 - F.col("score"))
        loss.append(model.transform(df).agg(F.sum(-F.log(p))).first()[0])
    assert loss[0] > loss[1] > loss[2]


def test_odd_tables(spark):
    kinds = "x double, y int"
    none = boosting.fit_boosted(spark.createDataFrame([], kinds), ["x"], "y", rounds=2)
    assert none.trees == [] and none.transform(spark.createDataFrame([(1.0, 1)], kinds)).first()["score"] == 0.5
    one = boosting.fit_boosted(spark.createDataFrame([(float("nan"), 1), (None, 1)], kinds), ["x"], "y", rounds=2, least_curvature=0.0)
    assert [set(t) for t in one.trees] == [{1}, {1}] and one.trees[0][1].weight == pytest.approx(0.3 * 1.0 / 1.5)
    same = boosting.fit_boosted(spark.createDataFrame([(5.0, k % 2) for k in range(40)], kinds), ["x"], "y", rounds=1)
    assert set(same.trees[0]) == {1} and same.trees[0][1].weight == 0
    with pytest.raises(ValueError):
        boosting.fit_boosted(spark.createDataFrame([(1.0, 1)], kinds), ["x"], "y", penalty=0)
