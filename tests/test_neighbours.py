"""Neighbours by regions, leaves and matrix products against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from natalis.operators import imbalance, neighbours


def brute(x, g, i, k):
    same = np.flatnonzero((g == g[i]) & (np.arange(len(x)) != i))
    d2 = ((x[same] - x[i]) ** 2).sum(axis=1)
    return same[np.lexsort((same, d2))[:k]].tolist()


def region_of(x, pid):
    order, ends = neighbours._tree_order(x)
    return neighbours._Region(pid[order], np.ascontiguousarray(x[order]), ends)


@pytest.mark.parametrize("kind", ["flags", "far", "equal"])
def test_many_regions_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "_BLOCK", 1000)
    monkeypatch.setattr(neighbours, "_MEMBERS", 2)
    rng = np.random.default_rng(5)
    if kind == "flags":  # many equal distances
        x = np.unique(rng.integers(0, 3, (9000, 9)), axis=0).astype(float)
        rng.shuffle(x)
    elif kind == "far":  # numbers of any size, with some that are not finite
        x = np.c_[np.exp(rng.normal(size=(5000, 2)) * 8), rng.integers(0, 2, (5000, 3))]
        x[::500, 1] = np.nan
        x[1::500, 0] = np.inf
    else:
        x = np.ones((2500, 2))
    g = np.array(list("aaab"))[rng.integers(0, 4, len(x))]
    rows = pd.DataFrame({"g": g, "pid": np.arange(len(x)), "x": [v.tolist() for v in x]})
    df = spark.createDataFrame(rows, "g string, pid long, x array<double>")
    found = neighbours.nearest(df, 5, by=["g"], asked=F.col("pid") % 3 == 0).toPandas().sort_values(["pid", "rank"])
    lists = found.groupby("pid")["nid"].apply(list).to_dict()
    finite = np.isfinite(x).all(axis=1)
    assert set(lists) == set(np.flatnonzero(finite & (np.arange(len(x)) % 3 == 0)).tolist())
    g = np.where(finite, g, "-")
    for i in lists:
        assert lists[i] == brute(x, g, i, 5)


def test_few_pairs_get_their_full_distance(monkeypatch):
    """Of the pairs of two regions of flags and an age the boxes and products leave less than a hundredth."""
    rng = np.random.default_rng(6)
    x = np.c_[rng.integers(0, 90, 12_000), rng.random((12_000, 30)) < 0.25].astype(float)
    pid, counted, take = rng.permutation(len(x)), [], neighbours._Asking._take
    monkeypatch.setattr(neighbours._Asking, "_take", lambda self, first, i, *rest: (counted.append(len(i)), take(self, first, i, *rest)))
    parts = [region_of(x[:6000], pid[:6000]), region_of(x[6000:], pid[6000:])]
    asking = neighbours._Asking.of(parts[0], np.ones(6000, bool), 4)
    asking.compare(parts[0], new=False)
    asking.compare(parts[1], new=True)
    assert sum(counted) < 6000 * 12_000 / 100
    ids, points = np.concatenate([p.pid for p in parts]), np.concatenate([p.x for p in parts])
    for i in range(0, 6000, 50):
        d2 = ((points - parts[0].x[i]) ** 2).sum(axis=1)
        d2[i] = np.inf
        assert asking.nid[i].tolist() == ids[np.lexsort((ids, d2))[:4]].tolist()


def test_memory_does_not_grow_with_the_points():
    """What a region is compared with at once is bounded, whatever the number of leaves."""
    rng = np.random.default_rng(7)
    region = region_of(rng.normal(size=(20_000, 4)), np.arange(20_000))
    leaves = np.arange(len(region.ends))
    sizes = [sum((region.ends - region.starts)[run]) for run in neighbours._Asking._runs(region, leaves, None, 512)]
    assert sum(sizes) == 20_000 and max(sizes) * 512 <= 2 * neighbours._CELLS


def test_smote_asks_only_for_rows_that_get_copies(spark, monkeypatch):
    asked, nearest = [], imbalance.nearest

    def listening(*args, **names):
        found = nearest(*args, **names)
        asked.append({r["pid"] for r in found.select("pid").distinct().collect()})
        return found

    monkeypatch.setattr(imbalance, "nearest", listening)
    rows = [(float(i), 1) for i in range(40)] + [(float(i), 0) for i in range(47)]
    made = imbalance.smote(spark.createDataFrame(rows, "a double, y int"), ["a"], "y")
    assert made.filter("synthetic").count() == 7
    assert asked == [set(range(7))]


def test_wide_vectors_are_compared_by_products(monkeypatch):
    """In 64 dimensions boxes exclude nothing; still few pairs get their full distance."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 64)).astype(np.float32).astype(float) * 1e-3 + 5
    counted, take = [], neighbours._Asking._take
    monkeypatch.setattr(neighbours._Asking, "_take", lambda self, first, i, *rest: (counted.append(len(i)), take(self, first, i, *rest)))
    region = region_of(x, np.arange(4000))
    asking = neighbours._Asking.of(region, np.ones(4000, bool), 5)
    asking.compare(region, new=False)
    assert sum(counted) < 4000 * 4000 / 50
    for i in range(0, 4000, 40):
        d2 = ((region.x - region.x[i]) ** 2).sum(axis=1)
        d2[i] = np.inf
        assert asking.nid[i].tolist() == region.pid[np.lexsort((region.pid, d2))[:5]].tolist()


def test_smote_counts_the_patterns_once(spark):
    """The rows are read once for all new points, not again for the sizes of the classes."""
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = [(float(i), 1) for i in range(40)] + [(float(i), 0) for i in range(47)]
    df = spark.createDataFrame(rows, "a double, y int")
    made = imbalance.smote(df.mapInPandas(counting, df.schema), ["a"], "y")
    assert made.filter("synthetic").count() == 7
    assert read.value == len(rows)
