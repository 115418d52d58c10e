import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from natalis.llm import negatives


def plain(rows, positives=5, few=10):
    """(anchor, positive, rank, negative, scores) by comparing all pairs; rows: (id, label, vector)."""
    kept = []
    for key, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if key is not None and key % 7 == 0 else label
        kept.append((key, label, [math.floor(256 * x) for x in vector]))
    out = []
    for i, (key, label, own) in enumerate(kept):
        if key is None or key % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(own, c)), k is None, k or 0, j) for j, (k, _, c) in enumerate(kept) if j != i]
        scored.sort()
        for p in [s for s in scored if kept[s[3]][1] == label][:positives]:
            fit = [s for s in scored if kept[s[3]][1] != label and -30 * p[0] <= -100 * s[0] <= -90 * p[0]]
            out += [(key, kept[p[3]][0], r, kept[s[3]][0], -p[0], -s[0]) for r, s in enumerate(fit[:few], 1)]
    return out


def mined(spark, rows, parts=3):
    schema = "vec_id long, label int, embedding array<double>, _row string, _id int, rank string"
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).repartition(parts)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mined(df.withColumn("label", moved), F.col("vec_id") % 100 == 0)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    return sorted(map(tuple, found.collect()), key=key), key


@pytest.mark.parametrize("spread", [0.2, 3.0])
def test_against_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "ROWS_IN_CELL", 150)
    monkeypatch.setattr(negatives, "ANCHORS_IN_CELL", 3)
    rng = random.Random(1)
    centres = [[rng.gauss(0, spread) for _ in range(6)] for _ in range(4)]
    rows = []
    for key in range(700):
        label = rng.choice([0, 0, 0, 1, 2, 9])
        rows.append((key, label, [round(c + rng.gauss(0, spread / 2), 1) for c in centres[label % 4]]))
    rows += [(None, 0, [0.1] * 6), (None, 1, [0.3] * 6), (100, 2, [0.5] * 6), (100, 2, [0.5] * 6), (800, None, [1.0] * 6),
             (900, 1, None), (1000, 1, [0.1, None, 0.2, 0.0, 0.0, 0.0]), (1100, 1, [float("nan")] * 6), (1200, 1, [float("inf")] * 6),
             (1300, 0, []), (1400, 0, [2.0]), (1500, 2, [0.5] * 9)]
    got, key = mined(spark, rows)
    assert got == sorted(plain(rows), key=key)
    assert len(got) > 100


def test_empty_and_single_rows(spark):
    assert mined(spark, [(1, 1, [1.0])])[0] == []
    assert mined(spark, [(0, 1, [1.0])])[0] == []
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.mined(none, F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("top", [1, 255, 30_000, 1 << 27])
def test_fields_do_not_touch(top):
    rng = np.random.default_rng(top)
    values = rng.integers(-top, top, (1300, 8), endpoint=True)
    values[:2] = [[top], [-top]]
    for anchor in (rng.integers(-top, top, 8, endpoint=True), np.full(8, top), np.full(8, -top)):
        packed = negatives.Packed(values, int(anchor.min()), int(anchor.max()))
        assert packed.scores(anchor.tolist()).tolist() == [sum(a * int(b) for a, b in zip(anchor.tolist(), row)) for row in values]


def test_too_large_products_are_an_error():
    with pytest.raises(ValueError, match="64 bits"):
        negatives.Packed(np.full((2, 4), 1 << 40), 0, 1 << 40)
