import random

import pytest
from pyspark.sql import functions as F

from natalis.operators import chained, matching


def greedy(rows):
    """Unit by unit from the highest treated score: the nearest free control, the lower one on a tie."""
    free, pairs = {s: c for s, _, c in rows if c}, {}
    for s, t, _ in sorted(rows, reverse=True):
        for _ in range(t):
            if not free:
                return pairs
            best = min(free, key=lambda c: (abs(c - s), c))
            pairs[s, best] = pairs.get((s, best), 0) + 1
            free[best] -= 1
            if not free[best]:
                del free[best]
    return pairs


def walked(rows, width, piece_rows):
    """All steps of a chain over ranges of ``width`` rows, without Spark."""
    order = sorted(rows, reverse=True)
    ranges = [order[k : k + width] for k in range(0, len(order), width)]
    place, pieces, pairs, held = chained.Place(), [], {}, 0
    while place.current < len(ranges):
        stack = [list(s) for s in pieces.pop()] if pieces else []
        below = ranges[place.frontier] if place.frontier < len(ranges) else []
        held = max(held, len(stack))
        found, place = chained.step(
            place, ranges[place.current], below, stack, bool(pieces), len(ranges), order[-1][0], order[0][0], True, True
        )
        pieces += [stack[k : k + piece_rows] for k in range(0, len(stack), piece_rows)]
        for t, c, t_from, c_from, n in found:
            pairs.setdefault((t, c), []).append((t_from, c_from, n))
    assert held <= piece_rows
    return pairs


@pytest.mark.parametrize("seed", range(150))
def test_steps_are_greedy(seed):
    rng = random.Random(seed)
    p, span = rng.choice([0.2, 0.5, 0.8]), rng.choice([10, 60, 400])
    rows = {}
    for _ in range(rng.randint(1, 90)):
        s = float(rng.randint(0, span))
        tilt = p if seed % 3 else min(1.0, 1.3 * s / span)  # every third: controls are scarce at the upper end
        t, c = rows.get(s, (0, 0))
        rows[s] = (t + 1, c) if rng.random() < tilt else (t, c + 1)
    rows = [(s, *n) for s, n in rows.items()]
    got = walked(rows, rng.choice([1, 3, 8]), rng.choice([1, 4]))
    assert {k: sum(n for *_, n in v) for k, v in got.items()} == greedy(rows)
    for at, side in ((0, 1), (1, 2)):  # units of a score are used once each, from the first on
        for s, *n in rows:
            used = sorted((part[at], part[2]) for k, v in got.items() if k[at] == s for part in v)
            assert sum(m for _, m in used) <= n[side - 1]
            assert all(a + m == b for (a, m), (b, _) in zip(used, used[1:])) and (not used or used[0][0] == 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_allocation_with_small_tasks(spark, monkeypatch, seed):
    calls, own = [], chained.chained
    monkeypatch.setattr(matching, "chained", lambda *a: calls.append(a[1]) or own(*a))
    rng = random.Random(seed)
    rows = {}
    for _ in range(260):
        s = rng.randint(0, 300) / 8
        t, c = rows.get(s, (0, 0))
        rows[s] = (t + 1, c) if rng.random() < (0.9 if 15 < s < 30 else 0.1) else (t, c + 1)
    rows = [(s, *n) for s, n in rows.items()]
    table = spark.createDataFrame(rows, "score double, n_treated long, n_control long").repartition(3)
    plain = matching.allocate(table, parts=6).groupBy("treated_score", "control_score").agg(F.sum("n").alias("n")).collect()
    small = matching.allocate(table, task_rows=60).groupBy("treated_score", "control_score").agg(F.sum("n").alias("n")).collect()
    want = greedy(rows)
    assert calls and all(len(ranges) > 1 for ranges in calls)
    assert {(r[0], r[1]): r[2] for r in plain} == want
    assert {(r[0], r[1]): r[2] for r in small} == want
