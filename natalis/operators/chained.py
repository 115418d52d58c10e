"""The greedy choice of a long stretch of scores in steps of bounded size.

Going down the scores, what earlier choices leave behind has a simple shape: the controls taken below the current score
are the highest ones there, so a place (the frontier) says which are free, and the free controls above it are a stack,
the nearest on top. A step reads one range of scores, the range of the frontier and the top piece of the stack, and
goes on until it needs another one; a place and a few numbers go to the next step. Ranges, pieces and results are Parquet
in the shared folder, and no step holds more than two ranges and a piece, however far the choices reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.operators.ordering import RANGE
from natalis.sources.store import fresh_node, read_node, write_node

PAIR, STACK, PLACE = 0, 1, 2
_STEP = "kind int, piece int, a double, b double, c long, d long, e long, place array<long>"
_CHUNK = 65_536


@dataclass(frozen=True)
class Place:
    """Where the choice stands: ranges count downwards from 0, rows of a range too."""

    current: int = 0
    row: int = 0
    taken: int = 0  # treated units of that row which are done
    frontier: int = 0
    control: int = 0
    used: int = 0  # controls of that row which are taken
    open_left: int = 0
    open_right: int = 0


def step(
    place: Place, rows: list[tuple], below: list[tuple], stack: list[list], more: bool, ranges: int, low: float, high: float, first: bool, last: bool
) -> tuple[list[tuple], Place]:
    """Pairs and the next place; ``stack`` is changed. Stops where another range or piece of the stack is needed.

    ``rows`` are (score, treated, control) of the current range in descending order, ``below`` those of the frontier's
    range, ``stack`` has [score, used, control], the nearest last, and ``more`` says whether further pieces lie under it.
    """
    current, i, taken, frontier, j, used = place.current, place.row, place.taken, place.frontier, place.control, place.used
    open_left, open_right, pairs = bool(place.open_left), bool(place.open_right), []
    while True:
        while frontier == current and j < min(i, len(rows)):  # passed controls
            if used < rows[j][2]:
                stack.append([rows[j][0], used, rows[j][2]])
            j, used = j + 1, 0
        if i == len(rows):
            if frontier == current:
                frontier, j, used = current + 1, 0, 0
            current, i = current + 1, 0
            break
        score, treated, _ = rows[i]
        if taken == treated:
            i, taken = i + 1, 0
            continue
        while j < len(below) and used >= below[j][2]:
            j, used = j + 1, 0
        if j == len(below) and frontier + 1 < ranges:
            frontier, j, used = frontier + 1, 0, 0
            break
        if not stack and more:
            break
        left = score - below[j][0] if j < len(below) else np.inf
        right = stack[-1][0] - score if stack else np.inf
        gap = min(left, right)
        open_left |= not first and left == np.inf and gap > score - low
        open_right |= not last and right == np.inf and gap > high - score
        if gap == np.inf:
            i, taken = i + 1, 0
            continue
        own = [below[j][0], used, below[j][2]] if left <= right else stack[-1]
        n = min(treated - taken, own[2] - own[1])
        pairs.append((score, own[0], taken, own[1], n))
        taken += n
        if left <= right:
            used += n
        else:
            own[1] += n
            if own[1] == own[2]:
                stack.pop()
    return pairs, Place(current, i, taken, frontier, j, used, int(open_left), int(open_right))


def chained(table: DataFrame, ranges: list[int], piece_rows: int, first: bool, last: bool) -> tuple[DataFrame, bool, bool]:
    """Pairs (treated_score, control_score, t_from, c_from, n) of the ``ranges`` of a table (score, n_treated, n_control, _range),
    and whether a choice could go past the lower or upper end of them, which ``first`` and ``last`` say are ends of the axis."""
    spark = table.sparkSession
    store = read_node(spark, write_node(table.filter(F.col(RANGE).isin(ranges)).repartition(RANGE), fresh_node(spark, "ranges"), [RANGE]))
    low, high = store.agg(F.min("score"), F.max("score")).first()
    order = sorted(ranges, reverse=True)
    base, place, pieces, at = fresh_node(spark, "chain"), Place(), [], 0

    def rows_of(k: int, kind: str) -> DataFrame:
        own = store.filter(F.col(RANGE) == order[k])
        return own.select(F.lit(kind).alias("kind"), "score", F.col("n_treated").alias("one"), F.col("n_control").alias("two"))

    while place.current < len(order):
        parts = rows_of(place.current, "rows")
        if place.frontier < len(order) and place.frontier != place.current:
            parts = parts.unionByName(rows_of(place.frontier, "below"))
        if pieces:
            number, piece = pieces.pop()
            above = read_node(spark, f"{base}/step={number}").filter((F.col("kind") == STACK) & (F.col("piece") == piece))
            parts = parts.unionByName(above.select(F.lit("stack").alias("kind"), F.col("a").alias("score"), F.col("c").alias("one"), F.col("d").alias("two")))
        here, more = place, bool(pieces)

        def run(batches: Iterator[pd.DataFrame], here: Place = here, more: bool = more) -> Iterator[pd.DataFrame]:
            held = pd.concat([pd.DataFrame({"kind": [], "score": [], "one": [], "two": []}), *batches]).sort_values("score", ascending=False)
            sides = {}
            for kind in ("rows", "below", "stack"):
                own = held[held["kind"] == kind]
                sides[kind] = list(zip(own["score"].tolist(), own["one"].astype("int64").tolist(), own["two"].astype("int64").tolist()))
            stack = [list(s) for s in sides["stack"]]
            below = sides["rows"] if here.frontier == here.current else sides["below"]
            pairs, there = step(here, sides["rows"], below, stack, more, len(order), low, high, first, last)
            out = [
                (PAIR, 0, ts, cs, t0 + k, c0 + k, min(_CHUNK, n - k), None) for ts, cs, t0, c0, n in pairs for k in range(0, n, _CHUNK)
            ]
            out += [(STACK, k // piece_rows, s, None, u, t, None, None) for k, (s, u, t) in enumerate(stack)]
            numbers = [int(v) for v in vars(there).values()]
            out.append((PLACE, (len(stack) + piece_rows - 1) // piece_rows, None, None, None, None, None, numbers))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in _STEP.split(", ")])
            yield frame.astype({c: "Int64" for c in "cde"})

        parts.repartition(1).mapInPandas(run, _STEP).write.parquet(f"{base}/step={at}")
        row = read_node(spark, f"{base}/step={at}").filter(F.col("kind") == PLACE).first()
        place = replace(place, **dict(zip(vars(place), row["place"], strict=True)))
        pieces += [(at, k) for k in range(row["piece"])]
        at += 1
    done = spark.read.schema(_STEP).parquet(base).filter(F.col("kind") == PAIR)
    names = ("treated_score", "control_score", "t_from", "c_from", "n")
    pairs = done.select(*[F.col(c).alias(n) for c, n in zip("abcde", names)])
    return pairs, bool(place.open_left), bool(place.open_right)
