"""1:1 nearest-neighbour matching on a score, without replacement.

Treated units choose in descending order of their score, each the nearest control that is still free
(of two equally near ones the lower). Units with equal scores are interchangeable, so the choice is made
between distinct scores with counts. The score axis is cut into ranges that are worked off in parallel;
a range reports when a choice could have gone past its border, and only then are ranges merged and the
choice repeated. Ranges that together pass ``TASK_ROWS`` are not put into one task but worked off in a chain of
bounded steps. The result is that of the sequential rule, and the driver sees one row per range or step.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.operators.chained import chained
from natalis.operators.ordering import RANGE, number_rows, quantile_edges, with_range
from natalis.sources.store import cut_lineage

_ALLOCATED = (
    "segment int, open_left boolean, open_right boolean, treated_score double, control_score double, "
    "t_from long, c_from long, n long"
)
_CHUNK = 65_536
TASK_ROWS = 1 << 20  # distinct scores that a task holds at most


def allocate_range(
    score: Sequence[float], treated: Sequence[int], control: Sequence[int], first: bool, last: bool
) -> tuple[list[tuple[float, float, int, int, int]], bool, bool]:
    """Greedy choice among the distinct ``score`` values (ascending) of one range.

    Returns rows (treated score, control score, first treated no., first control no., pairs), and whether
    a better or the only free control could lie left or right of the range.
    """
    k = len(score)
    free = [int(c) for c in control]
    # below[i + 1] / above[i]: jump pointers to the next position with a free control
    below = [i + 1 if free[i] > 0 else i for i in range(k)]
    below.insert(0, 0)
    above = [i if free[i] > 0 else i + 1 for i in range(k)]
    above.append(k)

    def find(links: list[int], at: int) -> int:
        root = at
        while links[root] != root:
            root = links[root]
        while links[at] != root:
            links[at], at = root, links[at]
        return root

    rows, open_left, open_right = [], False, False
    low, high = score[0], score[-1]
    for i in range(k - 1, -1, -1):
        wanted, taken = int(treated[i]), 0
        while taken < wanted:
            left, right = find(below, i + 1) - 1, find(above, i)
            gap_left = score[i] - score[left] if left >= 0 else np.inf
            gap_right = score[right] - score[i] if right < k else np.inf
            gap = min(gap_left, gap_right)
            open_left |= not first and left < 0 and gap > score[i] - low
            open_right |= not last and right >= k and gap > high - score[i]
            if gap == np.inf:
                break
            pick = left if gap_left <= gap_right else right
            n = min(wanted - taken, free[pick])
            rows.append((score[i], score[pick], taken, int(control[pick]) - free[pick], n))
            taken += n
            free[pick] -= n
            if free[pick] == 0:
                below[pick + 1] = pick
                above[pick] = pick + 1
    return rows, open_left, open_right


def _merge(starts: list[int], marks: list[tuple[int, bool, bool]], reach: int) -> list[int]:
    """Drop the borders within ``reach`` segments on the open sides of the marked segments."""
    dropped = set()
    for segment, left, right in marks:
        if left:
            dropped.update(range(max(segment - reach + 1, 1), segment + 1))
        if right:
            dropped.update(range(segment + 1, min(segment + reach, len(starts) - 1) + 1))
    return [s for i, s in enumerate(starts) if i not in dropped]


def allocate(scores: DataFrame, parts: int | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Pairs between distinct scores for a table (score, n_treated, n_control).

    Ranges have about a quarter of ``task_rows`` distinct scores or fewer.
    """
    least = -(-4 * scores.count() // task_rows)
    parts = max(parts or int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 if parts is None else 1, least)
    edges = quantile_edges(scores, ["score"], parts)["score"]
    table = with_range(scores, "score", edges)
    rows_in = {r[0]: r[1] for r in table.groupBy(RANGE).count().collect()}
    present = starts = sorted(rows_in)
    reach = 1
    while True:
        numbers = [bisect_right(starts, r) - 1 for r in range(len(edges) + 1)]
        last_segment = len(starts) - 1
        ranges_of: dict[int, list[int]] = {}
        for r in present:
            ranges_of.setdefault(numbers[r], []).append(r)
        long = [s for s, own in ranges_of.items() if len(own) > 1 and sum(rows_in[r] for r in own) > task_rows]

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("score")
            segment = int(pdf["segment"].iloc[0])
            rows, left, right = allocate_range(
                pdf["score"].tolist(), pdf["n_treated"].tolist(), pdf["n_control"].tolist(),
                segment == 0, segment == last_segment,
            )
            out = [(segment, left, right, None, None, None, None, None)] if left or right else []
            out += [
                (segment, None, None, ts, cs, t0 + at, c0 + at, min(_CHUNK, n - at))
                for ts, cs, t0, c0, n in rows
                for at in range(0, n, _CHUNK)
            ]
            return pd.DataFrame(out, columns=[c.split()[0] for c in _ALLOCATED.split(", ")])

        segmented = table.withColumn("segment", F.lit(numbers)[F.col(RANGE)]).drop(RANGE)
        short = segmented.filter(~F.col("segment").isin(long)) if long else segmented
        pairs = cut_lineage(short.groupBy("segment").applyInPandas(choose, _ALLOCATED))
        marks = pairs.filter(F.col("treated_score").isNull()).select("segment", "open_left", "open_right").collect()
        marks = [tuple(m) for m in marks]
        chosen = pairs.filter(F.col("treated_score").isNotNull())
        chosen = chosen.select("treated_score", "control_score", "t_from", "c_from", "n")
        for segment in long:
            own, left, right = chained(table, ranges_of[segment], max(task_rows // 4, 1), segment == 0, segment == last_segment)
            chosen = chosen.unionByName(own)
            marks += [(segment, left, right)] if left or right else []
        if not marks:
            return chosen
        starts = _merge(starts, marks, reach)
        reach *= 2


def score_table(df: DataFrame, treated: str, score: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull() & F.col(treated).isin(0, 1)).groupBy(
        F.col(score).cast("double").alias("score")
    ).agg(
        F.count_if(F.col(treated) == 1).alias("n_treated"), F.count_if(F.col(treated) == 0).alias("n_control")
    )


def match_pairs(
    df: DataFrame, key: str, treated: str, score: str = "distance", parts: int | None = None
) -> DataFrame:
    """One row per pair: ``treated_id``, ``control_id`` and both scores.

    Units are numbered inside their score, and a pair row names the score and number of both partners, so
    both look-ups are joins on unique keys. Equal scores are ordered by a hash of the key.
    """
    units = df.select(key, treated, F.col(score).cast("double").alias("score")).filter(
        F.col("score").isNotNull() & F.col(treated).isin(0, 1)
    )
    units = cut_lineage(units)
    chosen = allocate(cut_lineage(score_table(units, treated, "score")), parts)
    single = chosen.select(
        "treated_score", "control_score", "t_from", "c_from", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("_i")
    ).select(
        "treated_score",
        "control_score",
        (F.col("t_from") + F.col("_i")).alias("t_no"),
        (F.col("c_from") + F.col("_i")).alias("c_no"),
    )
    numbered = number_rows(units, key, by=[treated, "score"], out="no")
    left = numbered.filter(F.col(treated) == 1).select(
        F.col("score").alias("treated_score"), F.col("no").alias("t_no"), F.col(key).alias("treated_id")
    )
    right = numbered.filter(F.col(treated) == 0).select(
        F.col("score").alias("control_score"), F.col("no").alias("c_no"), F.col(key).alias("control_id")
    )
    return (
        single.join(left, ["treated_score", "t_no"])
        .join(right, ["control_score", "c_no"])
        .select("treated_id", "control_id", "treated_score", "control_score")
    )


def matched_data(df: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Rows of both partners with ``weights`` 1 and the pair id ``subclass`` (the treated unit's key)."""
    members = pairs.select(
        F.explode(F.array("treated_id", "control_id")).alias(key), F.col("treated_id").alias("subclass")
    )
    return df.join(members, key, "inner").withColumn("weights", F.lit(1.0))


def with_ipw(df: DataFrame, treated: str, score: str = "distance", out: str = "weights") -> DataFrame:
    """Inverse-probability weight 1/e for treated and 1/(1 - e) for control units."""
    e = F.col(score)
    return df.withColumn(
        out, F.when(F.col(treated) == 1, F.try_divide(F.lit(1.0), e)).otherwise(F.try_divide(F.lit(1.0), 1 - e))
    )


def weighted_rates(df: DataFrame, treated: str, outcomes: Sequence[str], weight: str = "weights") -> DataFrame:
    """Weighted mean of each outcome by exposure, and their difference, one row per outcome."""
    sums = []
    for o in outcomes:
        for level in (0, 1):
            known = (F.col(treated) == level) & F.col(o).isNotNull()
            w = F.sum(F.when(known, F.col(weight)))
            sums.append(F.try_divide(F.sum(F.when(known, F.col(weight) * F.col(o))), w).alias(f"{o}|{level}"))
    row = df.agg(*sums)
    table = F.array(
        *[
            F.struct(
                F.lit(o).alias("outcome"),
                F.col(f"`{o}|1`").alias("rate_exposed"),
                F.col(f"`{o}|0`").alias("rate_unexposed"),
                (F.col(f"`{o}|1`") - F.col(f"`{o}|0`")).alias("difference"),
            )
            for o in outcomes
        ]
    )
    return row.select(F.explode(table).alias("r")).select("r.*")
