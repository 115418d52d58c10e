"""Exact k nearest neighbours of a table with itself, or of each group with itself, without comparing all pairs.

The points of a group are cut into regions of a bounded number of bytes, along the coordinate that varies most in a bounded
draw of them; which edges are drawn steers the balance, never the result. A region becomes one row with its points in
the order of a k-d tree, so that every few hundred points share a small box. Its points are first compared with their own
region, which bounds the distance of the k-th neighbour; the boxes then leave out the regions that cannot hold a nearer
point, and inside the others the leaves that cannot. What is left is compared by matrix products, whose rounding is allowed
for, and the few points that remain get their distance in full. All groups share the same joins: the plan does not
depend on their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natalis.sources.store import cut_lineage

_REGION_BYTES = 8 << 20  # coordinates of a region
_BLOCK = 1 << 16  # points of a region at most
_LEAF = 512  # points that share a box, and queries compared at once
_CELLS = 1 << 20  # entries of a matrix product
_FAN = 64
_DRAWN = 2_000  # points drawn on average to choose the edges of a region from
_SPREAD = 32  # tasks that share the points of a large region while it is cut
_MEMBERS = 16  # regions that a task compares one region with
_TASK_PAIRS = 1 << 29
_SLACK = 1e-9


# --- one region ------------------------------------------------------------------------------------


def _tree_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points in which each leaf of a k-d tree is a run, and the ends of the runs."""
    order, ends, open_ = np.arange(len(x)), [], [(0, len(x))]
    while open_:
        first, stop = open_.pop()
        own = order[first:stop]
        spread = np.ptp(x[own], axis=0) if stop - first > _LEAF else np.zeros(1)
        if not spread.any():
            # points that cannot be told apart are cut anywhere
            ends += [*range(first + _LEAF, stop, _LEAF), stop]
            continue
        value = x[own, int(np.argmax(x[own].var(axis=0) * (spread > 0)))]
        edge = np.median(value)
        low = value <= edge if edge < value.max() else value < edge
        order[first:stop] = np.concatenate((own[low], own[~low]))
        middle = first + int(low.sum())
        open_ += [(middle, stop), (first, middle)]
    return order, np.array(ends, np.int64)


@dataclass
class _Region:
    """Points in tree order, the boxes of their leaves."""

    pid: np.ndarray
    x: np.ndarray
    ends: np.ndarray

    def __post_init__(self) -> None:
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.low = np.minimum.reduceat(self.x, self.starts)
        self.high = np.maximum.reduceat(self.x, self.starts)


@dataclass
class _Asking:
    """Points that ask for neighbours, in leaves, and the best found so far: d2 (inf: none), id, found elsewhere."""

    region: _Region
    at: np.ndarray  # places in the region, ascending
    d2: np.ndarray
    nid: np.ndarray
    new: np.ndarray

    @classmethod
    def of(cls, region: _Region, asked: np.ndarray, k: int) -> _Asking:
        shape = (int(asked.sum()), k)
        return cls(region, np.flatnonzero(asked), np.full(shape, np.inf), np.full(shape, -1, np.int64), np.zeros(shape, bool))

    def compare(self, members: _Region, new: bool) -> None:
        """Take the nearer points of ``members`` in, by (distance, id) and without the point itself."""
        mean = self.region.x.mean(axis=0)
        q, x = self.region.x - mean, members.x - mean
        norm_q, norm_x = (q * q).sum(axis=1), (x * x).sum(axis=1)
        kind = np.float32 if max(norm_q.max(), norm_x.max()) < 1e30 else np.float64
        # rounding of the coordinates, the products and their sums, with room
        unit = 8 * float(np.finfo(kind).eps) * (x.shape[1] + 8)
        sides = np.append(q * -2, np.ones((len(q), 1)), axis=1).astype(kind), np.append(x, norm_x[:, None], axis=1).astype(kind)
        cuts = np.searchsorted(self.at, self.region.ends)
        for leaf, (first, stop) in enumerate(zip(np.append(0, cuts[:-1]).tolist(), cuts.tolist(), strict=True)):
            if first == stop:
                continue
            own, k = self.at[first:stop], self.d2.shape[1]
            gap = np.maximum(np.maximum(members.low - self.region.high[leaf], self.region.low[leaf] - members.high), 0)
            gap = (gap * gap).sum(axis=1)
            bound = self.d2[first:stop, -1]
            if not new:
                # the k nearest others in the own leaf are a first bound
                side = slice(self.region.starts[leaf], self.region.ends[leaf])
                if side.stop - side.start > k:
                    near = np.partition(sides[0][own] @ sides[1][side].T, k, axis=1)[:, k].astype(float)
                    bound = near + norm_q[own] + 2 * unit * (norm_q[own] + norm_x[side].max())
            nearest_first = np.argsort(gap, kind="stable")
            for run in self._runs(members, nearest_first[gap[nearest_first] <= bound.max() * (1 + _SLACK)], gap, stop - first):
                if gap[run[0]] > bound.max() * (1 + _SLACK):
                    break
                places = np.concatenate([np.arange(members.starts[m], members.ends[m]) for m in run])
                most = norm_q[own] + norm_x[places].max()
                least = bound - norm_q[own] + unit * (most + np.where(np.isfinite(bound), bound, 0))
                i, j = np.nonzero(sides[0][own] @ sides[1][places].T <= least.astype(kind)[:, None])
                self._take(first, i, places[j], members, new)
                bound = np.minimum(bound, self.d2[first:stop, -1])

    @staticmethod
    def _runs(members: _Region, leaves: np.ndarray, gap: np.ndarray, queries: int) -> Iterator[np.ndarray]:
        """Leaves in order, as many at once as a product of bounded size has room for."""
        held = np.cumsum((members.ends - members.starts)[leaves]) // max(_LEAF, _CELLS // queries)
        for part in np.split(leaves, np.flatnonzero(np.diff(held)) + 1):
            if len(part):
                yield part

    def _take(self, first: int, i: np.ndarray, place: np.ndarray, members: _Region, new: bool) -> None:
        """Candidate pairs (query, place of a member): their full distance, then the best of these and those held."""
        nid, row = members.pid[place], self.at[first + i]
        other = nid != self.region.pid[row]
        i, nid, row, place = i[other], nid[other], row[other], place[other]
        d2 = np.empty(len(i))
        step = max(1, _CELLS // members.x.shape[1])
        for at in range(0, len(i), step):
            d2[at : at + step] = ((self.region.x[row[at : at + step]] - members.x[place[at : at + step]]) ** 2).sum(axis=1)
        keep = (d2 <= self.d2[first + i, -1]) & np.isfinite(d2)
        i, nid, d2 = i[keep], nid[keep], d2[keep]
        if not len(i):
            return
        k, touched = self.d2.shape[1], np.unique(i)
        i = np.concatenate((i, np.repeat(touched, k)))
        d2 = np.concatenate((d2, self.d2[first + touched].ravel()))
        nid = np.concatenate((nid, self.nid[first + touched].ravel()))
        fresh = np.concatenate((np.full(len(keep[keep]), new), self.new[first + touched].ravel()))
        order = np.lexsort((nid, d2, i))
        begin = np.searchsorted(i[order], touched)
        best = order[begin[:, None] + np.arange(k)]
        self.d2[first + touched], self.nid[first + touched], self.new[first + touched] = d2[best], nid[best], fresh[best]

    def found(self, new: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pid, nid, d2) of the best that were found in this region, or elsewhere."""
        row, column = np.nonzero(np.isfinite(self.d2) & (self.new == new))
        return self.region.pid[self.at[row]], self.nid[row, column], self.d2[row, column]


# --- the table -------------------------------------------------------------------------------------


def _edges(cell: pd.DataFrame, most: int) -> tuple[int, list[float]]:
    """The coordinate that varies most in the drawn points of a region, and edges that cut it; no edges for equal points."""
    x = np.stack(cell["x"].to_list())
    spread = np.ptp(x, axis=0)
    dim = int(np.argmax(x.var(axis=0) * (spread > 0)))
    parts = int(min(_FAN, np.ceil(2 * cell["n"].iloc[0] / most)))
    value = np.sort(x[:, dim])
    edges = np.unique(value[np.arange(1, parts) * len(value) // parts])
    edges = edges[edges < value[-1]]
    return dim, edges.tolist() if len(edges) or not spread.any() else [float(value[0])]


def _cut(points: DataFrame, keys: list[str], most: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Points with the region (``node``) they are in, of at most ``most`` points each, and the sizes ``n`` of the regions."""
    placed, level, cell = cut_lineage(points.withColumn("node", F.lit(""))), 0, [*keys, "node"]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in placed.dtypes if c in cell), "dim int, edges array<double>"])

    def edges_of(drawn: pd.DataFrame) -> pd.DataFrame:
        dim, edges = _edges(drawn, most)
        out = drawn[cell].iloc[:1].copy()
        out["dim"], out["edges"] = dim, [edges]
        return out if edges else out.iloc[:0]

    salt = F.pmod(F.xxhash64("pid", F.lit(seed)), F.lit(_SPREAD)).cast("int")
    while True:
        sizes = cut_lineage(placed.groupBy(*cell).agg(F.count("*").alias("n")))
        large = sizes.filter(F.col("n") > most)
        # a few rows for each large region, met by the points in several tasks
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1)))
        drawn = F.pmod(F.xxhash64("pid", F.lit(seed + level + 1)), F.lit(1 << 30)) * F.col("n") < F.lit(float(_DRAWN << 30))
        some = placed.withColumn("salt", salt).join(large.withColumn("salt", everywhere), [*cell, "salt"]).filter(drawn)
        edges = cut_lineage(some.select(*cell, "n", "x").groupBy(*cell).applyInPandas(edges_of, schema))
        if edges.isEmpty():
            return placed, sizes
        split = placed.withColumn("salt", salt).join(edges.withColumn("salt", everywhere), [*cell, "salt"], "left")
        part = F.size(F.filter("edges", lambda e: e < F.col("x")[F.col("dim")]))
        child = F.when(F.col("dim").isNull(), F.col("node")).otherwise(F.concat_ws(".", "node", part.cast("string")))
        placed, level = cut_lineage(split.select(*keys, "pid", "x", "asked", child.alias("node"))), level + 1


_PACKED = ("pid", "x", "ends", "at", "d2", "nid")


def _unpacked(row: dict, k: int) -> _Asking:
    numbers = {c: np.frombuffer(row[c], "<f8" if c in ("x", "d2") else "<i8") for c in _PACKED if row[c] is not None}
    region = _Region(numbers["pid"], numbers["x"].reshape(len(numbers["pid"]), -1), numbers["ends"])
    if "at" not in numbers:
        return _Asking.of(region, np.zeros(len(region.pid), bool), k)
    shape = (len(numbers["at"]), k)
    d2, nid = numbers["d2"].reshape(shape).copy(), numbers["nid"].reshape(shape).copy()
    return _Asking(region, numbers["at"], d2, nid, np.zeros(shape, bool))


def _gap(low: str, high: str, to_low: str, to_high: str) -> Column:
    """Squared distance of two boxes."""
    apart = F.zip_with(
        F.zip_with(to_low, high, lambda a, b: a - b), F.zip_with(low, to_high, lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0))
    )
    return F.aggregate(apart, F.lit(0.0), lambda total, v: total + v * v)


def nearest(points: DataFrame, k: int, seed: int = 42, by: Sequence[str] = (), asked: Column | None = None) -> DataFrame:
    """Rows (by, pid, nid, d2, rank) for a table (by, pid long, x array<double>) with unique ``pid`` in each ``by`` group.

    The k nearest other points of the group come in the order of (distance, id); a smaller group has fewer. With ``asked``
    only the points for which it is true get neighbours, among all points of their group. Points with a coordinate that
    is not finite have no distances. Equal points should be handled once by the caller: points that cannot be told
    apart stay in one region, however many they are.
    """
    by = list(by)
    keys = [f"_by{i}" for i in range(len(by))]
    cell = [*keys, "node"]
    wanted = (F.lit(True) if asked is None else F.coalesce(asked, F.lit(False))).alias("asked")
    named = points.select(*[F.col(b).alias(key) for b, key in zip(by, keys)], "pid", "x", wanted)
    limit = F.lit(float("inf"))
    named = cut_lineage(named.filter(F.forall("x", lambda v: (v < limit) & (v > -limit))))
    one = named.select(F.size("x").alias("width")).first()
    width = max(1, one["width"]) if one else 1
    placed, sizes = _cut(named, keys, min(_BLOCK, max(64, _REGION_BYTES // (8 * width))), seed)
    kinds = dict(placed.dtypes)
    own = ", ".join(f"`{c}` {kinds[c]}" for c in cell)
    least = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def tasks(work: DataFrame) -> int:
        """Enough tasks for a bounded number of pairs of points each on average; ``work`` has such numbers in ``n``."""
        return min(max(least, int((work.agg(F.sum("n")).first()[0] or 0) / _TASK_PAIRS)), 4096)


    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["x"].to_list())
        order, ends = _tree_order(x)
        region = _Region(rows["pid"].to_numpy()[order], np.ascontiguousarray(x[order]), ends)
        asking = _Asking.of(region, rows["asked"].to_numpy(bool)[order], k)
        asking.compare(region, new=False)
        out = rows[cell].iloc[:1].copy()
        arrays = (region.pid, region.x, region.ends, asking.at, asking.d2, asking.nid)
        for name, values in zip(_PACKED, arrays, strict=True):
            out[name] = [np.ascontiguousarray(values).tobytes()]
        out["low"], out["high"] = [region.low.min(axis=0)], [region.high.max(axis=0)]
        out["reach"] = asking.d2[:, -1].max() if len(asking.at) else -1.0
        out["n"] = len(x)
        return out

    schema = f"{own}, {', '.join(f'{c} binary' for c in _PACKED)}, low array<double>, high array<double>, reach double, n long"
    dealt = placed.repartition(tasks(sizes.select((F.col("n").cast("double") * F.col("n")).alias("n"))), *cell)
    whole = cut_lineage(dealt.groupBy(*cell).applyInPandas(packed, schema))

    def rows_of(asking: _Asking, row: pa.RecordBatch, new: bool) -> pa.RecordBatch:
        found = asking.found(new)
        first = pa.array(np.zeros(len(found[0]), np.int64))
        columns = [row.column(key).take(first) for key in keys]
        return pa.record_batch([*columns, *(pa.array(v) for v in found)], [*keys, "pid", "nid", "d2"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (batch.slice(at, 1) for at in range(batch.num_rows))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in single(batches):
            yield rows_of(_unpacked(row.to_pylist()[0], k), row, new=False)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of regions in order: one that asks, then those it is compared with."""
        asking, head = None, None
        for one in single(batches):
            row = one.to_pylist()[0]
            if row["step"]:
                asking.compare(_unpacked(row, k).region, new=True)
                continue
            if asking is not None:
                yield rows_of(asking, head, new=True)
            asking, head = _unpacked(row, k), one.select(keys)
        if asking is not None:
            yield rows_of(asking, head, new=True)

    columns = ", ".join([*(f"`{key}` {kinds[key]}" for key in keys), "pid long, nid long, d2 double"])
    best = whole.select(*keys, *_PACKED).mapInArrow(listed, columns)
    boxes = whole.select(*cell, "low", "high", "reach", "n")
    if not sizes.filter(F.col("node") != "").isEmpty():
        others = boxes.select(*keys, *[F.col(c).alias(f"to_{c}") for c in ("node", "low", "high", "n")])
        pairs = boxes.join(others, keys) if keys else boxes.crossJoin(others)
        pairs = pairs.withColumn("gap", _gap("low", "high", "to_low", "to_high"))
        pairs = pairs.filter((F.col("node") != F.col("to_node")) & (F.col("gap") <= F.col("reach") * (1 + _SLACK)))
        place = F.row_number().over(Window.partitionBy(*cell).orderBy("gap", "to_node"))
        pairs = pairs.withColumn("n", F.col("n").cast("double") * F.col("to_n"))
        pairs = pairs.select(*cell, "to_node", "n", place.alias("step"), F.floor((place - 1) / _MEMBERS).cast("int").alias("part"))
        pairs = cut_lineage(pairs)
        job = [*cell, "part"]
        jobs = pairs.select(*job).distinct()
        none = [F.lit(None).cast("binary").alias(c) for c in _PACKED[3:]]
        asks = jobs.join(whole, cell).select(*job, F.lit(0).alias("step"), *_PACKED)
        told = whole.select(*keys, F.col("node").alias("to_node"), *_PACKED[:3])
        told = pairs.join(told, [*keys, "to_node"]).select(*job, "step", *_PACKED[:3], *none)
        spread = asks.unionByName(told).repartition(tasks(pairs), *job)
        best = best.unionByName(spread.sortWithinPartitions(*job, "step").mapInArrow(met, columns))
    ranked = Window.partitionBy(*keys, "pid").orderBy("d2", "nid")
    best = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select(*[F.col(key).alias(b) for b, key in zip(by, keys)], "pid", "nid", "d2", "rank")
