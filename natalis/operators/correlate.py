"""Pairwise-complete Pearson correlation of many columns from one scan.

Columns are cut into tiles. A pair of tiles is the unit of work: its sums are a few tile x tile matrices however wide
the table is. If one tile holds all columns, every task adds up its own rows and no row is shuffled. Otherwise slices
of rows go to each pair of tiles that needs them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_MOMENTS = "i int, j int, n double, mx double, my double, vx double, vy double, c double"
_SLICES = "a int, b int, part int, x binary, y binary"
#: columns of a tile, and rows that go to a pair of tiles at once: 1 MB a tile, 12 MB of sums a pair
TILE, SLICE_ROWS = 512, 256


class _TileSums:
    """Counts, sums and products of the columns of two tiles.

    A column's values are shifted by the mean of the first rows that have it, so that large means cannot swamp the
    variance. Before these rows its sums are zero whatever the shift.
    """

    def __init__(self, columns_x: int, columns_y: int) -> None:
        self.shift = np.full(columns_x, np.nan), np.full(columns_y, np.nan)
        self.sums = np.zeros((6, columns_x, columns_y))

    @staticmethod
    def _shifted(values: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """0/1 of the values present, and the values less the shift, 0 where absent; completes ``shift`` in place."""
        seen = ~np.isnan(values)
        counts = seen.sum(axis=0)
        new = np.isnan(shift) & (counts > 0)
        shift[new] = np.where(seen[:, new], values[:, new], 0.0).sum(axis=0) / counts[new]
        return seen.astype("float64"), np.where(seen, values - shift, 0.0)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        (in_x, x), (in_y, y) = self._shifted(x, self.shift[0]), self._shifted(y, self.shift[1])
        for total, left, right in zip(self.sums, (in_x, x, in_x, x * x, in_x, x), (in_y, in_y, y, in_y, y * y, y)):
            total += left.T @ right

    def rows(self, first_x: int, first_y: int) -> pd.DataFrame:
        """A row per column pair i < j, where the tiles start at columns ``first_x`` and ``first_y``."""
        i, j = np.indices(self.sums.shape[1:])
        upper = i + first_x < j + first_y
        i, j = i[upper], j[upper]
        n, sx, sy, sxx, syy, sxy = (s[upper] for s in self.sums)
        k, (shift_x, shift_y) = np.maximum(n, 1.0), (np.nan_to_num(s) for s in self.shift)
        return pd.DataFrame(
            {
                "i": (i + first_x).astype("int32"),
                "j": (j + first_y).astype("int32"),
                "n": n,
                "mx": sx / k + shift_x[i],
                "my": sy / k + shift_y[j],
                "vx": np.maximum(sxx - sx * sx / k, 0.0),
                "vy": np.maximum(syy - sy * sy / k, 0.0),
                "c": sxy - sx * sy / k,
            }
        )


def _numbers(batch: pd.DataFrame) -> np.ndarray:
    return batch.to_numpy(dtype="float64", na_value=np.nan)


def _own_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moments of a task's rows when all columns are one tile."""
    sums = None
    for batch in batches:
        x = _numbers(batch)
        sums = sums or _TileSums(x.shape[1], x.shape[1])
        sums.add(x, x)
    if sums is not None:
        yield sums.rows(0, 0)


def _tile_moments(numeric: DataFrame, tile: int) -> DataFrame:
    """Moments of each pair of tiles, a row per column pair and part.

    A row of the shuffle holds a slice of both tiles, so slices need not meet in a join. All slices of an input task
    go to one part of a pair, and a retried task with another order of rows changes nothing.
    """
    width = len(numeric.columns)
    starts = range(0, width, tile)
    pairs = len(starts) * (len(starts) + 1) // 2
    parts = -(-int(numeric.sparkSession.conf.get("spark.sql.shuffle.partitions")) // pairs)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() % parts
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                x = _numbers(batch.iloc[at : at + SLICE_ROWS])
                cut = [np.ascontiguousarray(x[:, s : s + tile]).tobytes() for s in starts]
                for a, own in enumerate(cut):
                    others = [(a, b, part, own, cut[b] if b > a else b"") for b in range(a, len(cut))]
                    yield pd.DataFrame(others, columns=["a", "b", "part", "x", "y"])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sums = None, None
        for batch in batches:
            for a, b, part, left, right in batch.itertuples(index=False, name=None):
                x = np.frombuffer(left).reshape(-1, min(tile, width - a * tile))
                y = np.frombuffer(right).reshape(len(x), -1) if b > a else x
                if (a, b, part) != key:
                    if sums is not None:
                        yield sums.rows(key[0] * tile, key[1] * tile)
                    key, sums = (a, b, part), _TileSums(x.shape[1], y.shape[1])
                sums.add(x, y)
        if sums is not None:
            yield sums.rows(key[0] * tile, key[1] * tile)

    slices = numeric.mapInPandas(spread, _SLICES).repartition(pairs * parts, "a", "b", "part")
    return slices.sortWithinPartitions("a", "b", "part").mapInPandas(fold, _MOMENTS)


def pair_moments(df: DataFrame, columns: Sequence[str], tile: int = TILE) -> DataFrame:
    """Count, means and deviations of every column pair i < j over the rows where both are present.

    A task holds the sums of one pair of tiles of at most ``tile`` columns each. The moments of all tasks are
    merged by pair: the common means first, then the deviations from them.
    """
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    moments = numeric.mapInPandas(_own_rows, _MOMENTS) if len(columns) <= tile else _tile_moments(numeric, tile)
    pair = Window.partitionBy("i", "j")
    mean = lambda m: F.coalesce(F.try_divide(F.sum(F.col("n") * F.col(m)).over(pair), F.sum("n").over(pair)), F.lit(0.0))
    dx, dy, n = F.col("mx") - F.col("_x"), F.col("my") - F.col("_y"), F.col("n")
    return moments.withColumns({"_x": mean("mx"), "_y": mean("my")}).groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        F.max("_x").alias("mx"),
        F.max("_y").alias("my"),
        F.sum(F.col("vx") + n * dx * dx).alias("vx"),
        F.sum(F.col("vy") + n * dy * dy).alias("vy"),
        F.sum(F.col("c") + n * dx * dy).alias("c"),
    )


def correlations(df: DataFrame, columns: Sequence[str], digits: int | None = None, tile: int = TILE) -> DataFrame:
    """Long upper triangle (feature_a, feature_b, n, r); r is NULL when a column is constant.

    Before it is rounded to ``digits``, r is rounded to twelve, so that ties do not hang on the order of a sum.
    """
    names = F.array(*[F.lit(c) for c in columns])
    r = F.try_divide(F.col("c"), F.sqrt("vx") * F.sqrt("vy"))
    r = F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)
    return pair_moments(df, columns, tile).select(
        names[F.col("i")].alias("feature_a"),
        names[F.col("j")].alias("feature_b"),
        F.col("n").cast("long").alias("n"),
        (F.round(F.round(r, 12), digits) if digits is not None else r).alias("r"),
    )


def correlated_columns(corr: DataFrame, threshold: float = 0.90) -> DataFrame:
    """Later columns of pairs with |r| above the threshold: the drop list."""
    return corr.filter(F.abs("r") > threshold).select(F.col("feature_b").alias("feature")).distinct()


def drop_correlated(df: DataFrame, columns: Sequence[str], threshold: float = 0.90) -> DataFrame:
    dropped = [r["feature"] for r in correlated_columns(correlations(df, columns), threshold).collect()]
    return df.drop(*dropped)
