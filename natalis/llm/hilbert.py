"""Shards cut along a Hilbert curve through several metadata columns.

Each column is cut into cells of about equally many rows: its whole values are counted, and a value's cell is the share of
rows below it. The cell numbers are the coordinates of a point, and rows are ordered by the point's place
on a Hilbert curve, so a run of rows covers a small box in all columns at once and files can be skipped by any of
them. The order is cut into shards whose row counts differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natalis.llm.shared import saved

BITS = 5
SHARDS = 24


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows, dimensions) with coordinates below ``2 ** bits``.

    The coordinates are turned into the transposed index by undoing, from the highest bit down, the reflections
    and swaps of the curve's corners, and then by Gray coding; the bits of all dimensions are interleaved.
    """
    x = [c.astype(np.int64).copy() for c in cells.T]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            high = x[i] >> level & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            place = place << 1 | ((c ^ flip) >> level & 1)
    return place


def _ranges(df: DataFrame, sort: Sequence[str]) -> DataFrame:
    """Rows sorted inside ranges of the order, which ``_range`` numbers."""
    parts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).withColumn("_range", F.spark_partition_id())


def _ahead(table: DataFrame, measure: Column) -> DataFrame:
    """(_range, _ahead): the measure's sum over all earlier ranges; one row per range."""
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = table.groupBy("_range").agg(measure.alias("_n"))
    return sums.select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))


def quantised(df: DataFrame, column: str, out: str, bits: int = BITS) -> DataFrame:
    """``df`` with the cell of each row, from 0 up to ``2 ** bits - 1``: the share of rows with smaller values.

    Values are counted whole, so the cell depends on the table only. NULL is in cell 0 and not among the rows counted.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    ranged = saved(_ranges(counts, ["_v"]), "values")
    total = ranged.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    inside = Window.partitionBy("_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(_ahead(ranged, F.sum("_n")), "_range")
    below = F.col("_ahead") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    cell = F.expr(f"_below * {1 << bits} div {max(total, 1)}").cast("int")
    cells = placed.withColumn("_below", below).select("_v", cell.alias("_cell"))
    joined = df.join(cells, F.col(column) == F.col("_v"), "left")
    return joined.withColumn(out, F.coalesce("_cell", F.lit(0))).drop("_v", "_cell")


def curve_order(df: DataFrame, columns: Sequence[str], key: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``_curve`` (place on the curve) and ``_rank`` (gapless from 0 in the order of curve and key).

    Rows are sorted in ranges and numbered inside them as they stream by; the ranges' counts are then added up.
    A place on the curve that holds many rows is cut by the key like any other range.
    """
    cells = [f"_cell_{i}" for i in range(len(columns))]
    for column, cell in zip(columns, cells, strict=True):
        df = quantised(df, column, cell, bits)

    @F.pandas_udf("bigint")
    def place(points: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.array(points.tolist(), np.int64).reshape(-1, len(columns)), bits))

    placed = df.withColumn("_curve", place(F.array(*cells))).drop(*cells)
    ranged = _ranges(placed, ["_curve", *key])

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = 0
        for batch in batches:
            batch["_in"] = np.arange(done, done + len(batch))
            done += len(batch)
            yield batch

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", _in bigint"
    numbered = saved(ranged.mapInPandas(number, schema), "curve")
    starts = _ahead(numbered, F.count("*"))
    return numbered.join(starts, "_range").withColumn("_rank", F.col("_ahead") + F.col("_in")).drop("_range", "_in", "_ahead")


def shards(
    docs: DataFrame,
    columns: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    count: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """(id, size, text_crc32, curve, shard, slot): shard and place in it of every document.

    The size is that of the text in UTF-8, 8 bytes more, and a NULL text is empty. Row counts of two shards differ
    by one at most; with fewer rows than shards some stay empty. NULL metadata go to the first cell. Repeated rows
    take places of their own. ``columns`` may name columns of ``docs`` or ``size``.
    """
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    slim = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(data) + 8).cast("long").alias("_size"),
        F.crc32(data).alias("_crc"),
        *[F.col(c).alias(f"_dim_{i}") for i, c in enumerate(columns) if c != "size"],
    )
    dims = ["_size" if c == "size" else f"_dim_{i}" for i, c in enumerate(columns)]
    slim = saved(slim, "metadata")
    total = slim.count()
    ranked = curve_order(slim, dims, ["_id", "_crc"], bits)
    shard = F.expr(f"_rank * {count} div {max(total, 1)}")
    first = F.expr(f"(_shard * {max(total, 1)} + {count - 1}) div {count}")
    return ranked.withColumn("_shard", shard).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_curve").alias("curve"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - first).alias("slot"),
    )
