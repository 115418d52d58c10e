"""Hard negatives by exact integer inner products, several candidates to one multiplication.

Components become integers. The components of some hundred candidates are biased to be non-negative and laid into
separated fields of one wide integer per dimension, so that an anchor's component is multiplied once with all of
them; the sum over the dimensions holds every candidate's product in a field of its own, wide enough that none reaches
into the next. Taking the biases off gives exact scores.

Anchors and candidates meet in cells: blocks of anchors beside blocks of candidates, a bounded number of rows each,
whatever the number of rows of a label. A cell hands on its best few per anchor only. Positives need the cells of one
label; negatives need the anchors' positive scores first, and then the cells of all rows.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natalis.llm.shared import saved

ANCHORS_IN_CELL, ROWS_IN_CELL = 1024, 4096
FIELDS = 512  # candidates in one wide integer


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of components; shorter rows are filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dims), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class Packed:
    """Candidates in fields of wide integers, for anchors whose components lie between ``least`` and ``most``."""

    def __init__(self, values: np.ndarray, least: int, most: int):
        rows, dims = values.shape
        self.rows, self.shift = rows, max(0, -least)
        low = int(values.min(initial=0))
        self.bias, reach = max(0, -low), int(values.max(initial=0)) + max(0, -low)
        self.width = max(1, ((dims * reach * (max(0, most) + self.shift)).bit_length() + 7) // 8)
        if self.width > 8:
            raise ValueError("inner products of these components do not fit into 64 bits")
        sums = values.sum(axis=1) * np.int64(self.shift) + np.int64(dims * self.shift * self.bias)
        self.less = sums.astype(np.int64)
        whole = -(-rows // FIELDS) * FIELDS
        biased = np.zeros((whole, dims), "<u8")
        biased[:rows] = values + self.bias
        fields = biased.view(np.uint8).reshape(whole // FIELDS, FIELDS, dims, 8)[..., : self.width].transpose(0, 2, 1, 3)
        self.wide = [[int.from_bytes(one.tobytes(), "little") for one in group] for group in fields]

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner product of the anchor with every candidate."""
        biased = [a + self.shift for a in anchor]
        size = FIELDS * self.width
        raw = b"".join(sum(map(mul, biased, group)).to_bytes(size, "little") for group in self.wide)
        fields = np.zeros((len(raw) // self.width, 8), np.uint8)
        fields[:, : self.width] = np.frombuffer(raw, np.uint8).reshape(-1, self.width)
        return fields.view("<i8").ravel()[: self.rows] - self.less - np.int64(self.bias * sum(anchor))


def first_few(scores: np.ndarray, order: np.ndarray, allowed: np.ndarray, few: int) -> np.ndarray:
    """Places of the ``few`` largest allowed scores; ties by ``order``."""
    at = np.flatnonzero(allowed)
    if len(at) > few:
        at = at[scores[at] >= np.partition(scores[at], -few)[-few]]
    return at[np.lexsort((order[at], -scores[at]))[:few]]


def _met(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, Packed, np.ndarray]:
    """Anchors' components, packed candidates, and the candidates' places in the order of ids, NULL last."""
    dims = max(pc.max(pc.list_value_length(t["_parts"])).as_py() or 0 for t in (left, right))
    anchors, values = matrix(left["_parts"], dims), matrix(right["_parts"], dims)
    sorted_ = pc.sort_indices(right, [("_id", "ascending"), ("_row", "ascending")], null_placement="at_end").to_numpy()
    order = np.empty(len(sorted_), np.int64)
    order[sorted_] = np.arange(len(sorted_))
    return anchors, Packed(values, int(anchors.min(initial=0)), int(anchors.max(initial=0))), order


def _taken(table: pa.Table, column: str, at: np.ndarray) -> pa.Array:
    return table[column].combine_chunks().take(pa.array(at))


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _cells(anchors: DataFrame, rows: DataFrame, keys: list[str], fn, schema: T.StructType) -> DataFrame:
    """``fn`` on each cell; the number of tasks is fixed, as little data means much work here."""
    tasks = max(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 32)
    named = anchors.toDF(*(f"of{c}" for c in anchors.columns))  # both come from one table
    left = named.repartition(tasks, *(f"of{k}" for k in keys)).groupBy(*(f"of{k}" for k in keys))
    right = rows.repartition(tasks, *keys).groupBy(*keys)
    return left.cogroup(right).applyInArrow(lambda a, b: fn(a.rename_columns([c[2:] for c in a.column_names]), b), schema)


def _block(of: Column) -> Column:
    return F.pmod(F.xxhash64("_row"), of).cast("int")


def _all(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))


def _pieces(n: Column, size: int) -> Column:
    return F.greatest(F.ceil(n / size), F.lit(1))


def mined(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor row.

    A component x becomes floor(scale * x). An anchor's positives are its ``positives`` best other rows of its label; for
    each of them the result has the ``negatives`` best rows of other labels whose score lies between ``least_percent``
    and ``most_percent`` of the positive's. Higher scores come first, ties by smaller id, NULL ids last. Rows with a NULL
    label, a NULL vector or a NULL or non-finite component take no part. Rows with equal ids are different rows. Vectors
    of different lengths are compared as if filled up with zeros. Products beyond 64 bits are an error. An anchor
    without positives, and a positive without negatives, have no rows; an empty table gives none.
    """
    whole = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & whole).select(
        F.col(id_col).alias("_id"),
        F.col(label_col).alias("_label"),
        F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("_parts"),
        F.coalesce(anchor, F.lit(False)).alias("_anchor"),
    )
    rows = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    id_field = T.StructField("_id", rows.schema["_id"].dataType)
    long = T.LongType()

    # positives: the cells of one label
    sizes = rows.groupBy("_label").agg(F.count("*").alias("_n"), F.count_if("_anchor").alias("_m")).filter("_m > 0")
    sizes = sizes.select("_label", _pieces(F.col("_n"), ROWS_IN_CELL).alias("_splits"), _pieces(F.col("_m"), ANCHORS_IN_CELL).alias("_blocks"))
    sized = rows.join(sizes, "_label")
    keys = ["_label", "_block", "_split"]
    left = sized.filter("_anchor").select("_label", _block(F.col("_blocks")).alias("_block"), _all(F.col("_splits")).alias("_split"), "_row", "_parts")
    right = sized.select("_label", _all(F.col("_blocks")).alias("_block"), _block(F.col("_splits")).alias("_split"), "_row", "_id", "_parts")

    def same_label(anchors: pa.Table, others: pa.Table) -> pa.Table:
        at, score, found = [], [], []
        if anchors.num_rows and others.num_rows:
            values, packed, order = _met(anchors, others)
            own, row = anchors["_row"].to_numpy(), others["_row"].to_numpy()
            for i, parts in enumerate(values.tolist()):
                scores = packed.scores(parts)
                best = first_few(scores, order, row != own[i], positives)
                at.append(np.full(len(best), own[i]))
                score.append(scores[best])
                found.append(best)
        best = _joined(found).astype(np.int64)
        return pa.table([pa.array(_joined(at)), pa.array(_joined(score)), _taken(others, "_id", best), _taken(others, "_row", best)], ["_at", "_score", "_id", "_row"])

    near = _cells(left, right, keys, same_label, T.StructType([T.StructField("_at", long), T.StructField("_score", long), id_field, T.StructField("_row", long)]))
    ordered = [F.col("_score").desc(), F.col("_id").asc_nulls_last(), "_row"]
    near = near.withColumn("_rank", F.row_number().over(Window.partitionBy("_at").orderBy(*ordered))).filter(F.col("_rank") <= positives)
    near = near.groupBy("_at").agg(F.sort_array(F.collect_list(F.struct("_rank", "_score", "_id"))).alias("_near"))
    near = saved(near, "positives")

    # negatives: the cells of all rows
    counts = rows.agg(F.count("*").alias("_n"), F.count_if("_anchor").alias("_m")).first()
    splits, blocks = max(1, -(-counts["_n"] // ROWS_IN_CELL)), max(1, -(-counts["_m"] // ANCHORS_IN_CELL))
    left = rows.filter("_anchor").join(near, F.col("_row") == F.col("_at"))
    left = left.select(_block(F.lit(blocks)).alias("_block"), _all(F.lit(splits)).alias("_split"), "_at", F.col("_id").alias("_anchor_id"), "_label", "_parts", "_near")
    right = rows.select(_all(F.lit(blocks)).alias("_block"), _block(F.lit(splits)).alias("_split"), "_row", "_id", "_label", "_parts")

    def other_labels(anchors: pa.Table, others: pa.Table) -> pa.Table:
        whose, rank, score, found = [], [], [], []
        if anchors.num_rows and others.num_rows:
            values, packed, order = _met(anchors, others)
            both = pa.chunked_array([*anchors["_label"].chunks, *others["_label"].chunks]).combine_chunks()
            code = both.dictionary_encode().indices.to_numpy()
            mine, theirs = code[: anchors.num_rows], code[anchors.num_rows :]
            for i, (parts, near) in enumerate(zip(values.tolist(), anchors["_near"].to_pylist(), strict=True)):
                scores, other = packed.scores(parts), theirs != mine[i]
                for one in near:
                    least, most = -(-least_percent * one["_score"] // 100), most_percent * one["_score"] // 100
                    best = first_few(scores, order, other & (scores >= least) & (scores <= most), negatives)
                    whose.append(np.full(len(best), i))
                    rank.append(np.full(len(best), one["_rank"] - 1))
                    score.append(scores[best])
                    found.append(best)
        who, best, slot = (_joined(x).astype(np.int64) for x in (whose, found, rank))
        pos = anchors["_near"].combine_chunks()
        at = pa.array(np.asarray(pos.offsets)[who] + slot if len(who) else who)
        return pa.table(
            [
                _taken(anchors, "_at", who),
                _taken(anchors, "_anchor_id", who),
                pa.array(slot.astype(np.int32)),
                pc.struct_field(pos.values, "_id").take(at),
                pc.struct_field(pos.values, "_score").take(at),
                _taken(others, "_id", best),
                pa.array(_joined(score)),
                _taken(others, "_row", best),
            ],
            hard.names,
        )

    hard = T.StructType(
        [
            T.StructField("_at", long),
            T.StructField("anchor_id", id_field.dataType),
            T.StructField("_slot", T.IntegerType()),
            T.StructField("positive_id", id_field.dataType),
            T.StructField("positive_score", long),
            id_field,
            T.StructField("_score", long),
            T.StructField("_row", long),
        ]
    )
    far = _cells(left, right, ["_block", "_split"], other_labels, hard)
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("_at", "_slot").orderBy(*ordered))).filter(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", F.col("_id").alias("negative_id"), "positive_score", F.col("_score").alias("negative_score"))
