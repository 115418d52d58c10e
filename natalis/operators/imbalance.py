"""Synthetic minority over-sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from natalis.functions.columns import hash_uniform
from natalis.operators.filters import complete_rows
from natalis.operators.neighbours import nearest
from natalis.operators.ordering import number_rows, running_totals
from natalis.sources.store import cut_lineage

_CHUNK = 10_000


def _synthetic(rows: DataFrame, features: Sequence[str], by: Sequence[str], k: int, seed: int) -> DataFrame:
    """The new points of every class that is smaller than the largest, between its rows and their neighbours.

    Equal rows are handled once, with their number: a row's nearest neighbours are first its own copies,
    then other value patterns by distance, each as often as it occurs. New points are spread evenly over
    the rows, and which neighbour and how far along is a hash of the pattern and the copy number.
    """
    by = list(by)
    # names of its own, so that no class column meets a working column
    keys = [f"_c{i}" for i in range(len(by))]
    vector = F.expr("array(" + ", ".join(f"CAST(`{f}` AS DOUBLE)" for f in features) + ") AS x")
    rows = rows.select(*[F.col(b).alias(c) for b, c in zip(by, keys)], *features)
    # counted once: the classes and the points both start from here
    patterns = cut_lineage(rows.groupBy(*keys, *features).agg(F.count("*").alias("m")))
    classes = cut_lineage(patterns.groupBy(*keys).agg(F.sum("m").alias("n")))
    largest = classes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    classes = classes.filter(F.col("n") < largest).select(
        *keys,
        F.least(F.lit(k).cast("long"), F.col("n") - 1).alias("k"),
        F.expr(f"({largest} - n) div n").alias("each"),
        F.expr(f"({largest} - n) % n").alias("rest"),
    )
    points = patterns.select(*keys, "m", vector).join(classes.select(*keys), keys, "left_semi")
    # numbered in an order that any engine can state: the digest of the values in millionths
    text = F.array_join(F.transform("x", lambda v: F.round(v * 1_000_000).cast("bigint").cast("string")), "|")
    named = cut_lineage(points.withColumn("_text", text))
    patterns = cut_lineage(number_rows(named, "_text", by=keys, out="pid", seed=seed).drop("_text"))
    counted = running_totals(patterns.select(*keys, "pid", "m"), "pid", {"start": "m"}, by=keys).join(classes, keys)
    extra = F.greatest(F.least(F.col("rest") - F.col("start"), F.col("m")), F.lit(0))
    copies = counted.select(*keys, "pid", "k", (F.col("m") * F.col("each") + extra).alias("copies"))
    copies = cut_lineage(copies.filter(F.col("copies") > 0))
    # only patterns that get new points need neighbours
    asking = patterns.join(copies.select(*keys, "pid", F.lit(True).alias("asked")), [*keys, "pid"], "left")
    other = patterns.select(*keys, F.col("pid").alias("nid"), F.col("m").alias("nm"), F.col("x").alias("nx"))
    upto = F.sum("nm").over(
        Window.partitionBy(*keys, "pid").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    near = nearest(asking, k, seed=seed, by=keys, asked=F.col("asked"))
    found = near.join(other, [*keys, "nid"]).withColumn("upto", upto)
    lists = found.groupBy(*keys, "pid").agg(
        F.sort_array(F.collect_list(F.struct("upto", F.col("nx").alias("x")))).alias("near")
    )
    base = patterns.join(lists, [*keys, "pid"], "left")
    planned = base.join(copies, [*keys, "pid"])
    chunks = planned.withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_CHUNK).cast("long")))
    ).repartition(*keys, "pid", "at")
    single = chunks.withColumn(
        "copy", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + _CHUNK, F.col("copies")) - 1))
    )
    pick = F.floor(hash_uniform(F.col("pid"), F.col("copy"), seed=seed) * F.col("k")) - (F.col("m") - 1)
    along = hash_uniform(F.col("pid"), F.col("copy"), seed=seed + 1)
    partner = F.when(F.col("_pick") < 0, F.col("x")).otherwise(
        F.coalesce(F.filter("near", lambda e: e["upto"] > F.col("_pick"))[0]["x"], F.col("x"))
    )
    points = single.withColumns({"_pick": pick, "_u": along}).select(*keys, "x", partner.alias("_p"), "_u")
    mixed = points.select(*keys, F.zip_with("x", "_p", lambda a, b: a + (b - a) * F.col("_u")).alias("x"))
    return mixed.selectExpr(*[f"x[{i}] AS `{f}`" for i, f in enumerate(features)], *[f"`{c}` AS `{b}`" for b, c in zip(by, keys)])


def smote(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    k: int = 5,
    seed: int = 42,
    group: str | None = None,
) -> DataFrame:
    """All rows plus synthetic ones, so that every class is as large as the largest; one plan for all classes.

    With ``group`` a class is a pair of label and group value, which evens out groups within labels too.
    A class of a single row is repeated, as it has no neighbour.
    """
    by = [label] + ([group] if group else [])
    rows = complete_rows(df.select(*features, *by), [*features, *by])
    numbers = [f"CAST(`{f}` AS DOUBLE) AS `{f}`" for f in features]
    given = rows.selectExpr(*numbers, *[f"`{b}`" for b in by]).withColumn("synthetic", F.lit(False))
    return given.unionByName(_synthetic(rows, features, by, k, seed).withColumn("synthetic", F.lit(True)))
