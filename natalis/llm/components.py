"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.llm.shared import saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def _star(sided: DataFrame) -> DataFrame:
    """(a, b, least): each edge beside the least of ``a`` and its neighbours; ``sided`` lists both or one direction."""
    least = sided.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return sided.join(least, "a")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge, with the least node of its component.

    ``edges`` has the columns a and b. Each round hangs every node's larger neighbours under its least neighbour
    and then its smaller ones, which keeps components and leaves stars after a logarithmic number of rounds.
    Rounds end when nothing changes; each is stored, so a lost executor costs one round at most.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now = saved(ordered, "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        star = _star(large)
        small = star.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            star.select("a", F.col("least").alias("b"))
        )
        now = saved(small.filter("a <> b").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
