"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

A step is one hash aggregate for the least neighbour and one join with it. A node with very
many neighbours is combined before the shuffle in the aggregate, and the join is one that
adaptive execution splits, because the other side is unique. No neighbour list is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelarder.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """`edges` (a, b: long) -> one row per node: node, component (its least reachable node).

    Edges with a null end or equal ends are left out; without edges the result is empty.
    """
    a, b = edges.columns
    edges = edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(edges.distinct(), "edges")
    seen = _mark(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked with the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    linked = both.where("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked with the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
