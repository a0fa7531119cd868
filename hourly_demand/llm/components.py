"""Connected components of links by alternating stars.

Every round does two steps. Large star: each node's larger neighbours are linked to its smallest
neighbour. Small star: each node and its smaller neighbours are linked to the smallest of them. All
links keep their components, every round shortens the paths, and after O(log^2 n) rounds each node
is linked to the smallest of its component only. A round is a few aggregations with map-side
combining and joins by node; hubs are split by adaptive execution. Each round is written, so lost
executors cost one round at most; the round before it is deleted. The driver gets counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import unbroadcast
from .common import owning, spent, stored

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node of links (bigint a, b).

    Links in either direction, repeated and to itself are fine; rows with a null end are left out.
    """
    a, b = links.columns
    both = links.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    edges = stored(both.where("low is not null and low < high").distinct(), "links")
    mark = _mark(edges)
    for _ in range(ROUNDS):
        after = stored(_small_star(_large_star(edges)), "links")
        spent(edges)
        edges, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return owning(edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots), edges)


def _mark(edges: DataFrame) -> tuple:
    """Count and hash of a set of links: equal marks, equal sets."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """For each node u and neighbour v > u: v to the smallest of u and its neighbours."""
    # The smallest of all neighbours of u matters for its larger neighbours only.
    smallest = edges.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
    joined = edges.withColumnRenamed("low", "u").join(unbroadcast(smallest), "u", "left")
    # Links that come more than once are made one by the small star.
    return joined.select(F.coalesce("m", "u").alias("low"), "high")


def _small_star(edges: DataFrame) -> DataFrame:
    """For each node u: u and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("high").agg(F.min("low").alias("m"))
    joined = edges.join(unbroadcast(smallest), "high")
    moved = joined.where("low != m").select(F.col("m").alias("low"), F.col("low").alias("high"))
    return moved.unionByName(smallest.select(F.col("m").alias("low"), "high")).distinct()
