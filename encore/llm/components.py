"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


TASK_EDGES = 20_000         # edges per task; a contraction has many rounds over few bytes


def _least_neighbour(edges: DataFrame, tasks: int) -> DataFrame:
    """``(u, v, m)``: the edges with the least of ``u`` and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u").coalesce(tasks)


def _contract(edges: DataFrame, tasks: int) -> DataFrame:
    """One large star and one small star: every edge then points to a lesser node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_least_neighbour(both, tasks).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .filter("u <> v").distinct().coalesce(tasks))
    small = _least_neighbour(large, tasks)
    return (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct().coalesce(tasks))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with an edge; a component is its least node.

    Each round is two aggregations joined back, so a hub in a third of all edges
    is reduced before the shuffle. The edge table is checkpointed each round, in
    as many tasks as its edges need; the loop ends when a round changes nothing,
    after a number of rounds that grows with the logarithm of the longest chain.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now = checkpointed(now)
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        tasks = 1 + state[0] // TASK_EDGES
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        seen = state
        now = checkpointed(_contract(now.coalesce(tasks), tasks))
