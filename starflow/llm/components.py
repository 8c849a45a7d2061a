"""Connected components by alternating large-star and small-star steps.

Every step is an aggregate for the least neighbour, which is written, and a join
back on the node. A node with very many neighbours is pre-aggregated before the
shuffle. The join reads the minima from their table, so that adaptive execution
may split such a node's neighbours over tasks (an aggregate right before the join
would keep it from that); no neighbour list is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import Scratch


def _large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Each node's larger neighbours are tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch.store(both.groupBy("u").agg(F.min("v").alias("m")), name)
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())


def _small_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = scratch.store(down.groupBy("u").agg(F.min("v").alias("m")), name)
    tied = down.join(least, "u")
    return (tied.filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); the root is the least node reachable.

    Each round is written; it ends when a round changes nothing.
    """
    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = scratch.store(edges.filter("u <> v").distinct(), f"{name}-0")
    last, k = None, 0
    while last != (last := state(now)):
        k += 1
        large = scratch.store(_large_star(now, scratch, f"{name}-{k}b"), f"{name}-{k}a")
        now = scratch.store(_small_star(large, scratch, f"{name}-{k}c"), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}", *(f"{name}-{k}{step}" for step in "abc"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select("v", "v").distinct())
