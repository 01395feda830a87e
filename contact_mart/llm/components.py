"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import Tables


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, tables: Tables, name: str = "components", known: DataFrame | None = None) -> DataFrame:
    """node, component (its smallest node) of every node that an edge (a, b) or a row of ``known`` reaches.

    ``known``: components (node, component) of edges that were taken before; only what the new ones join has to move.
    Each round is written down; the driver sees a count and a checksum of it. The rounds grow with the logarithm of
    the longest path. The smallest nodes are summed before they move, so a node with many edges costs one row a task;
    the joins on it can be split."""
    edges = edges.select("a", "b")
    if known is not None:
        edges = edges.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b")))
    now = tables.put(edges.where("a <> b").distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state, step = seen, step + 1
        now = tables.put(_small_star(_large_star(now)).distinct(), f"{name}-{step}")
        tables.drop(f"{name}-{step - 1}")
