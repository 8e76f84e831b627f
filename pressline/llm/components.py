"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.common import cut, driver_released


def _star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges (u, v) and the lowest node next to, or at, each u."""
    return edges, edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v); a component is named by its lowest node.

    Every round is written to the shared folder, and the driver keeps nothing of it.  A hub's edges are many rows with one key; the join
    with the table of minima is left for adaptive execution to split.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both, low = _star(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down, low = _star(large.where("u <> v").distinct())
        small = down.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = cut(small.where("u <> v").distinct())
        state = tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.countDistinct("u")).first())
        if state == before and state[0] == state[2]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        del both, low, large, down, small
        driver_released(edges.sparkSession)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
