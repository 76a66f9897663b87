"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node, combined map-side, joined back to the edges, so a node with very
many neighbours is split by the planner. Every round is staged, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.sources.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("_v"))
    least = least.select("u", F.least("u", "_v").alias("m"))
    larger = both.filter(F.col("v") > F.col("u"))
    return larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """For edges from a larger to a smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    ends = F.explode(F.array("a", "b")).alias("a")
    moved = edges.join(least, "a").select(ends, F.col("m").alias("b"))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for nodes other than roots.

    ``edges`` has the columns ``a`` and ``b``. Edges of a node to itself and repeated edges
    change nothing; without edges there are no rows.
    """
    edges = stage(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    seen = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "edges")
        mark = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
