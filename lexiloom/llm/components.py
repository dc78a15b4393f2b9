"""Connected components by alternating large-star and small-star steps over a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexiloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest id among the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of these neighbours."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns); component is the smallest id reachable.

    Each round is written to the shared folder, so lineage stays short. Rows with a null and loops are left out;
    a hot centre is pre-aggregated before its rows move, and its join is one that Spark can split.
    """
    a, b = edges.columns
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    now = stored(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _stars(now):
        now = stored(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, which has none."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    bad = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("low")).where("ups > 1 or ups = 1 and low = 0")
    return bad.isEmpty()
