"""Connected components of links between long node numbers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.sources.staging import stage


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(a, b)`` links to ``(node, root)``: the smallest node that each linked node reaches.

    Union-find on tables: every round points each node's neighbours at the smallest of them, which halves path
    lengths, until nothing changes. All steps are aggregates and joins on nodes; a node with very many links is a
    skewed join side, which adaptive execution splits. Each round is written to the scratch folder.
    """
    edges = stage(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    mark, number = None, 0
    while True:
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark, number = tuple(now), number + 1
        edges = stage(_small_star(stage(_large_star(edges), f"{name}-{number}a")), f"{name}-{number}b")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct()
