"""Connected components by alternating stars, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Join each node's larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("least")), "star")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the least of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("least")), "star")
    moved = (
        edges.join(least, "u")
        .filter("v <> least")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one root, and no root has one itself."""
    nodes = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    degrees = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """The least node of the component of each node: (node, root), for nodes that have an edge.

    edges: u and v, numbers. A node with many edges costs as many rows, never their pairs, and
    no edge reaches the driver.
    """
    edges = stored(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    while not _are_stars(edges):
        edges = stored(_small_star(stored(_large_star(edges), "edges")), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
