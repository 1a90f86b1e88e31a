"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, staged


def _star(edges: DataFrame) -> DataFrame:
    """Link every neighbour above a node to the least of the node and its neighbours."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return edges.join(least, "a")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); the root is the least node it can reach.

    Each round is two aggregates and two joins over the edges; their number grows with the
    logarithm of the longest path. A node with very many edges is a skewed join key that Spark
    splits. Edges of a node with itself and repeated edges are allowed; no edges, no rows.
    """
    current, seen = staged(edges.select("a", "b").where("a <> b").distinct()), None
    while True:
        both = current.select("a", "b").union(current.select("b", "a"))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _star(down)
        links = small.select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = links.union(small.select("a", F.col("least").alias("b"))).where("a <> b").distinct()
        after = staged(links)
        drop_staged(current)
        current = after
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select("b", "b").distinct())
