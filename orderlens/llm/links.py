"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.workspace import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): the smallest node it is connected with.

    Every round is written to the shared folder. Each step only takes the smallest neighbour of
    a node, which is combined before the shuffle, so that a node with very many edges is as good
    as any; the number of rounds grows with the logarithm of the longest path.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(ordered.distinct(), "links")
    while not _stars(now):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(small, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = stored(star.where("a <> b").distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )


def _stars(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour that has none itself, or no smaller neighbour."""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] is not True
