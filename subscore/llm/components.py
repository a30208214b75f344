"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) is connected to.

    Alternates large and small stars: every node links its larger neighbours, then its
    smaller ones, to the smallest it knows, until the edges stay the same. Each step is one
    aggregate, reduced before it is shuffled and then written down, and one join with both
    sides shuffled for it, so that AQE can divide the edges of a hub.
    """
    now = _ordered(edges).checkpoint()
    seen = None
    while True:
        now = _ordered(_small_star(_ordered(_large_star(now)))).checkpoint()
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("root")).distinct().select(F.col("root").alias("node"), "root")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).checkpoint()
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        # The centre of a star stays connected to it.
        least.where("a <> m").select("a", F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
    return edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))
    )
