"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Join the larger neighbours of every node to the least of its neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join the smaller neighbours of every node, and the node, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the least node
    reachable.  The number of rounds grows with the logarithm of the component size;
    every round is written to the shared folder and only its row count and a checksum
    reach the driver."""
    edges = stored(links.where("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        last, edges = edges, stored(_small_star(_large_star(edges)), "edges")
        removed(last)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
