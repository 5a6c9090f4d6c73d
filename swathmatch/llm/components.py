"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathmatch.llm.shared import settle


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each node's component.

    *edges*: a, b in any direction, with repeats.  Every round writes its edges to
    the shared folder; rounds grow with the logarithm of the longest path.  Nodes
    without an edge to another node are not listed.
    """
    now = settle(_down(edges.filter(F.col("a") != F.col("b"))))
    before = _mark(now)
    while True:
        now = settle(_small_star(_large_star(now)))
        after = _mark(now)
        if after == before:
            break
        before = after
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return settle(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))


def _down(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Changes when the edges change."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    around = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
    return own.unionByName(around).distinct()
