"""Connected components of a distributed edge list, by alternating stars.

Each round hangs every node's larger neighbours on its smallest one (large star), then its
smaller neighbours and itself (small star); edges only ever shrink to stars, and the number
of rounds grows with the logarithm of the longest chain. Minima combine map-side, joins run
between staged tables, so a node with a third of all edges is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.staging import staged


def _hang(edges: DataFrame) -> DataFrame:
    """(n, m, low) of edges (n, m) made from a staged table: low is the smallest of n and its m."""
    low = staged(edges.groupBy("n").agg(F.min("m").alias("low")), "star-minima")
    return edges.join(low.select("n", F.least("n", "low").alias("low")), "n")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge list (a, b) of longs; the root is the smallest node."""
    now = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges"
    )
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(
            now.select(F.col("b").alias("n"), F.col("a").alias("m"))
        )
        large = staged(
            _hang(both).where("m > n").select(F.col("m").alias("a"), F.col("low").alias("b")).distinct(), "large-star"
        )
        hung = _hang(large.select(F.col("a").alias("n"), F.col("b").alias("m")))
        small = hung.select(F.col("m").alias("a"), F.col("low").alias("b")).unionByName(
            hung.select(F.col("n").alias("a"), F.col("low").alias("b"))
        )
        now = staged(small.where("a > b").distinct(), "small-star")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
