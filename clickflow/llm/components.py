"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined on the map side) joined back to the edges; each round's
edges are written to the shared folder, so lineage does not grow and nothing is collected. The number
of rounds grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of ``edges`` (a, b: any orderable type) the smallest node that it
    reaches. Self-loops and repeated edges are fine; null ends are ignored; no edges give no rows."""
    now = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _fingerprint(now)
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        before, mark = mark, _fingerprint(now)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node itself, are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").where("b > m").select("b", F.col("m")).toDF("a", "b").union(
        least.toDF("a", "b")).distinct()
