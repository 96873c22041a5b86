"""Connected components by alternating large and small stars, on tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import work_table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: the neighbours of a node on one side are tied to its smallest neighbour."""
    near = _both_ways(edges) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = near.groupBy("a").agg(F.min("b").alias("low")).select(
        "a", F.least("a", "low").alias("low")
    )
    tied = near.join(least, "a")
    if large:
        return tied.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    ends = tied.select(F.col("b").alias("a"), F.col("low").alias("b"))
    return ends.unionByName(tied.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of the edges ``(a, b)``; the root is the smallest of its component.

    Every step writes its edges to the shared folder, sums before it shuffles and only joins
    on a node, so that a node with very many links is split by adaptive execution. Loops and
    repeated edges do no harm; no edges give no rows.
    """
    now = work_table(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # A step keeps the components; once each node has one link only, to its root, steps change nothing.
    while True:
        moved = work_table(_star(_star(now, large=True), large=False))
        roots = moved.select(F.col("b").alias("a")).distinct()
        deep = moved.join(roots, "a", "left_semi").limit(1).count()
        many = moved.groupBy("a").count().where("count > 1").limit(1).count()
        if not deep and not many:
            return moved.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                moved.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = moved
