"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.shared import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's least neighbour."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked with the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"),
                                                                         F.col("m").alias("b"))
    return moved.union(least.toDF("a", "b")).distinct()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """``node, root`` for every node with a link; root is the least node that it reaches.

    Steps repeat until a round changes nothing; a round is written to the
    shared folder, so lineage stays short. Only one count and one checksum
    reach the driver.
    """
    e = written(edges.where(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                f"{name}-links")
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
        e = written(_small_star(_large_star(e)), f"{name}-round")
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(e.select(F.col("b"), F.col("b")).distinct())
