"""Connected components by alternating large-star and small-star steps, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import cut_few


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("at"), F.least("a", "least").alias("root"))
    found = both.filter("b > a").join(least, F.col("a") == F.col("at"))
    return found.select(F.col("b").alias("a"), F.col("root").alias("b")).filter("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "at")
    found = edges.join(least, F.col("a") == F.col("at")).select(F.when(F.col("b") == F.col("root"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("root").alias("b"))
    return found.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable, for all nodes of the edges (a, b) that are not roots themselves.

    Each step combines neighbours to their minimum before the shuffle and joins the minimum back, so that
    no node's neighbours come together in one task; the steps end when the stars don't change.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    seen = None
    while True:
        edges = cut_few(_small_star(_large_star(edges)))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
