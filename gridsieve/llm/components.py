"""Connected components of a link table, by alternating star contractions on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import keep, keep_for_join


def connected(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (a, b); component is the least node.

    Each round hangs larger neighbours, then smaller ones, on the least neighbour.  Only links
    are shuffled, minima are combined before the shuffle, and no neighbour list is built, so a
    component with most of the nodes does not meet in one task.  Rounds grow with the logarithm
    of the longest path.  Nulls and links of a node with itself are left out.
    """
    now = keep(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct())
    before = None
    while (state := _fingerprint(now)) != before:
        before = state
        now = keep(_small_star(keep(_large_star(now))))
    roots = now.select(F.col("m").alias("node")).distinct()
    return now.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to its least neighbour (or itself)."""
    both = links.select(F.col("v").alias("u"), F.col("m").alias("n")).unionByName(
        links.select(F.col("m").alias("u"), F.col("v").alias("n"))
    )
    least = keep_for_join(both.groupBy("u").agg(F.min("n").alias("n_min")))
    return (
        both.where("n > u")
        .join(least, "u")
        .select(F.col("n").alias("v"), F.least("n_min", "u").alias("m"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, are linked to the least of them."""
    least = keep_for_join(links.groupBy("v").agg(F.min("m").alias("low")))
    onto = links.join(least, "v").where("m <> low").select(F.col("m").alias("v"), F.col("low").alias("m"))
    return onto.unionByName(least.select("v", F.col("low").alias("m"))).distinct()
