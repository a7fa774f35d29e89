"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is an aggregation (the smallest neighbour, combined map-side) and a join on a unique
key, so a node with very many edges is never one task; every round is written to the shared
folder, which cuts the lineage.  Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that is not itself the smallest of its component.

    ``edges`` has two bigint columns ``a, b``; loops, repeats and either direction are fine.
    """
    def tidy(e):
        return e.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(e):
        return e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    current = stage(tidy(edges), "components")
    before = mark(current)
    while before["n"]:
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select("a", "b", "m")
        current = stage(tidy(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))), "components")
        now = mark(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
