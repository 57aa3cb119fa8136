"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, low: str, high: str) -> DataFrame:
    """(node, component) for every node of an undirected edge table; the component is its smallest node.

    Each step links all larger (large star) or smaller (small star) neighbours of a node to its smallest neighbour. The
    minimum is a partial aggregate, written, and joined back on a unique key, so that Spark can split the edges of a node
    with very many of them over several tasks. Every step is written, so that the lineage stays short; the number of steps grows
    with the logarithm of the longest path."""
    now = written(edges.select(F.greatest(low, high).alias("u"), F.least(low, high).alias("v")).where("u <> v").distinct(),
                  "edges")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == before:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(written(least, "least"), "u").where("v > u")
        large = written(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
    stars = now.groupBy("u").agg(F.min("v").alias("component"))
    return stars.select(F.col("u").alias("node"), "component").unionByName(
        stars.select(F.col("component").alias("node"), "component").distinct())
