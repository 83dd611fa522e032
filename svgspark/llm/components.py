"""Connected components of a link table by alternating large-star and small-star steps.

Links and labels stay in Spark tables; each step is one aggregation and one join back, written to the
shared folder, so lineage stays short and nothing is collected. The number of rounds grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of longs -> (node, component): every linked node with the smallest node it reaches."""
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen or state["n"] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v"), F.col("v")).distinct())
        seen = state
        edges = written(_small_star(_large_star(edges)), "links")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to its smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
