"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowwarden.llm.exchange import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node on an edge; a component is named by its smallest node.

    Each step keeps at most one edge per edge given, replaces neighbours by the smallest one through
    aggregates and joins, and never gathers a node's neighbours. It ends when a round changes nothing.
    """
    links = settle(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    )
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        # large star: every larger neighbour of a node moves to the node's smallest neighbour (or itself)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = settle(small.unionByName(least.withColumnRenamed("m", "v")).where("u > v").distinct())
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
