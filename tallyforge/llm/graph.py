"""Connected components of a graph of any size, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import forget, settled


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the least node it reaches) for each node with an edge to another.

    Each step replaces a node's edges by edges to the least node near it, found by an aggregate and a join, so that no
    node's edges are gathered.  Every round is written to the shared folder; rounds grow with the logarithm of the nodes.
    """
    now = settled(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while True:
        # large star: each node's greater neighbours go to the least of the node and its neighbours
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node's smaller neighbours, and it, go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(low.select("u", F.col("m").alias("v"))).distinct()
        last, now = now, settled(small)
        forget(last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
