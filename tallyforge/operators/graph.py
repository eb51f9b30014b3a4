"""Groups of things that hang together, from links, and clusters of names that share a rare word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.scratch import forget, written


def groups(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the least node that it reaches) for each node of a link to another.

    A round hangs every node under the least root near it and then lets roots skip to their roots' roots.  A node's links
    are only ever summed up, never gathered; rounds grow with the logarithm of the longest way.
    """
    both = links.where(F.col(a) != F.col(b)).select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = written(both.unionAll(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    roots = written(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("root")))
    while True:
        of = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"r{name}"))
        # a root moves under the least root that any node of it sees; a node keeps its own way until it jumps
        seen = edges.join(of("x"), "x").join(of("y"), "y").where("rx > ry").groupBy(F.col("rx").alias("node")).agg(F.min("ry").alias("better"))
        moved = roots.join(seen, roots["root"] == seen["node"], "left").select(roots["node"], F.coalesce("better", "root").alias("root"))
        jumped = moved.alias("m").join(moved.select(F.col("node").alias("up"), F.col("root").alias("top")), F.col("m.root") == F.col("up"), "left").select("node", F.least(F.col("root"), F.coalesce("top", "root")).alias("root"))
        last, roots = roots, written(jumped)
        changed = last.join(roots.withColumnRenamed("root", "now"), "node").where("root <> now").limit(1).count()
        forget(last)
        if not changed:
            forget(edges)
            return roots


def name_clusters(names: DataFrame, words: str, market: str, rare: int = 3, least: int = 5) -> DataFrame:
    """market, cluster, members, names and shown of the clusters with `least` members or more.

    names: name, words (an array) and market; a row for each member.  Names of a market hang together if they share a
    word that at most `rare` of its names hold.  A word's names are linked to its least name, so no pairs are made.
    """
    one = names.groupBy(market, "name").agg(F.count("*").alias("n"), F.first(words).alias("_w"))
    held = one.select(market, "name", F.explode(F.array_distinct("_w")).alias("word"))
    few = held.groupBy(market, "word").agg(F.count("*").alias("_k"), F.min("name").alias("_least")).where((F.col("_k") > 1) & (F.col("_k") <= rare)).drop("_k")
    node = lambda c: F.struct(F.col(market).alias("market"), F.col(c).alias("name"))
    found = groups(held.join(few, [market, "word"]).select(node("name").alias("a"), node("_least").alias("b")))
    placed = one.withColumn("_node", node("name")).join(found, F.col("_node") == F.col("node"), "left").withColumn("cluster", F.coalesce("root.name", "name"))
    out = placed.groupBy(market, "cluster").agg(F.sum("n").alias("members"), F.count("*").alias("names"), F.min(F.struct(F.lower("name"), "name")).alias("_s"))
    return out.where(F.col("members") >= least).select(market, "cluster", "members", "names", F.col("_s.name").alias("shown"))
