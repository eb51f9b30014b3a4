"""Merkle manifest of documents: a tree for each language, one over their roots, and a proof for every document.

Leaves are numbered within their tree by ranges of the sorted order.  Bucket i of a level holds the nodes
[i * fanout^k, (i + 1) * fanout^k): `applyInPandas` collapses a bucket's k levels to one node, and the buckets' nodes are
the next round's level until each tree has one node.  The roots of the languages' trees, in order, are the leaves of the
last tree.  Going down again, each bucket meets the proof of its own node (one row) and puts its nodes' lower proofs in
front of it.  A task holds one bucket of fanout^k nodes; rounds grow with the logarithm of the rows; every round is
written to the shared folder, so a lost executor costs its tasks only.

Defined results: null fields are `-`; rows of a language go by doc_id (null first), then leaf, so repeated rows are
leaves of their own; a null language is a tree of its own, as is the empty string; a document without id isn't tampered
with; a text of any length is hashed whole by the JVM; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import forget, settled, table

FANOUT, LEVELS = 8, 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NODE = "tree string, place long, total long, node string"


def framed(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column) -> Column:
    return F.sha2(F.concat(*(framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), framed(text)), 256)


def digest(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def height(total: int, fanout: int = FANOUT) -> int:
    """Levels above the leaves of a tree."""
    out = 0
    while total > 1:
        total, out = -(-total // fanout), out + 1
    return out


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """nodes (settled, with a column tree; deleted) with place, from 0 in each tree by order, and total, the tree's nodes, settled.

    Ranges of (tree, order) are numbered by themselves; a window over the ranges' counts, a row for each tree and range,
    sets them one behind another.  `_nth` splits ranges of equal rows.
    """
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order, "_nth")]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settled(nodes.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_seq", F.monotonically_increasing_id()))
    counts = dealt.groupBy("tree", F.shiftright("_seq", 33).alias("_range")).agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.select(F.col("tree").alias("_tree"), F.col("_range").alias("_from"), (before - F.col("_first")).alias("_add"), F.sum("_n").over(whole).alias("total"))
    met = dealt.join(ranges, dealt["tree"].eqNullSafe(ranges["_tree"]) & (F.shiftright("_seq", 33) == ranges["_from"]))
    out = settled(met.withColumn("place", F.col("_seq") + F.col("_add")).drop("_nth", "_seq", "_tree", "_from", "_add"))
    forget(nodes, dealt)
    return out


def collapse(fanout: int = FANOUT, levels: int = LEVELS):
    """A bucket of up to fanout^levels nodes as its one node at most `levels` levels above."""

    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values("place")
        nodes, total = bucket["node"].tolist(), int(bucket["total"].iloc[0])
        steps = min(levels, height(total, fanout))
        for _ in range(steps):
            nodes, total = [digest(nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)], -(-total // fanout)
        return pd.DataFrame({"tree": [bucket["tree"].iloc[0]], "place": [int(bucket["place"].iloc[0]) // fanout**levels], "total": [total], "node": nodes})

    return run


def _bucket(fanout: int, levels: int) -> Column:
    return F.expr(f"place div {fanout**levels}")


def ascend(level: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> list[DataFrame]:
    """The levels (tree, place, total, node) of each round above this one; the last holds one node for each tree."""
    out: list[DataFrame] = []
    most = level.agg(F.max("total")).first()[0] or 0
    while most > 1:
        level = settled(level.select("tree", "place", "total", "node").groupBy("tree", _bucket(fanout, levels)).applyInPandas(collapse(fanout, levels), NODE))
        out.append(level)
        most = level.agg(F.max("total")).first()[0]
    return out


def _lower(nodes: list[str], total: int, fanout: int, levels: int) -> tuple[list[list[str]], list[list[str]]]:
    """For each node of a bucket, the siblings left and right of its path on each of the bucket's levels."""
    lefts: list[list[str]] = [[] for _ in nodes]
    rights: list[list[str]] = [[] for _ in nodes]
    width = 1
    for _ in range(min(levels, height(total, fanout))):
        runs = ["".join(nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        sides = [(runs[k // fanout][: 64 * (k % fanout)], runs[k // fanout][64 * (k % fanout + 1) :]) for k in range(len(nodes))]
        for k in range(len(lefts)):
            left, right = sides[k // width]
            lefts[k].append(left)
            rights[k].append(right)
        nodes, width = [sha256(r.encode()).hexdigest() for r in runs], width * fanout
    return lefts, rights


def descend(level: DataFrame, upper: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """level with lefts, rights and subroot: each node's proof through its bucket, then its bucket's own (upper: tree, place, lefts, rights, subroot)."""
    names = level.columns

    def run(bucket: pa.Table, above: pa.Table) -> pa.Table:
        bucket = bucket.sort_by("place")
        nodes, total = bucket.column("node").to_pylist(), bucket.column("total")[0].as_py()
        lefts, rights = _lower(nodes, total, fanout, levels)
        more = {c: above.column(c)[0].as_py() for c in ("lefts", "rights", "subroot")}
        kind = pa.list_(pa.string())
        added = [pa.array([x + more["lefts"] for x in lefts], kind), pa.array([x + more["rights"] for x in rights], kind), pa.array([more["subroot"]] * len(nodes), pa.string())]
        return pa.table([*(bucket.column(c) for c in names), *added], [*names, "lefts", "rights", "subroot"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in level.schema.fields) + ", lefts array<string>, rights array<string>, subroot string"
    above = upper.select("tree", "place", "lefts", "rights", "subroot")
    return level.groupBy("tree", _bucket(fanout, levels)).cogroup(above.groupBy("tree", "place")).applyInArrow(run, schema)


def manifest(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> tuple[DataFrame, str | None]:
    """leaves (tree, doc_id, node and others) with place, total, subroot and proof, and the root.

    The proof is an array of (left, right), the joined digests beside the path, from the leaf's level to the root's.
    """
    base = numbered(settled(leaves.withColumn("_nth", F.monotonically_increasing_id())), "doc_id", "node")
    rounds = ascend(base, fanout, levels)
    tops = (rounds[-1] if rounds else base).select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("key"), "node", F.lit(0).alias("_nth"))
    heads = numbered(settled(tops), "key")
    above = ascend(heads, fanout, levels)
    top = (above[-1] if above else heads).select("node").first()  # one row, or none if there are no leaves
    root = top and top["node"]
    none = F.array().cast("array<string>")
    upper = (above[-1] if above else heads).select("tree", F.lit(0).cast("long").alias("place"), none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"))
    for level in [*above[-2::-1], heads]:
        upper = descend(level, upper, fanout, levels)
    upper = settled(upper.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("place"), "lefts", "rights", F.col("node").alias("subroot")))
    for level in rounds[-2::-1]:
        upper = descend(level, upper, fanout, levels)
    # base, rounds and upper are read by what is returned
    proof = F.arrays_zip(F.col("lefts").alias("left"), F.col("rights").alias("right")).cast("array<struct<left:string,right:string>>")
    return descend(base, upper, fanout, levels).withColumn("proof", proof).drop("lefts", "rights"), root


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(node: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, node, lambda at, p: F.sha2(F.concat(p["left"], at, p["right"]), 256))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spoilt = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(F.translate("text", UPPER, UPPER.lower())))
    leaves = docs.select(F.col("lang").alias("tree"), "doc_id", leaf(F.col("text")).alias("node"), spoilt.alias("tampered"))
    out, root = manifest(leaves)
    out = out.withColumn("folded_root", folded(F.coalesce("tampered", "node"), F.col("proof")))
    whole = F.lit(root).cast("string")
    return out.select("doc_id", F.col("node").alias("leaf"), "subroot", whole.alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == whole).alias("verified"))
