"""A content-addressed store of token ids: unique chunks, document recipes, Merkle manifests.

Layout under one folder:
- `kind=chunk/`: digest (32 bytes, SHA-256 of the payload), n ids, payload (little-endian unsigned 16-bit ids).  Each digest is there once.
- `kind=recipe/`: per document (its row number `part`) and place the digest and n of a chunk.
- `manifest/`: one row per document in ascending doc_id order: part, start (ids before it), n_tokens, n_chunks, and the root of
  the binary SHA-256 tree over its chunk digests.

A rolling hash over the last `WINDOW` ids cuts where its low bits are zero, between `LEAST` and `MOST` ids, so equal
stretches of two documents are cut alike wherever they lie.  Chunks travel by digest, so that one task sees all copies
and keeps one; a task sends each chunk once.  Recipes travel by document.

Reading back opens the files again: each chunk's digest is computed anew from its payload, the recipe's digests must give
the manifest's root, and a document's CRC is combined from its chunks' CRCs and lengths, so no payload is moved.

Defined results: null and empty texts are their end id alone; each row is a document of its own, rows that repeat a doc_id
stand in the order of their texts' hashes (equal ones in any order), those of a null doc_id first; extra columns are
ignored; an empty table writes an empty store.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded, by_home, given_back, partitions, scratch, settled, table
from tallyforge.llm.encoding import encoder, vocabulary

END_ID, VOCABULARY = 2, "word_bpe_49k.json"
WINDOW, LEAST, MASK, MOST = 16, 128, 0x1FF, 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)


def marks(ids: np.ndarray) -> np.ndarray:
    """Places of a stream behind which a chunk may end.

    The rolling hash of a place is the weighted sum of the last WINDOW mixed ids, built by doubling the window.
    """
    roll = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    roll ^= roll >> np.uint64(29)
    width, weight = 1, int(_ODD)
    while width < WINDOW:
        roll[width:] += roll[:-width] * np.uint64(weight)
        width, weight = 2 * width, weight * weight % (1 << 64)
    return np.flatnonzero((roll >> np.uint64(40)) & np.uint64(MASK) == 0) + 1


def cuts(at: list[int], first: int, end: int) -> list[int]:
    """Where the chunks of the document at first:end of a stream end.  As a chunk has more than WINDOW ids, no hash that counts reaches over the document's start."""
    out, last, k = [], first, bisect_left(at, first + LEAST)
    while end - last > LEAST:
        while k < len(at) and at[k] < last + LEAST:
            k += 1
        last = min(at[k] if k < len(at) else end, last + MOST, end)
        out.append(last)
    if last < end or not out:
        out.append(end)
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """Root of the binary tree; a last odd node goes up as it is."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + b"".join(level[k : k + 2])).digest() if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0] if level else hashlib.sha256(b"").digest()


@lru_cache(maxsize=8192)
def _zeros(n: int) -> tuple[int, ...]:
    """The matrix over GF(2) that carries a CRC-32 over n zero bytes: the image of each bit."""
    if n == 1:
        return tuple(_one(1 << i) for i in range(32))
    half = _zeros(n // 2)
    out = tuple(_apply(half, x) for x in half)
    return tuple(_apply(_zeros(1), x) for x in out) if n & 1 else out


def _one(crc: int) -> int:
    for _ in range(8):
        crc = (crc >> 1) ^ (0xEDB88320 if crc & 1 else 0)
    return crc


def _apply(matrix: tuple[int, ...], x: int) -> int:
    out = 0
    for row in matrix:
        if x & 1:
            out ^= row
        x >>= 1
        if not x:
            break
    return out


def crc_joined(a: int, b: int, n: int) -> int:
    """The CRC-32 of two stretches from theirs; n: bytes of the second."""
    return _apply(_zeros(n), a) ^ b if n else a


STORED = "kind string, seat long, {doc} {type}, part long, hash long, place int, digest binary, n int, payload binary"
#: Digests of chunks that a task remembers it has sent; beyond that it may send one again, and the task that gets it keeps one.
SENT = 1_000_000


def write(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", vocab: str | None = None, end_id: int = END_ID) -> None:
    """Encodes docs and writes the store to path."""
    source = vocab or vocabulary(VOCABULARY)
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == doc)
    spark = docs.sparkSession

    def chunks(batches):
        ids_of = encoder(source).stream
        sent: set[bytes] = set()
        for b in batches:
            column = lambda c: b.column(b.schema.get_field_index(c))  # noqa: B023, E731
            ids, ends = ids_of(column(text), end_id)
            stream, at = ids.tobytes(), marks(ids).tolist() if len(ids) else []
            digests, sizes, of, place, first = [], [], [], [], 0
            unique: dict[bytes, bytes] = {}
            for d, to in enumerate(ends.tolist()):
                for k, c in enumerate(cuts(at, first, to)):
                    payload = stream[2 * first : 2 * c]
                    digest = hashlib.sha256(payload).digest()
                    unique.setdefault(digest, payload)
                    digests.append(digest)
                    sizes.append(c - first)
                    of.append(d)
                    place.append(k)
                    first = c
            unique = {k: v for k, v in unique.items() if k not in sent}
            if len(sent) + len(unique) > SENT:
                sent.clear()
            sent.update(unique)
            own, n = pa.array(of, pa.int64()), len(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["recipe"] * n, pa.string()), column("_seat").take(own), column(doc).take(own), column("_part").take(own), column("_hash").take(own), pa.array(place, pa.int32()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.nulls(n, pa.binary())], names_
            )
            n = len(unique)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["chunk"] * n, pa.string()), pa.array([int.from_bytes(x[:7], "little") for x in unique], pa.int64()), pa.nulls(n, column(doc).type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(list(unique), pa.binary()), pa.array([len(x) // 2 for x in unique.values()], pa.int32()), pa.array(list(unique.values()), pa.binary())], names_
            )
            given_back()

    def once(batches):
        seen: set[bytes] = set()
        for b in batches:
            chunk = pc.equal(b.column(0), "chunk")
            yield b.filter(pc.invert(chunk))
            b = b.filter(chunk)
            keep = []
            for d in b.column(6).to_pylist():
                keep.append(d not in seen)
                seen.add(d)
            yield b.filter(pa.array(keep, pa.bool_()))

    names_ = ["kind", "seat", doc, "part", "hash", "place", "digest", "n", "payload"]
    schema = STORED.format(doc=f"`{doc}`", type=kind)
    rows = bounded(docs.select(doc, text, F.xxhash64(text).alias("_hash"), F.xxhash64(doc, text).alias("_seat"), F.monotonically_increasing_id().alias("_part"))).mapInArrow(chunks, schema)
    by_home(rows, F.col("seat"), partitions(docs)).mapInArrow(once, schema).drop("seat").write.option("compression", "zstd").partitionBy("kind").parquet(f"{path}/data")
    recipes = recipe(spark, path, doc, kind)
    per_doc = recipes.groupBy("part").agg(F.first(doc).alias(doc), F.first("hash").alias("hash"), F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("place", "digest", "n"))).alias("chunks"))
    ordered = _started(per_doc, [doc, "hash", "part"], partitions(docs))

    def roots(batches):
        for b in batches:
            col = b.column(b.schema.get_field_index("chunks"))
            digests = [[c["digest"] for c in x] for x in col.to_pylist()]
            rest = [b.column(b.schema.get_field_index(c)) for c in ("part", doc, "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([len(x) for x in digests], pa.int32()), pa.array([merkle(x) for x in digests], pa.binary())], ["part", doc, "start", "n_tokens", "n_chunks", "root"])

    ordered.mapInArrow(roots, f"part long, `{doc}` {kind}, start long, n_tokens long, n_chunks int, root binary").write.option("compression", "zstd").parquet(f"{path}/manifest")


def part(spark: SparkSession, path: str, which: str, columns: str) -> DataFrame:
    """Columns of the rows of one kind; the other kind's files aren't opened."""
    return spark.read.schema(f"{columns}, kind string").parquet(f"{path}/data").where(F.col("kind") == which).drop("kind")


def recipe(spark: SparkSession, path: str, doc: str, kind: str) -> DataFrame:
    return part(spark, path, "recipe", f"`{doc}` {kind}, part long, hash long, place int, digest binary, n int")


def _started(per_doc: DataFrame, order: list[str], parts: int) -> DataFrame:
    """per_doc with start: the ids of the documents before each in this order, over ranges of documents rather than in one task."""
    ranged = settled(per_doc.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(F.sum("n_tokens").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = totals.select("_range", before.alias("_first"))  # one row per range
    within = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn("_within", within).join(first, "_range").withColumn("start", F.col("_first") + F.col("_within")).drop("_first", "_within", "_range").sortWithinPartitions(*order)


def read(spark: SparkSession, path: str, doc: str = "doc_id", kind: str = "bigint") -> DataFrame:
    """Per document from the files: doc, start, n_tokens, ids_crc32 and whether the Merkle root holds (verified)."""
    stored = part(spark, path, "chunk", "digest binary, n int, payload binary")

    def sums(batches):
        for b in batches:
            digests, crcs = [], []
            for d, payload in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                real = hashlib.sha256(payload).digest()
                digests.append(d if d == real else None)
                crcs.append(zlib.crc32(np.frombuffer(payload, "<u2").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(crcs, pa.int64())], ["digest", "crc"])

    sound = stored.mapInArrow(sums, "digest binary, crc long").where("digest is not null")
    used = recipe(spark, path, doc, kind).join(sound, "digest", "left")  # a digest that many documents share is split by the skew join
    per_doc = used.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("place", "digest", "n", "crc"))).alias("chunks"))
    manifest = spark.read.schema(f"part long, `{doc}` {kind}, start long, n_tokens long, n_chunks int, root binary").parquet(f"{path}/manifest")

    def documents(batches):
        for b in batches:
            crcs, held = [], []
            roots = b.column(b.schema.get_field_index("root")).to_pylist()
            for chunks, root in zip(b.column(b.schema.get_field_index("chunks")).to_pylist(), roots, strict=True):
                crc = 0
                for c in chunks or ():
                    crc = crc_joined(crc, c["crc"] or 0, 4 * c["n"])
                crcs.append(crc)
                held.append(bool(chunks) and all(c["crc"] is not None for c in chunks) and merkle([c["digest"] for c in chunks]) == root)
            keep = [b.column(b.schema.get_field_index(c)) for c in (doc, "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(crcs, pa.int64()), pa.array(held, pa.bool_())], [doc, "start", "n_tokens", "ids_crc32", "verified"])

    met = manifest.join(per_doc, "part", "left")
    return met.mapInArrow(documents, f"`{doc}` {kind}, start long, n_tokens long, ids_crc32 long, verified boolean")


def ids(spark: SparkSession, path: str, docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The id streams (array<int>) of the documents named in docs, rebuilt from the store: one row for each of their rows."""
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == doc)
    stored = part(spark, path, "chunk", "digest binary, n int, payload binary").select("digest", "payload")
    wanted = recipe(spark, path, doc, kind).join(docs.select(doc).distinct(), doc, "left_semi").join(stored, "digest")
    per_doc = wanted.groupBy("part").agg(F.first(doc).alias(doc), F.array_sort(F.collect_list(F.struct("place", "payload"))).alias("chunks")).select(doc, "chunks")

    def rebuild(batches):
        for b in batches:
            out = [np.frombuffer(b"".join(c["payload"] for c in x), "<u2").astype(np.int32) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], [doc, "ids"])

    return per_doc.mapInArrow(rebuild, f"`{doc}` {kind}, ids array<int>")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch(spark)
    write(docs, path)
    return read(spark, path, kind=next(f.dataType.simpleString() for f in docs.schema if f.name == "doc_id"))
