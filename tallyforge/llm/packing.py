"""Sequence packing: shortest pack first over the histogram of lengths.

Each document's ids (and an end id) are cut into whole sequences and a rest, so the only thing placed by search is the
rests' lengths, at most `size` distinct ones.  Lengths are taken longest first; all pieces of one length are placed
together into the open pack with the least filling that has room (the shortest pack), `count` packs at a time; what
doesn't fit opens new packs.  The search knows only counts, so its cost doesn't grow with the documents: a pack pattern
is (room, count, lengths), and each step turns at most one pattern into two more.

The patterns go back to the documents by rank: the k-th piece of a length gets the k-th place of that length.  Ranks come
from counts per hashed part and length and row numbers within both, so no length's pieces meet in one task.

A sequence is padded to `size`; one whose ids are a power of two needs none, as batches of such lengths exist.

Defined results: null and empty texts are their end id alone; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import bounded, settled, sliced, table
from tallyforge.llm.encoding import encoder, vocabulary

SIZE, END_ID, VOCABULARY = 2048, 1, "word_bpe_49k.json"

PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, size: int = SIZE, doc: str = "doc_id", text: str = "text", end_id: int = END_ID, vocab: str | None = None) -> DataFrame:
    """Per piece: doc, start, length, ids_crc32, doc_tokens.  One pass, no shuffle."""
    path = vocab or vocabulary(VOCABULARY)
    kind = {f.name: f.dataType.simpleString() for f in docs.schema}[doc]

    def run(batches):
        ids = encoder(path).ids
        end = np.array([end_id], "<u4").tobytes()
        for b in sliced(batches):
            names, rows = b.column(b.schema.get_field_index(doc)).to_pylist(), []
            for name, t in zip(names, b.column(b.schema.get_field_index(text)).to_pylist(), strict=True):
                all_ids = np.frombuffer(ids(t or ""), "<u2").astype("<u4").tobytes() + end
                n = len(all_ids) // 4
                rows += [(name, k, min(size, n - k), zlib.crc32(all_ids[4 * k : 4 * (k + size)]), n) for k in range(0, n, size)]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            doc_type = b.schema.field(b.schema.get_field_index(doc)).type
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], doc_type), *(pa.array(c, pa.int64()) for c in cols[1:])], [doc, "start", "length", "ids_crc32", "doc_tokens"])

    return bounded(docs.select(doc, text)).mapInArrow(run, f"`{doc}` {kind}, {PIECES}")


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """(count, lengths in order) of packs that together hold exactly the histogram's pieces."""
    full: list[tuple[int, list[int]]] = []
    #: By room left, ascending: [(room, number, count, lengths)]; the shortest pack is the one with the most room.
    open_packs: list[tuple[int, int, int, tuple]] = []
    serial = 0

    def put(room: int, count: int, lengths: tuple) -> None:
        nonlocal serial
        if room:
            serial += 1
            insort(open_packs, (room, serial, count, lengths))
        else:
            full.append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and open_packs and open_packs[-1][0] >= length:
            room, _, count, lengths = open_packs.pop()
            each = min(room // length, max(1, left // count))
            some = min(count, left // each)
            if some < count:
                put(room, count - some, lengths)
            put(room - each * length, some, (lengths, length, each))
            left -= some * each
        if left:
            each = min(size // length, left)
            if left // each:
                put(size - each * length, left // each, ((), length, each))
            if left % each:
                put(size - (left % each) * length, 1, ((), length, left % each))

    def flat(chain: tuple) -> list[int]:
        out = []
        while chain:
            chain, length, each = chain
            out += [length] * each
        return out[::-1]

    return [(c, flat(x)) for c, x in [*full, *((c, x) for _, _, c, x in open_packs)]]


def places(packs: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), by length and rank; a row holds as many ranks as its pattern has packs."""
    rows, used, sequence = [], {}, 0
    for count, lengths in packs:
        offset = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + count
            offset += n
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(cut: DataFrame, size: int = SIZE, key: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """cut (one row per piece, told apart by key, with a column length) with sequence_id and offset added.

    cut is read twice, so it should be a written table.
    """
    spark = cut.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    dealt = cut.withColumn("_part", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))
    counts = settled(dealt.groupBy("_part", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    ship = spark.sparkContext.broadcast(places(patterns(histogram, size)))  # some times `size` rows whatever the corpus
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("_part", "length", F.coalesce(before, F.lit(0)).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_part", "length").orderBy(*key))
    ranked = dealt.withColumn("_rank", rank - 1).join(first, ["_part", "length"]).select(*cut.columns, (F.col("_first") + F.col("_rank")).alias("_rank"))
    names = cut.columns

    def run(batches):
        t = ship.value
        at = t[:, 0] << 44 | t[:, 1]
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_rank"))
            row = np.searchsorted(at, length << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(t[row, 2] + rank - t[row, 1]), pa.array(t[row, 3])], [*names, "sequence_id", "offset"])

    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def packed(docs: DataFrame, size: int = SIZE) -> DataFrame:
    return pack(settled(pieces(docs, size)), size)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
