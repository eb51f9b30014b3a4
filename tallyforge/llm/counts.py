"""Token counts without ids: pieces are counted once per distinct pre-token and summed over documents' frequencies.

This vocabulary has no piece that goes on from a letter into white space (checked when it is opened), so a text's pieces
are those of its pre-tokens: a run of spaces and the characters up to the next one, the text's first with the space that
the library puts in front.  Each distinct pre-token of a batch of documents is sent, once,
to the task of its hash, where the library counts its pieces once; the counts return to the batch, where the documents'
frequencies wait, and are summed.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import ASKED, QUESTION, REST, answered, asked, parcel, partitions, stretches, table
from tallyforge.llm.encoding import vocabulary

VOCABULARY, LIMIT = "piece_bpe_32k.model", 4096
SPACE = "▁"


@lru_cache(maxsize=2)
def model(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(SPACE in p.lstrip(SPACE) for p in map(sp.id_to_piece, range(sp.get_piece_size()))):
        raise ValueError("a piece reaches over white space: texts can't be cut there")
    return sp


def pre_tokens(text: str) -> list[str]:
    """The text's parts; the space that the library puts in front is in the first."""
    if not text:
        return []
    parts, run, out = (" " + text.replace(SPACE, " ")).split(" "), "", []
    if "" not in parts[1:]:
        return [" " + p for p in parts[1:]]
    for p in parts[1:]:
        run += " "
        if p:
            out.append(run + p)
            run = ""
    return [*out, run] if run else out


def piece_counts(tokens: list[str], path: str) -> np.ndarray:
    """The pieces of each pre-token, which begins with the space that the library adds by itself."""
    # A pre-token of one space alone is a whole text of one space less: the library adds none to an empty text.
    return np.array([len(x) for x in model(path).encode([t[1:] for t in tokens], num_threads=1)], np.int64) + np.array([t == " " for t in tokens], np.int64)


def token_counts(docs: DataFrame, doc: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per document: doc, n_bytes, n_tokens."""
    path = path or vocabulary(VOCABULARY)
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == doc)

    parts = partitions(docs)
    buckets = 4 * parts

    def ask(batches):
        part = TaskContext.get().partitionId()
        for k, b in enumerate(batches):
            names, batch = b.column(b.schema.get_field_index(doc)), part << 32 | k
            number: dict[str, int] = {}
            codes, of, times, size = [], [], [], []
            for i, t in enumerate(b.column(b.schema.get_field_index(text)).to_pylist()):
                size.append(len((t or "").encode("utf-8", "surrogatepass")))
                for p, n in Counter(pre_tokens(t or "")).items():
                    codes.append(number.setdefault(p, len(number)))
                    of.append(i)
                    times.append(n)
            home = np.fromiter((zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in number), np.int64, len(number)) % buckets
            order = np.argsort(home, kind="stable")  # the answers' order: by bucket
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            tokens, home = np.array(list(number), object)[order], home[order]
            runs = stretches(home)
            values = [parcel(pa.RecordBatch.from_arrays([pa.array(tokens[a:z].tolist(), pa.string())], ["token"])) for a, z in runs]
            yield asked([int(home[a]) for a, _ in runs], QUESTION, batch, values)
            entries = pa.StructArray.from_arrays([pa.array(place[np.array(codes, np.int64)] if codes else np.empty(0), pa.int32()), pa.array(times, pa.int32())], ["place", "times"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(np.array(of, np.int64), np.arange(len(names) + 1)), pa.int32()), entries)
            rest = pa.RecordBatch.from_arrays([names, pa.array(size, pa.int64()), lists], ["doc", "n_bytes", "entries"])
            yield asked([batch % buckets], REST, batch, [parcel(rest)])

    def answer(_):
        memo: dict[str, int] = {}

        def reply(rows):
            tokens = rows.column(0).to_pylist()
            if len(memo) > 500_000:
                memo.clear()
            new = [t for t in tokens if t not in memo]
            memo.update(zip(new, piece_counts(new, path).tolist(), strict=True))
            return pa.array([memo[t] for t in tokens], pa.int32())

        return reply

    def finish(rest, answers):
        pieces = np.concatenate([np.empty(0, np.int64), *(x.to_numpy() for x in answers)])
        lists = rest.column(2)
        flat = lists.flatten()
        place, times = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        own = np.repeat(np.arange(rest.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        total = np.bincount(own, weights=pieces[place] * times, minlength=rest.num_rows).astype(np.int64)
        return pa.RecordBatch.from_arrays([rest.column(0), rest.column(1), pa.array(total)], [doc, "n_bytes", "n_tokens"])

    return answered(docs.select(doc, text).mapInArrow(ask, ASKED), answer, finish, f"`{doc}` {kind}, n_bytes long, n_tokens long", parts)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
