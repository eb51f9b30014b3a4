"""Benchmark decontamination by a prefix-filtered containment join.

Windows of the benchmark items (13 words; a shorter item is one window) must be found wherever documents hold them word
for word.  A window's tokens are its shingles of up to three words, ordered by rarity: the number of documents that hold
them, counted over all documents in a first pass.  As similarity is full containment, the necessary prefix is one token,
the rarest; it is joined with the documents' shingles, its place in the window and the document's length bound the
window's place, and the whole window is compared word by word.

Benchmarks of any size: items are dealt into blocks whose windows have a bounded number of words (`BLOCK_WORDS`).  A batch
of documents is held against one block after the other, and what they hit is united row by row, without a shuffle.

Defined results: null and empty texts have no words and are clean; items without words never occur; equal windows of
several items count for each; windows of items without id are hit, but these items are neither counted nor listed; repeated
document rows are judged each; extra columns are ignored, and `clean` keeps them whatever their names; the number of
blocks changes no result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded, raw, sliced, table

#: Window length in words, and the words of a shingle token.
WINDOW, SHINGLE = 13, 3
#: Words of windows in one block: bounds what is shipped to the executors.
BLOCK_WORDS = 4_000_000

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing: digits, a-z and all bytes from 0x80 stay, the rest separates.
_FOLD = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def item_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Windows:
    """The windows of a block of items as arrays, and their tokens."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.vocab: dict[bytes, int] = {}
        number: dict[tuple, int] = {}
        self.items: list[dict] = []
        for item, ws in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws]
            size = min(WINDOW, len(ids))
            for k in range(len(ids) - size + 1 if ids else 0):
                w = number.setdefault(tuple(ids[k : k + size]), len(number))
                if w == len(self.items):
                    self.items.append({})
                self.items[w][item] = True
        self.length = np.array([len(w) for w in number], np.int64)
        self.ids = np.zeros((len(number), WINDOW), np.int64)
        for k, w in enumerate(number):
            self.ids[k, : len(w)] = w
        self.radix = len(self.vocab) + 1
        #: Per token length: the distinct tokens, sorted.
        self.tokens = {n: np.unique(np.concatenate([np.empty(0, np.int64), *(self.keys(self.ids[:, k : k + n], n)[self.sure(n, k)] for k in range(WINDOW - n + 1))])) for n in range(1, SHINGLE + 1)}

    def keys(self, cols: np.ndarray, n: int) -> np.ndarray:
        out = cols[:, 0].copy()
        for k in range(1, n):
            out = out * self.radix + cols[:, k]
        return out

    def sure(self, n: int, k: int) -> np.ndarray:
        """Windows whose tokens have n words and that have one at place k."""
        return (np.minimum(self.length, SHINGLE) == n) & (self.length >= k + n)

    def stream(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all texts (0: not in any item, and once after each text), where each text begins, its words."""
        get, flat, counts = self.vocab.get, [], []
        for t in texts:
            ws = item_words(t)
            counts.append(len(ws))
            flat.extend(map(get, ws, repeat(0)))
            flat.append(0)
        counts = np.array(counts, np.int64)
        return np.fromiter(flat, np.int64, len(flat)), np.cumsum(counts + 1) - counts - 1, counts

    def places(self, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the stream has a token of n words, and which."""
        m = len(ids) - n + 1
        if m <= 0 or not len(self.tokens[n]):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        whole = ids[:m] > 0
        for k in range(1, n):
            whole &= ids[k : k + m] > 0
        at = np.flatnonzero(whole)
        key = ids[at]
        for k in range(1, n):
            key = key * self.radix + ids[at + k]
        which = np.minimum(np.searchsorted(self.tokens[n], key), len(self.tokens[n]) - 1)
        real = self.tokens[n][which] == key
        return at[real], which[real]

    def prefixes(self, frequency: dict[int, np.ndarray]) -> None:
        """Each window's rarest token (ties: the first), kept per token as a range of windows."""
        self.by_token = {}
        for n in range(1, SHINGLE + 1):
            own = np.flatnonzero(np.minimum(self.length, SHINGLE) == n)
            if not len(own):
                continue
            best, place, token = np.full(len(own), np.iinfo(np.int64).max), np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            for k in range(WINDOW - n + 1):
                has = self.length[own] >= k + n
                which = np.searchsorted(self.tokens[n], self.keys(self.ids[own, k : k + n], n))
                which[~has] = 0
                f = frequency[n][which]
                better = has & (f < best)
                best[better], place[better], token[better] = f[better], k, which[better]
            order = np.argsort(token, kind="stable")
            self.by_token[n] = (own[order], place[order], np.searchsorted(token[order], np.arange(len(self.tokens[n]) + 1)))

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words in the stream of all occurrences of windows, and which windows."""
        starts, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for n, (windows, place, first) in self.by_token.items():
            at, token = self.places(ids, n)
            many = first[token + 1] - first[token]
            at, token, many = at[many > 0], token[many > 0], many[many > 0]
            for lo in range(0, len(at), 1 << 18):
                a, t, m = (x[lo : lo + (1 << 18)] for x in (at, token, many))
                ends = np.cumsum(m)
                which = np.repeat(first[t] - (ends - m), m) + np.arange(ends[-1])
                w, start = windows[which], np.repeat(a, m) - place[which]
                fits = (start >= 0) & (start + self.length[w] <= len(ids))
                w, start = w[fits], start[fits]
                for k in range(WINDOW):  # the positions thin out word by word
                    ok = (self.length[w] <= k) | (ids[np.minimum(start + k, len(ids) - 1)] == self.ids[w, k])
                    w, start = w[ok], start[ok]
                starts.append(start)
                found.append(w)
        return np.concatenate(starts), np.concatenate(found)


def _blocks(benchmark: DataFrame, item: str, text: str):
    """Blocks of (item, words); rows come to the driver one partition at a time, never all together."""
    block, size = [], 0
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where("t is not null")
    for r in rows.toLocalIterator(prefetchPartitions=False):
        ws = item_words(r.t.encode("utf-8", "surrogatepass"))
        block.append((r.i, ws))
        size += min(len(ws), WINDOW) * max(1, len(ws) - WINDOW + 1)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _document_frequency(docs: DataFrame, windows: Windows, text: str) -> dict[int, np.ndarray]:
    """For each token of the block, how many documents hold it; all documents count."""
    ship = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches):
        w = ship.value
        total = {n: np.zeros(len(t), np.int64) for n, t in w.tokens.items()}
        for b in sliced(batches):
            ids, begin, _ = w.stream(raw(b, text))
            for n in total:
                at, token = w.places(ids, n)
                doc = np.searchsorted(begin, at, side="right") - 1
                total[n] += np.bincount(np.unique(doc * len(w.tokens[n]) + token) % max(1, len(w.tokens[n])), minlength=len(w.tokens[n]))
        for n, x in total.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(at), pa.array(x[at])], ["n", "token", "docs"])

    out = {n: np.zeros(len(t), np.int64) for n, t in windows.tokens.items()}
    counts = bounded(docs.select(text)).mapInArrow(run, "n int, token long, docs long").groupBy("n", "token").agg(F.sum("docs").alias("docs"))
    for r in counts.collect():  # at most one row for each token of the block
        out[r.n][r.token] = r.docs
    return out


STRETCHES = "array<struct<first:long,last:long>>"


RESULTS = ("n_words", "hits", "items")


def window_hits(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", keep: tuple[str, ...] | None = None, results: tuple[str, str, str] = RESULTS) -> DataFrame:
    """Per row: the columns in keep (doc by default), and under the names in results its words, hits (word stretches covered by windows, both ends included) and items (sorted as strings)."""
    spark, keep = docs.sparkSession, list(keep or (doc,))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    benchmark = benchmark.withColumn(item, F.col(item).cast("string"))
    ready = []
    for block in _blocks(benchmark, item, item_text):
        windows = Windows(block)
        windows.prefixes(_document_frequency(docs, windows, text))
        ready.append(spark.sparkContext.broadcast(windows))
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", {} long, {} {}, {} array<string>".format(results[0], results[1], STRETCHES, results[2])
    return bounded(docs.select(*dict.fromkeys([*keep, text]))).mapInArrow(_finder(ready, keep, text, results), schema)


def _hits(w: Windows, texts: list[bytes], items: list[set]) -> tuple[np.ndarray, np.ndarray]:
    """Words of the texts, each followed by a gap, that a block's windows cover; adds the items to each text's set."""
    ids, begin, _ = w.stream(texts)
    start, which = w.occurrences(ids)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + w.length[which], -1)
    pairs = np.unique((np.searchsorted(begin, start, side="right") - 1) * max(1, len(w.items)) + which)
    for p in pairs.tolist():
        items[p // len(w.items)].update(w.items[p % len(w.items)])
    return np.cumsum(cover[:-1]) > 0, begin


def _finder(ready: list, keep: list[str], text: str, results: tuple[str, str, str]):
    stretch = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def run(batches):
        for b in sliced(batches):
            texts = raw(b, text)
            items: list[set] = [set() for _ in texts]
            counts = np.array([len(item_words(t)) for t in texts], np.int64) if not ready else None
            hit, begin = np.zeros(0, bool), np.zeros(len(texts), np.int64)
            for ship in ready:
                covered, begin = _hits(ship.value, texts, items)
                hit = covered if not len(hit) else hit | covered
            if counts is None:
                counts = np.diff(np.append(begin, len(hit))) - 1
            edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
            of = np.searchsorted(begin, first, side="right") - 1
            offsets = np.searchsorted(of, np.arange(len(counts) + 1)).astype(np.int32)
            hits = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(first - begin[of]), pa.array(last - begin[of])], fields=list(stretch)))
            named = pa.array([sorted(x - {None}) for x in items], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(counts), hits, named], [*keep, *results])

    return run


N_HIT = "aggregate(hits, 0L, (a, x) -> a + x.last - x.first + 1)"
CONTAMINATED = "n_hit > 0 AND 20 * n_hit >= n_words"


def judged(hits: DataFrame) -> DataFrame:
    """The contract's columns from window_hits."""
    return hits.withColumn("n_hit", F.expr(N_HIT)).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), F.expr(CONTAMINATED).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated ones, each row judged by itself; all columns stay, whatever their names."""
    own = tuple(f"_tallyforge_{c}" for c in RESULTS)
    rule = CONTAMINATED.replace("n_hit", f"({N_HIT.replace('hits', own[1])})").replace("n_words", own[0])
    return window_hits(docs, benchmark, keep=tuple(docs.columns), results=own).where(f"NOT ({rule})").select(*docs.columns)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(window_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def brute(text: str | None, items: list[tuple[str, str | None]]) -> tuple:
    """The contract for one document, word by word: for tests."""
    ws, hit, got = item_words((text or "").encode()), set(), set()
    for i, t in items:
        x = item_words((t or "").encode())
        n = min(WINDOW, len(x))
        for k in range(len(x) - n + 1 if x else 0):
            for p in range(len(ws) - n + 1):
                if ws[p : p + n] == x[k : k + n]:
                    hit.update(range(p, p + n))
                    got.add(i)
    names = ",".join(sorted(got))
    return len(ws), len(hit), len(got), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws)
