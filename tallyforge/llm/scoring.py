"""Language-model scores from a probabilistic suffix tree over words.

Training counts every word of every training document.  The root holds all words: P(w) = (c + 0.1) / (N + 0.1 (V + 1)).
Deeper states are contexts of 1 to `DEPTH` words before the next one, the document's start among them.  Absolute counts
and the test alone decide: every context seen `LEAST` times is a candidate, and every next symbol it has `OWN` times keeps
a probability of its own, whatever the corpus' size and the words' frequency.  A candidate is retained if its next-symbol
distribution diverges from its parent's by more than chance explains: twice its count times the divergence beats
`CHANCE` for each own next symbol.  Retained symbols get (n + M * P_parent) / (c + M), all others share the rest in
proportion to the parent.  Each token is scored in the longest retained suffix of what stands before it.

Words, pairs (a word and the next one) and longer contexts are three tables dealt by hash; none is collected or shipped.
A batch asks each of them once for every distinct entry and says which of its texts hold it; what returns is the sum for
each text, so neither texts nor answers to single entries travel.  Words of a share of
`NUMBERED` (`MOST` of them at most) have short numbers, others the hash of their bytes (62 bits), contexts a hash of 64 bits: two contexts would
have to share it to be taken for one.

A longer context can be seen `LEAST` times only if each pair of words in it is, so contexts are counted after pairs, and
only where all their pairs are that frequent.  Filters of a fixed size spare the rest: they know all words seen `OWN` and
`LEAST` times, all such pairs, all states and all their own next symbols, and say yes to some others, which then are
counted or asked for nothing.  A pair or window that no state has for its own needs its states' factors only, which are
asked once for each context.  A score is a sum: the base, what each pair's state adds to the root, and what each window's
state adds to its pair's.  States hold logarithms in single precision; counts are whole.

Defined results: null and empty texts have their end as the only token; repeated rows are learnt from
and scored each; without training documents every score is that of V = N = 0; extra columns are ignored.
"""

from __future__ import annotations

import gc
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import ASKED, QUESTION, REST, TABLE, answered, asked, bundle, by_home, each, forget, gathered, given_back, parcel, partitions, portions, settled, stretches, table, unparcel
from tallyforge.llm.language import bucket

#: Longest contexts, least counts of a context and of its own next symbols, the test's and smoothing's constants; see above.
DEPTH, LEAST, OWN = 4, 8, 2
CHANCE, M = 3.84, 4.0
END = b""
ADD = 0.1
#: Share of tokens from which words have a number below RARE, the most of such words; the start, no symbol, and words too few to be told apart.
NUMBERED, MOST, RARE, START, NONE, LOW = 2e-6, 60_000, 1 << 20, 0, -1, -2
#: Bits of a filter.
BITS = 1 << 25
#: A pair's answers from here on are added to the root's log10 probability, those below replace it.
ADDED = 1000.0


#: Bytes of the texts that are looked at together.
TEXTS = 12 << 20
#: Bytes of texts' sums that a task holds before it sends them on.
HELD = 32 << 20
#: What single precision may cost a task's share of a text's sum; the rest of larger sums, most of which may cancel the base, goes beside.
CLOSE = 1e-6
#: Words of more bytes are hashed one by one.
WIDE = 64


def _mix(h: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    h = (h ^ symbol.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_FACTOR = _mix(_mix(np.full(WIDE, 0x7654321, np.uint64), np.arange(WIDE)), np.arange(WIDE)) | np.uint64(1)


def _hashes(words: pa.Array) -> np.ndarray:
    """62 bits of each word: its bytes, each times the factor of its place, summed and mixed."""
    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    size, bytes_ = np.diff(at), words.buffers()[2] if len(words) else None
    data = np.frombuffer(bytes_, np.uint8)[at[0] : at[-1]] if bytes_ is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    at = at - at[0]
    place = np.minimum(np.arange(len(data)) - np.repeat(at[:-1], size), WIDE - 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _FACTOR[place], out=total[1:])
    out = _mix(_mix(total[at[1:]] - total[at[:-1]], size), size)
    for k in np.flatnonzero(size > WIDE).tolist():
        out[k] = int.from_bytes(blake2b(data[at[k] : at[k + 1]].tobytes(), digest_size=8).digest(), "little")
    return (out >> np.uint64(2)).astype(np.int64) | RARE


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of all texts (null: empty) and their end, each token's place among them, and how many tokens each text has.  Arrow splits at 0x20 and 0x09-0x0D."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    flat, own = split.flatten(), np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())
    real = pc.greater(pc.binary_length(flat), 0)  # a text may begin or end with white space
    coded, own = flat.filter(real).cast(pa.binary()).dictionary_encode(), own[real.to_numpy(zero_copy_only=False)]
    size = np.bincount(own, minlength=len(texts)).astype(np.int64) + 1
    inner = np.ones(len(own) + len(texts), bool)
    inner[np.cumsum(size) - 1] = False
    code = np.full(len(inner), len(coded.dictionary), np.int32)
    code[inner] = coded.indices.to_numpy()
    return pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())]), code, size


def _slices(batches, text: str, limit: int):
    """Batches in slices of about equal bytes of text, at most so many (or one row): smaller ones would ask more for the same words.  Memory that nothing uses goes back after each."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(text))), 0).to_pylist()
        total = sum(sizes)
        for lo, hi in portions(sizes, min(limit, total // -(-total // limit) + max(sizes, default=0)) if total else limit):
            yield b.slice(lo, hi - lo)
            given_back()


def _by_bucket(batches):
    """Sorted parcels: the values of each bucket."""
    now, values = None, []
    for b in batches:
        for home, value in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if home != now and values:
                yield now, values
                values = []
            now = home
            values.append(value)
    if values:
        yield now, values


def _released(spark: SparkSession) -> None:
    """Shuffle files of ended queries go when the driver collects its garbage; it is asked to, as nothing else may make it do so for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _parcels(buckets: int, home: np.ndarray, columns: dict[str, pa.Array], kind: int) -> pa.RecordBatch:
    order = np.argsort(home, kind="stable")
    home = home[order]
    rows = pa.RecordBatch.from_arrays(list(columns.values()), list(columns)).take(pa.array(order))
    runs = stretches(home)
    starts, values = [a for a, _ in runs], [parcel(rows.slice(a, b - a)) for a, b in runs]
    return pa.RecordBatch.from_arrays([pa.array(home[starts], pa.int64()), pa.array([kind] * len(starts), pa.int32()), pa.array(values, pa.binary())], ["bucket", "kind", "rows"])


_PARCEL = "bucket long, kind int, rows binary"


def word_counts(training: DataFrame, text: str, buckets: int) -> DataFrame:
    """Parcels of (word, count), each word in one parcel, and the parcel's sums."""

    def send(batches):
        for b in _slices(batches, text, 3 * TEXTS):
            distinct, code, _ = _tokens(b.column(b.schema.get_field_index(text)))
            yield _parcels(buckets, _hashes(distinct) % buckets, {"word": distinct, "n": pa.array(np.bincount(code, minlength=len(distinct)), pa.int64())}, 0)

    def merge(batches):
        for home, values in _by_bucket(batches):
            sums = pa.Table.from_batches([unparcel(v) for v in values]).group_by("word", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
            word, n = (sums.column(c).combine_chunks() for c in ("word", "n_sum"))
            word, n = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (word, n))
            rows = pa.RecordBatch.from_arrays([word, n], ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([home]), pa.array([0], pa.int32()), pa.array([parcel(rows)], pa.binary()), pa.array([int(n.to_numpy().sum())]), pa.array([len(n)])], ["bucket", "kind", "rows", "tokens", "distinct"])

    sent = training.select(text).mapInArrow(send, _PARCEL)
    return settled(by_home(sent, F.col("bucket"), buckets // 4).sortWithinPartitions("bucket").mapInArrow(merge, _PARCEL + ", tokens long, distinct long"))


def _chain(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), 0x1234567, np.uint64)
    for c in columns:
        h = _mix(h, c)
    return h


def _pack(columns: list[np.ndarray], *more: np.ndarray) -> bytes:
    """Symbols in two bytes, hashes apart; then other arrays."""
    parts = []
    for c in columns:
        parts += [np.where(c >= RARE, 65535, np.where(c < 0, c + 65535, c)).astype(np.uint16), c[c >= RARE]]
    return bundle([x.tobytes() for x in (*parts, *more)])


def _unpack(rows: pa.RecordBatch, columns: int, *kinds) -> list[np.ndarray]:
    parts, out = rows.column(0), []
    for k in range(columns):
        small = np.frombuffer(parts[2 * k].as_buffer(), np.uint16)
        c = small.astype(np.int64)
        c[small >= 65000] -= 65535
        c[small == 65535] = np.frombuffer(parts[2 * k + 1].as_buffer(), np.int64)
        out.append(c)
    return out + [np.frombuffer(parts[2 * columns + k].as_buffer(), kind) for k, kind in enumerate(kinds)]


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of each run of equal keys."""
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    return first, np.diff(np.append(first, len(key)))


def _distinct(columns: list[np.ndarray], buckets: int, kind: str | None = None):
    """Distinct windows (next symbol, then the words before it) by home: where one stands, its count, home; the windows' order, and where in it another begins.

    Windows whose hashes agree in half may stand twice; a stable order is the same wherever it is made.
    """
    head = _chain(columns[1:3])
    key = _mix(_chain(columns[1:]) if len(columns) > 3 else head, columns[0])
    order = np.argsort(head >> np.uint64(32) << np.uint64(32) | key >> np.uint64(32), kind=kind)
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
    at = order[first]
    return at, np.diff(np.append(np.flatnonzero(first), len(key))), _deal(head[at], buckets), order, first


def _deal(head: np.ndarray, buckets: int) -> np.ndarray:
    return ((head >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class Filter:
    """Hashes marked in BITS bits, by home: says yes to all of them."""

    def __init__(self, buckets: int, rows: list):
        self.bits = np.zeros((buckets, BITS // buckets // 8 + 1), np.uint8)
        for home, marks in rows:
            self.bits[home] = np.frombuffer(marks, np.uint8)

    def __getstate__(self):
        return self.bits.shape, pa.compress(self.bits.tobytes(), codec="zstd", asbytes=True)

    def __setstate__(self, state):
        shape, bits = state
        self.bits = np.frombuffer(pa.decompress(bits, shape[0] * shape[1], codec="zstd"), np.uint8).reshape(shape)

    @staticmethod
    def place(buckets: int, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) // np.uint64(buckets) % np.uint64(BITS // buckets // 8 * 8 + 8)).astype(np.int64)

    @classmethod
    def marks(cls, buckets: int, key: np.ndarray) -> bytes:
        out = np.zeros(BITS // buckets // 8 * 8 + 8, np.uint8)
        out[cls.place(buckets, key)] = 1
        return np.packbits(out).tobytes()

    def __call__(self, home: np.ndarray, key: np.ndarray) -> np.ndarray:
        at = self.place(len(self.bits), key)
        return (self.bits[home, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _filters(parcels: DataFrame, buckets: int, keys) -> list[Filter]:
    """Filters of what keys(parcel) gives as arrays; at most BITS bits each come to the driver."""

    def run(batches):
        for b in batches:
            for home, value in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                marks = [Filter.marks(buckets, k) for k in keys(unparcel(value.as_buffer()))]
                yield pa.RecordBatch.from_arrays([pa.array([home]), pa.array([marks], pa.list_(pa.binary()))], ["home", "marks"])

    rows = parcels.select("bucket", "rows").mapInArrow(run, "home long, marks array<binary>").collect()
    return [Filter(buckets, [(r.home, r.marks[k]) for r in rows]) for k in range(len(rows[0].marks) if rows else 0)]


def _held(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    k = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return k, table[k] == key


def retained(context: np.ndarray, n: np.ndarray, total: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tests contexts by their rows (context, count of a next symbol, of the context, the parent's probability), by context.

    Per row whether its context is retained and the own probability; per context the log10 of the others' factor.
    """
    first, many = _runs(context)
    fold = lambda x: np.add.reduceat(x, first) if len(first) else np.empty(0)
    c = total[first].astype(float)
    own = (n + M * parent) / (total + M)
    q, p = np.minimum(fold(parent), 1 - 1e-9), np.minimum(fold(own), 1 - 1e-9)
    kl = fold(own * np.log(own / parent)) + (1 - p) * np.log((1 - p) / (1 - q))
    return np.repeat(2 * c * kl > CHANCE * (many + 1), many), own, np.log10((1 - p) / (1 - q))


class Words:
    """Symbols of words: 0 a document's start, 1 to H frequent (by falling count), from RARE on hashes of others."""

    def __init__(self, tokens: int, distinct: int, frequent: list[tuple[bytes, int]]):
        self.floor = float(np.log10(max(ADD, tokens + ADD * (distinct + 1))))
        self.frequent = [w for w, _ in frequent]
        self.radix = len(frequent) + 2
        #: log10 of the root's probabilities; rare words count 0 here and are added where they meet their counts.
        self.root = np.zeros(self.radix)
        self.root[1:-1] = np.log10(np.array([c for _, c in frequent], float) + ADD) - self.floor
        #: Of words seen OWN and LEAST times, and of pairs seen LEAST times.
        self.own = self.least = self.often = None
        #: Of states of one word, their own next symbols, and the same of longer states.
        self.one = self.mine = self.deep = self.further = None

    def numbers(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words, their symbols, each token's word, tokens of each text; then with DEPTH starts before each text: tokens' places,
        the symbols of words seen OWN times (others LOW), and those of words seen LEAST times (others NONE)."""
        words, code, size = _tokens(texts)
        symbol = pc.fill_null(pc.index_in(words, value_set=pa.array(self.frequent, pa.binary())), -1).to_numpy().astype(np.int64) + 1
        rare = symbol == START
        symbol[rare] = _hashes(words.filter(pa.array(rare)))
        at = np.arange(len(code)) + DEPTH * (np.repeat(np.arange(len(size)), size) + 1)
        low = self.lowered(symbol, self.own, LOW)
        ids, before = np.zeros(len(code) + DEPTH * len(size), np.int64), np.zeros(len(code) + DEPTH * len(size), np.int64)
        ids[at], before[at] = low[code], np.where(low == LOW, NONE, self.lowered(low, self.least, NONE))[code]
        return words, symbol, code, size, at, ids, before

    def lowered(self, ids: np.ndarray, sieve: Filter | None, other: int) -> np.ndarray:
        """Rare words that the filter doesn't know become the other symbol."""
        rare = np.flatnonzero(ids >= RARE)
        out = ids.copy()
        if len(rare):
            key = ids[rare]
            out[rare[~sieve(key % len(sieve.bits), key)]] = other
        return out

    def known(self, ids: np.ndarray) -> np.ndarray:
        return self.root[np.where(ids < RARE, ids, 0)]


def windows(t: Words, at: np.ndarray, ids: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
    """Of tokens at their places: their symbols, and those of 1 to DEPTH words before (NONE beyond a start or a word or pair seen less than LEAST times)."""
    out = [ids[at], before[at - 1]]
    if t.often is None:
        return out
    context = _chain([before[:-1]])
    both = np.flatnonzero((before[:-1] != NONE) & (before[1:] != NONE))
    often = np.zeros(len(ids), bool)
    often[both + 1] = t.often(_deal(context[both], len(t.often.bits)), _mix(context[both], before[1:][both]))
    for k in range(2, DEPTH + 1):
        out.append(np.where((out[-1] <= START) | ~often[at - k + 1], NONE, before[at - k]))
    return out


def _ready(ship: list) -> Words:
    """What is known of words, with the filters shipped since; each is shipped once."""
    t, *more = (s.value for s in ship)
    for m in more:
        t.__dict__.update(m)
    return t


def _candidates(training: DataFrame, ship, text: str, buckets: int, kind: int) -> DataFrame:
    """Parcels of candidates by home; kind 1: pairs (next symbol, word; count, count of the word), kind 2: longer contexts."""
    width = 2 if kind == 1 else DEPTH + 1

    def send(batches):
        t = _ready(ship)
        for b in _slices(batches, text, TEXTS):
            _, _, _, _, at, ids, before = t.numbers(b.column(b.schema.get_field_index(text)))
            every = windows(t, at, ids, before)
            ok = every[kind] != NONE
            cols = [c[ok] for c in every[:width]]
            at, n, home, _, _ = _distinct(cols, buckets)
            cols = [c[at] for c in cols]
            runs = stretches(home)
            values = [_pack([c[a:z] for c in cols], n[a:z].astype(np.int32)) for a, z in runs]
            yield pa.RecordBatch.from_arrays([pa.array(home[[a for a, _ in runs]], pa.int64()), pa.array([kind] * len(runs), pa.int32()), pa.array(values, pa.binary())], ["bucket", "kind", "rows"])

    def merge(batches):
        for home, values in _by_bucket(batches):
            parts = [_unpack(unparcel(v), width, np.int32) for v in values]
            *cols, n = [np.concatenate(x) for x in zip(*parts, strict=True)]
            out = []
            for depth in (1,) if kind == 1 else range(2, DEPTH + 1):
                ok = cols[depth] != NONE
                cols, n = [c[ok] for c in cols], n[ok]
                context = _chain(cols[1 : depth + 1])
                order = np.argsort(context)
                first, many = _runs(context[order])
                total = np.repeat(np.add.reduceat(n[order].astype(np.int64), first) if len(first) else first, many)
                order, total = order[total >= LEAST], total[total >= LEAST]  # longer contexts are seen no more often
                cols, n, context = [c[order] for c in cols], n[order], context[order]
                key = _mix(context, cols[0])
                by = np.argsort(key)
                first, _ = _runs(key[by])
                at, sums = by[first], np.add.reduceat(n[by].astype(np.int64), first) if len(first) else first
                apart = (sums >= OWN) & (cols[0][at] != LOW)
                at, sums = at[apart], sums[apart]
                by = np.argsort(context[at])
                at, sums = at[by], sums[by]
                parent = _chain(cols[1:depth]) if depth > 1 else context
                out += [cols[0][at], cols[1][at], sums, total[at], context[at], parent[at]]
            kinds = len(out) // 6
            value = _pack([out[6 * k + j] for k in range(kinds) for j in (0, 1)], *(out[6 * k + j] for k in range(kinds) for j in (2, 3, 4, 5)))
            yield pa.RecordBatch.from_arrays([pa.array([home]), pa.array([kind], pa.int32()), pa.array([value], pa.binary())], ["bucket", "kind", "rows"])

    sent = training.select(text).mapInArrow(send, _PARCEL)
    return settled(by_home(sent, F.col("bucket"), buckets // 4).sortWithinPartitions("bucket").mapInArrow(merge, _PARCEL))


def _levels(rows: pa.RecordBatch, kinds: int) -> list[tuple[np.ndarray, ...]]:
    """Of each depth: next symbol, word before, count, context's count, context, parent."""
    got = _unpack(rows, 2 * kinds, *[np.int64, np.int64, np.uint64, np.uint64] * kinds)
    return [(*got[2 * k : 2 * k + 2], *got[2 * kinds + 4 * k : 2 * kinds + 4 * k + 4]) for k in range(kinds)]


def _states(heads: np.ndarray, buckets: int, key: np.ndarray, gain: np.ndarray, mine: np.ndarray, state: np.ndarray, rest: np.ndarray, value: np.ndarray | None = None) -> pa.RecordBatch:
    """A parcel of states, all of the heads' home: own entries and contexts, each by its hash; mine: the entries of contexts that are states; value: the log10 probabilities."""
    a, b, home = np.argsort(key), np.argsort(state), int(_deal(heads[:1], buckets)[0]) if len(heads) else 0
    value = np.empty(0) if value is None else value[a]
    packed = _pack([], key[a], gain[a].astype(np.float32), mine[a].astype(np.uint8), state[b], rest[b].astype(np.float32), value.astype(np.float32))
    return pa.RecordBatch.from_arrays([pa.array([home]), pa.array([0], pa.int32()), pa.array([packed], pa.binary())], ["bucket", "kind", "rows"])


_STATE = (np.uint64, np.float32, np.uint8, np.uint64, np.float32, np.float32)


def _sheaf(columns: list[np.ndarray], first: np.ndarray, text: np.ndarray, *more: np.ndarray) -> bytes:
    """Distinct questions, and the texts that ask them in the same order; first: where another question begins."""
    return _pack(columns, *more, np.packbits(first), text.astype(np.uint8), (text >> 8).astype(np.uint8), (text >> 16).astype(np.uint16))


class _Sums:
    """Sums of each text of a batch: of rare words' log10 probabilities, of those known, and of what states add."""

    def __init__(self):
        self.of = np.zeros((3, 0))

    def add(self, row: int, text: np.ndarray, weight: np.ndarray) -> int:
        """Bytes that this takes more."""
        sums, had = np.bincount(text, weights=weight), self.of.shape[1]
        if len(sums) > had:
            self.of = np.pad(self.of, ((0, 0), (0, len(sums) - had)))
        self.of[row, : len(sums)] += sums
        return self.of.itemsize * 3 * (self.of.shape[1] - had)

    def packed(self) -> bytes:
        base, known, gain = self.of
        off = gain - gain.astype(np.float32)
        far = np.flatnonzero(np.abs(off) > CLOSE)
        return _pack([], np.packbits(base != 0), base[base != 0], known[base != 0].astype(np.int32), np.packbits(gain != 0), gain[gain != 0].astype(np.float32), far, off[far])

    @staticmethod
    def unpacked(rows: pa.RecordBatch, texts: int) -> np.ndarray:
        out = np.zeros((3, texts))
        has, base, known, adds, gain, far, off = _unpack(rows, 0, np.uint8, np.float64, np.int32, np.uint8, np.float32, np.int64, np.float64)
        has, adds = (np.flatnonzero(np.unpackbits(x)) for x in (has, adds))
        out[0, has], out[1, has], out[2, adds] = base, known, gain
        out[2, far] += off
        return out


class _Tables:
    """Answers questions to word counts and states."""

    def __init__(self, tables):
        self.words: list[pa.RecordBatch] = []
        states: list = []
        for rows in tables:
            if rows.schema.names[0] == "word":
                self.words.append(rows)
            else:
                states.append(_unpack(rows, 0, *_STATE))
        self.key, self.gain, _, self.state, self.rest, self.value = [np.concatenate(x) for x in zip(*states, strict=True)] if states else [np.empty(0, k) for k in _STATE]
        for key, *values in (("key", "gain", "value"), ("state", "rest")):
            order = np.argsort(getattr(self, key))
            for name in (key, *values):
                if len(getattr(self, name)):
                    setattr(self, name, getattr(self, name)[order])

    @cached_property
    def count(self) -> dict[bytes, int]:
        return {w: n for rows in self.words for w, n in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)}

    @cached_property
    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        key = np.concatenate([np.empty(0, np.int64), *(_hashes(rows.column(0)) for rows in self.words)])
        order = np.argsort(key, kind="stable")
        return key[order], np.concatenate([np.empty(0, np.int64), *(rows.column(1).to_numpy() for rows in self.words)])[order]

    def __call__(self, rows: pa.RecordBatch) -> pa.Array:
        name = rows.schema.names[0]
        if name == "hash":
            k, there = _held(self.hashed[0], rows.column(0).to_numpy())
            return pa.array(np.where(there, self.hashed[1][k], 0) if len(self.hashed[1]) else np.zeros(len(k), np.int64))
        nxt, word = _unpack(rows, 2)
        context = _chain([word])
        out = np.full(len(nxt), ADDED)
        k, is_state = _held(self.state, context)
        out[is_state] += self.rest[k[is_state]]
        k, own = _held(self.key, _mix(context, nxt))
        out[own] = self.value[k[own]]
        return pa.array(out)

    def gains(self, cols: list[np.ndarray]) -> np.ndarray:
        """What the longest state adds for each pair or window (next symbol, words before): to the root, or to the pair's state."""
        out, at, context = np.zeros(len(cols[0])), np.arange(len(cols[0])), _chain(cols[1:2])
        for depth in range(1, len(cols)):
            if depth > 1:
                there = cols[depth][at] != NONE
                at = at[there]
                context = _mix(context[there], cols[depth][at])
            if depth == 1 and len(cols) > 2:
                continue
            k, is_state = _held(self.state, context)
            out[at[is_state]] += self.rest[k[is_state]]
            asks = np.flatnonzero(cols[0][at] != NONE)
            k, own = _held(self.key, _mix(context[asks], cols[0][at[asks]]))
            out[at[asks[own]]] = self.gain[k[own]]
        return out

    def sums(self, rows: pa.RecordBatch, floor: float, to: _Sums) -> int:
        """Adds the answers to a batch's questions to its texts' sums; bytes that these take more."""
        width, words = divmod(len(rows.column(0)) - 4, 2)
        *asked, first, low, mid, high = _unpack(rows, width, *[np.uint8] * (words + 3), np.uint16)
        text = low + (mid.astype(np.int64) << 8) + (high.astype(np.int64) << 16)
        nth = np.cumsum(np.unpackbits(first, count=len(text)), dtype=np.int64) - 1
        if not words:
            return to.add(2, text, self.gains(asked)[nth])
        count = np.array([self.count.get(w, 0) for w in asked[0].tobytes().split(b" ")])[nth]
        return to.add(0, text, np.log10(count + ADD) - floor) + to.add(1, text, count > 0)


def _asked_table(counts: DataFrame, shift: int) -> DataFrame:
    """A table's parcels as those who ask meet them."""
    return counts.select((F.col("bucket") + shift).alias("home"), F.lit(TABLE).alias("kind"), F.lit(0).cast("long").alias("batch"), F.col("bucket").cast("int").alias("bucket"), "rows")


def _pairs(candidates: DataFrame, counts: DataFrame, ship, buckets: int) -> DataFrame:
    """States of one word; an entry of a context that isn't retained has the root's probability."""

    def ask(batches):
        for b in batches:
            for home, value in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                nxt = _levels(unparcel(value), 1)[0][0]
                rare = np.unique(nxt[nxt >= RARE])
                at = rare % buckets
                order = np.argsort(at, kind="stable")
                rare, at = rare[order], at[order]
                runs = stretches(at)
                yield asked([int(at[a]) for a, _ in runs], QUESTION, home, [parcel(pa.RecordBatch.from_arrays([pa.array(rare[a:z])], ["hash"])) for a, z in runs])
                yield asked([home], REST, home, [value])

    def finish(rest, answers):
        t = _ready(ship)
        nxt, word, n, total, context, _ = _levels(rest, 1)[0]
        rare = np.unique(nxt[nxt >= RARE])
        rare = rare[np.argsort(rare % buckets, kind="stable")]
        root = t.known(nxt)
        many = nxt >= RARE
        by = np.argsort(rare)
        count = np.concatenate([np.empty(0), *(x.to_numpy() for x in answers)])[by]
        root[many] = np.log10(count[np.searchsorted(rare[by], nxt[many])] + ADD) - t.floor
        parent = 10**root
        keep, own, share = retained(context, n, total, parent)
        first, _ = _runs(context)
        held = keep[first] if len(first) else np.empty(0, bool)
        value = np.log10(np.where(keep, own, parent))
        return _states(context, buckets, _mix(context, nxt), value - root, keep, context[first][held], share[held], value)

    own = candidates.mapInArrow(ask, ASKED).unionAll(_asked_table(counts, 0))
    return settled(answered(own, _Tables, finish, _PARCEL, buckets // 4))


def _longer(candidates: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    """States of two words and more."""

    def questions(nxt, word):
        at, _, home, order, first = _distinct([nxt, word], buckets, "stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(first) - 1
        return at, home, place

    def ask(batches):
        for b in batches:
            for home, value in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                nxt, word = _levels(unparcel(value), DEPTH - 1)[0][:2]
                at, to, _ = questions(nxt, word)
                runs = stretches(to)
                yield asked([int(to[a]) for a, _ in runs], QUESTION, home, [_pack([nxt[at[a:z]], word[at[a:z]]]) for a, z in runs])
                yield asked([home], REST, home, [value])

    def finish(rest, answers):
        levels = _levels(rest, DEPTH - 1)
        key, gain, state, shares = [], [], [], []
        before = None
        for nxt, word, n, total, context, parent in levels:
            if before is None:
                pair = np.concatenate([np.empty(0), *(x.to_numpy() for x in answers)])[questions(nxt, word)[2]]
                p = 10**pair
            else:
                p, pair = (x[_held(before[0], _mix(parent, nxt))[0]] if len(nxt) else np.empty(0) for x in before[1:])
            keep, own, share = retained(context, n, total, p)
            first, _ = _runs(context)
            held = keep[first] if len(first) else np.empty(0, bool)
            code = _mix(context, nxt)
            for out, x in ((key, code[keep]), (gain, (np.log10(own) - pair)[keep]), (state, context[first][held]), (shares, share[held])):
                out.append(x)
            order = np.argsort(code)
            before = code[order], np.where(keep, own, p)[order], pair[order]
        key, gain, state, shares = map(np.concatenate, (key, gain, state, shares))
        return _states(levels[0][4], buckets, key, gain, np.ones(len(key), bool), state, shares)

    own = candidates.mapInArrow(ask, ASKED).unionAll(_asked_table(pairs, 0))
    return settled(answered(own, _Tables, finish, _PARCEL, buckets // 4))


class Tree:
    """The root, the states of one word (`pairs`) and of more (`longer`)."""

    def __init__(self, tokens: int, words: Words, ship: list, pairs: DataFrame, longer: DataFrame, buckets: int):
        self.tokens, self.words, self.ship, self.pairs, self.longer, self.buckets = tokens, words, ship, pairs, longer, buckets
        self.radix, self.root = words.radix, words.root

    @cached_property
    def _seen(self) -> _Tables:
        """To look at small trees: collects the states of one word."""
        return _Tables(unparcel(r.rows) for r in self.pairs.select("rows").collect())

    @property
    def state(self) -> list[np.ndarray]:
        every = np.arange(self.radix - 1)
        return [every[_held(self._seen.state, _chain([every]))[1]]]

    @property
    def rest(self) -> list[np.ndarray]:
        return [self._seen.rest[_held(self._seen.state, _chain(self.state))[0]]]

    def lookup(self, depth: int, context: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """log10 probabilities of numbered words behind numbered words (depth 0)."""
        out = self._seen(unparcel(_pack([nxt, context]))).to_numpy()
        return np.where(out >= ADDED / 2, self.root[nxt] + out - ADDED, out)


def fit(training: DataFrame, text: str = "text") -> tuple[Tree, DataFrame]:
    """The tree, and the parcels of all word counts."""
    spark = training.sparkSession
    buckets = 4 * partitions(training)
    counts = word_counts(training, text, buckets)
    sums = counts.agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
    tokens, distinct = sums.n or 0, sums.v or 0
    least = max(2, NUMBERED * tokens)

    def often(batches):
        for b in batches:
            for value in b.column(0):
                rows = unparcel(value.as_buffer())
                yield rows.filter(pc.greater_equal(rows.column(1), pa.scalar(int(np.ceil(least)), pa.int64())))

    found = counts.select("rows").mapInArrow(often, "word binary, n long").collect()  # at most 1 / NUMBERED rows
    words = Words(tokens, distinct, sorted(((bytes(r.word), r.n) for r in found), key=lambda x: (-x[1], x[0]))[:MOST])
    hashes = lambda rows, least: _hashes(rows.column(0).filter(pc.greater_equal(rows.column(1), least)))
    words.own, words.least = _filters(counts, buckets, lambda rows: [hashes(rows, OWN), hashes(rows, LEAST)]) or [Filter(buckets, [])] * 2
    ship = [spark.sparkContext.broadcast(words)]
    _released(spark)
    seconds = _candidates(training, ship, text, buckets, 1)
    _released(spark)

    def frequent(rows):
        nxt, _, n, _, context, _ = _levels(rows, 1)[0]
        return [_mix(context, nxt)[n >= LEAST]]

    words.often = (_filters(seconds, buckets, frequent) or [Filter(buckets, [])])[0]
    pairs = _pairs(seconds, counts, ship, buckets)
    forget(seconds)
    _released(spark)
    ship.append(spark.sparkContext.broadcast({"often": words.often}))
    further = _candidates(training, ship, text, buckets, 2)
    _released(spark)
    longer = _longer(further, pairs, buckets)
    forget(further)
    _released(spark)

    def states(rows):
        key, _, mine, state, _, _ = _unpack(rows, 0, *_STATE)
        return [state, key[mine > 0]]

    words.one, words.mine = _filters(pairs, buckets, states) or [Filter(buckets, [])] * 2
    words.deep, words.further = _filters(longer, buckets, states) or [Filter(buckets, [])] * 2
    ship.append(spark.sparkContext.broadcast({k: getattr(words, k) for k in ("one", "mine", "deep", "further")}))
    return Tree(tokens, words, ship, pairs, longer, buckets), counts


def scored(docs: DataFrame, tree: Tree, counts: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc, n_tokens, n_known, base_score, score."""
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == doc)
    buckets, parts, floor = tree.buckets, tree.buckets // 4, tree.words.floor
    ship, names = tree.ship, [doc, "n_tokens", "n_known", "base_score", "score"]

    def ask(batches):
        t, own_part = _ready(ship), TaskContext.get().partitionId()
        for serial, part in enumerate(_slices(batches, text, TEXTS)):
            batch = own_part << 32 | serial
            column = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
            words, symbol, code, size, at, ids, before = t.numbers(column(text))
            own = np.repeat(np.arange(len(size)), size)
            yield rare_words(batch, words, symbol, code, own)
            for shift, (cols, ok) in enumerate(questions(t, windows(t, at, ids, before)), 1):
                place, _, home, order, first = _distinct(cols, buckets)
                cols, asks, runs = [c[place] for c in cols], own[ok][order], stretches(home)
                begin = np.append(np.flatnonzero(first), len(first))
                values = [_sheaf([c[a:z] for c in cols], first[begin[a] : begin[z]], asks[begin[a] : begin[z]]) for a, z in runs]
                yield asked([int(home[a]) + shift * buckets for a, _ in runs], QUESTION, batch, values)
            sums = [np.bincount(own, weights=w[code], minlength=len(size)) for w in (symbol < RARE, t.known(symbol))]
            yield asked([batch % buckets], REST, batch, [parcel(pa.RecordBatch.from_arrays([column(doc), pa.array(size), pa.array(sums[0].astype(np.int64)), pa.array(sums[1])], names[:4]))])

    def rare_words(batch, words, symbol, code, own):
        """Questions for words without a number."""
        rare = np.flatnonzero(symbol >= RARE)
        rare = rare[np.argsort(symbol[rare] % buckets, kind="stable")]
        rank = np.full(len(symbol), -1)
        rank[rare] = np.arange(len(rare))
        nth, runs = rank[code], stretches(symbol[rare] % buckets)
        own, nth = own[nth >= 0], nth[nth >= 0]
        order = np.argsort(nth)
        own, nth, asks = own[order], nth[order], words.take(pa.array(rare)).to_pylist()
        begin = np.searchsorted(nth, np.arange(len(rare) + 1))
        first = np.concatenate([[True], nth[1:] != nth[:-1]])[: len(nth)]
        values = [_sheaf([], first[begin[a] : begin[z]], own[begin[a] : begin[z]], np.frombuffer(b" ".join(asks[a:z]), np.uint8)) for a, z in runs]
        return asked([int(symbol[rare[a]] % buckets) for a, _ in runs], QUESTION, batch, values)

    def questions(t, every):
        """Pairs and windows that are asked for, and whose they are.

        A token asks its pair or, if no state has that for its own, its state's factor.  A window reaches as far as its longest
        state, and has a next symbol only if a state may have that for its own; else its factors are all that is asked.
        """
        word = _chain(every[1:2])
        home = _deal(word, buckets)
        state = (every[1] != NONE) & t.one(home, word)
        own = np.zeros(len(state), bool)
        own[state] = t.mine(home[state], _mix(word[state], every[0][state]))
        yield [np.where(own, every[0], NONE)[state], every[1][state]], state
        far = np.flatnonzero(every[2] != NONE)
        cols = [c[far] for c in every]
        context = _chain(cols[1:3])
        home, reach, mine = _deal(context, buckets), np.zeros(len(far), np.int8), np.zeros(len(far), bool)
        for depth in range(2, DEPTH + 1):
            if depth > 2:
                context = _mix(context, cols[depth])
            there = (cols[depth] != NONE) & t.deep(home, context)
            reach[there] = depth
            mine |= there & t.further(home, _mix(context, cols[0]))
        cols[0] = np.where(mine, cols[0], NONE)
        ok = np.zeros(len(state), bool)
        ok[far] = reach > 0
        yield [c[reach > 0] if d < 3 else np.where(reach < d, NONE, c)[reach > 0] for d, c in enumerate(cols)], ok

    def replies(batches):
        now, tables, table, held, size = None, [], None, {}, 0
        for home, kind, batch, bucket, value in each(batches):
            if kind == REST:
                yield bucket, REST, batch, bucket, value
                continue
            if home != now:
                now, tables, table = home, [], None
            if kind == TABLE:
                tables.append(value)
                continue
            if table is None:
                table, tables = _Tables(unparcel(v) for v in tables), []
            size += table.sums(unparcel(value), floor, held.setdefault(batch, _Sums()))
            if size > HELD:
                yield from ((0, QUESTION, b, 0, sums.packed()) for b, sums in held.items())
                held, size = {}, 0
        yield from ((0, QUESTION, b, 0, sums.packed()) for b, sums in held.items())

    def add(batches):
        yield from gathered(replies(batches))

    def finish(batches):
        now, sums = None, []
        for _, kind, batch, _, value in each(batches):
            if batch != now:
                now, sums = batch, []
            if kind == QUESTION:
                sums.append(value)
                continue
            own, size, known, base = unparcel(value).columns
            more = sum((_Sums.unpacked(unparcel(v), len(size)) for v in sums), np.zeros((3, len(size))))
            base = base.to_numpy() + more[0]
            yield pa.RecordBatch.from_arrays([own, size, pa.array(known.to_numpy() + more[1].astype(np.int64)), pa.array(base), pa.array(base + more[2])], names)

    sent = docs.select(doc, text).mapInArrow(ask, ASKED)
    for k, rows in enumerate((counts, tree.pairs, tree.longer)):
        sent = sent.unionAll(_asked_table(rows, k * buckets))
    met = by_home(sent, F.col("home"), parts).sortWithinPartitions("home", "kind").mapInArrow(add, ASKED)
    schema = f"`{doc}` {kind}, n_tokens long, n_known long, base_score double, score double"
    return by_home(met, F.col("batch"), parts).sortWithinPartitions("batch", "kind").mapInArrow(finish, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(bucket(10) == 0, F.lit(False))
    tree, counts = fit(docs.where(~held))
    out = scored(docs, tree, counts)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(tree.tokens).cast("long").alias("train_tokens"), "base_score", "score")
