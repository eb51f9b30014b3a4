"""Near-copies by n-gram Jaccard similarity: universe-partition pigeonhole with one-deletion neighbourhoods.

A document is the set of its distinct word shingles (64-bit hashes).  Sets of a size band that are similar enough differ
in at most H shingles.  Their universe is cut by a hash into m segments; among m = H + 1 + k segments at least k + 1 are
the same in both sets.  What a segment is allotted decides how it is indexed: nothing, its own key (band, segment, sum of
its mixed hashes), or its key and its one-deletion neighbourhood.  By the pigeonhole a set finds all its partners if its
allotments (0, 1 and 2) sum to H + 1 or more.

1. All sets index every segment's key.  A key that few sets share (`HOT`) gives all its pairs; a key that many share is
   too dear and gives none.  A set with k hot segments at most still meets all its partners, at k + 1 keys less the hot
   ones: pairs that meet less often go.
2. Sets with more hot segments, the heavy ones, index one-deletion neighbourhoods too.  The cost of each key, how many
   heavy sets hold it, allots each segment the most that it can afford.
3. Sets whose affordable allotments don't sum to H + 1 (near-copies by the hundred) are left.  Two of them that are similar
   share a hot key.  Hot keys agree on centres; members are rewritten as their differences to their key's centre, which
   leaves the distance of any two of them as it is but takes away all that makes them alike.
   Two members linked to their centre are one component already.  For any other pair more than about half of one's
   differences are the other's too, so the rarest of them meet in a prefix-filtered join.

Candidates must pass a parity sketch (a lower bound of the difference), then every one is verified on whole sets; links of
verified pairs become components.  Equal sets are one set from the start (their digest), so copies cost nothing.  No
group is gathered and no group's pairs are made: what leaves a key is bounded by `HOT` times its sets.

Defined results: null, empty and wordless texts have no shingles and link with nothing; texts of fewer words than a
shingle have one, all their words; a doc_id's rows with different texts are one node of the graph, as the doc_id is what
results name (a null doc_id ties nothing); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded, by_home, forget, parcel, partitions, portions, raw, settled, sliced, table, unparcel, words
from tallyforge.llm.graph import components

WIDTH, PERCENT = 4, 85
#: A key that more sets share is hot.
HOT = 8
#: Rows of a table of 64-bit or 128-bit keys that may be broadcast (16 MB at most), beyond it a shuffle join does the same.
SMALL = 1_000_000
#: Each band's largest set has this share more shingles than its least.
SPREAD = 1.19
#: Shingles, or rows of pairs, that a task works on at once: bounds its memory.
PORTION = 500_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The text's distinct shingles, sorted."""
    ws = words(text)
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * _A + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else b""


def sketch(s: np.ndarray) -> bytes:
    """Parities of the set's shingles in 2 to 4 bits for each: sets whose sketches differ in d bits differ in d shingles or more."""
    if not len(s):
        return b""
    bits = max(64, 1 << (2 * len(s) - 1).bit_length())
    seats = (mix(s ^ _B) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(seats, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded to the other's length."""
    short, long = sorted((a, b), key=len)
    x, bits = int.from_bytes(long, "little"), 8 * len(long)
    while bits > 8 * len(short):
        bits //= 2
        x = (x & ((1 << bits) - 1)) ^ (x >> bits)
    return (x ^ int.from_bytes(short, "little")).bit_count()


@dataclass(frozen=True)
class Band:
    """Pairs whose larger set has between low and high shingles, low included."""

    level: int
    low: int
    high: int
    differ: int

    @property
    def slack(self) -> int:
        return max(1, (self.differ + 1) // 8)

    @property
    def segments(self) -> int:
        return self.differ + 1 + self.slack

    @property
    def spare(self) -> int:
        """Hot segments that a set may leave out; one less where two of a set's keys might fall together by chance."""
        return self.slack - (self.slack > 1)


@lru_cache(maxsize=8)
def all_bands(percent: int = PERCENT) -> tuple[Band, ...]:
    out, low = [], 1
    while low < 1 << 40:
        high = max(low, int(low * SPREAD))
        out.append(Band(len(out), low, high, 2 * high * (100 - percent) // (100 + percent)))
        low = high + 1
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def bands(n: int, percent: int = PERCENT) -> tuple[Band, ...]:
    """The bands of all partners that a set of n shingles can have as the smaller or the larger one; sets that may not differ have none."""
    return tuple(b for b in all_bands(percent) if b.high >= n and b.low <= n * 100 // percent and b.differ)


def signatures(sets: list[np.ndarray], own: list[Band], deletions: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, which set, segment, 1 for a deletion) of each set's segments in its band, with one-deletion neighbourhoods or without."""
    m = np.array([b.segments for b in own], np.int64)
    level = np.array([b.level for b in own], np.uint64)
    base = np.cumsum(m) - m
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seat = (mix(element + _A) >> np.uint64(20)).astype(np.int64) % m[owner] + base[owner]
    value = mix(element ^ _C)
    low, high = (value & np.uint64(0xFFFFFFFF)).astype(np.float64), (value >> np.uint64(32)).astype(np.float64)
    total = int(m.sum())
    add = lambda w: np.bincount(seat, weights=w, minlength=total).astype(np.uint64)
    sums = add(low) + (add(high) << np.uint64(32))
    holder = np.repeat(np.arange(len(sets)), m)
    place = np.arange(total) - base[holder]
    label = mix(place.astype(np.uint64) * _A + level[holder] * _B)
    keys, of, segment, role = mix(label + sums), holder, place, np.zeros(total, np.int8)
    if deletions:
        keys = np.concatenate([keys, mix(label[seat] + sums[seat] - value)])
        of, segment, role = np.concatenate([of, owner]), np.concatenate([segment, place[seat]]), np.concatenate([role, np.ones(len(seat), np.int8)])
    return keys, of, segment, role


_LOW = np.int64((1 << 48) - 1)


def tag(d: bytes) -> int:
    """A digest's first six bytes as a number; digests that share it are kept apart when pairs get their digests back."""
    return int.from_bytes(d[:6], "big")


#: Key ranges that a task compares one after the other.
RANGES = 16


def _send(buckets: int, keys: np.ndarray, **columns: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Parcels of (key, columns), one for each bucket of keys, in the order of their key ranges."""
    bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    order = np.argsort(bucket << 4 | (low >> np.uint32(28)).astype(np.int64), kind="stable")
    bucket, names = bucket[order], ["key", *columns]
    cols = [low[order], *(c[order] for c in columns.values())]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    at, values = [], []
    for lo, hi in zip(starts, [*starts[1:], len(bucket)], strict=True):
        at.append(int(bucket[lo]))
        values.append(parcel(pa.RecordBatch.from_arrays([pa.array(cols[0][lo:hi]), *(pa.array(c[lo:hi]).dictionary_encode() for c in cols[1:])], names)))
    return at, values


def _ranges(parcels: list[dict[str, np.ndarray]], bucket: int) -> Iterator[dict[str, np.ndarray]]:
    """One key range of all of a bucket's parcels after the other; keys get their bucket."""
    ends = [np.searchsorted(p["key"] >> np.uint32(28), np.arange(RANGES + 1)) for p in parcels]
    for k in range(RANGES):
        out = {name: np.concatenate([p[name][e[k] : e[k + 1]] for p, e in zip(parcels, ends, strict=True)]) for name in parcels[0]}
        if len(out["key"]):
            yield out | {"key": out["key"].astype(np.int64) | np.int64(bucket) << np.int64(32)}


def _by_bucket(batches, skip=None) -> Iterator[dict[str, np.ndarray]]:
    """The postings of one bucket after the other, by key ranges, from rows (bucket, rows, ...) sorted by bucket; skip gets batches of rows without one."""
    now, parcels = None, []
    for b in batches:
        at, rows = b.column(0), b.column(1)
        for bucket, value in zip(at.to_pylist(), rows, strict=True):
            if bucket is None:
                continue
            if bucket != now and parcels:
                yield from _ranges(parcels, now)
                parcels = []
            now, got = bucket, unparcel(value.as_buffer())
            parcels.append({n: (c.dictionary_decode() if pa.types.is_dictionary(c.type) else c).to_numpy(zero_copy_only=False) for n, c in zip(got.schema.names, got.columns, strict=True)})
        if skip and at.null_count:
            skip(b.filter(at.is_null()))
    if parcels:
        yield from _ranges(parcels, now)


def _groups(order: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal rows of sorted columns begin."""
    new = np.zeros(len(order[0]), bool)
    new[:1] = True
    for c in order:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _all_pairs(tags: np.ndarray, begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """All pairs of each group of `HOT` members at most."""
    out = [np.empty((0, 2), np.int64)]
    for n in np.unique(many[many > 1]).tolist():
        rows = begin[many == n][:, None] + np.arange(n)
        i, j = np.triu_indices(n, 1)
        out.append(np.stack([tags[rows[:, i]].ravel(), tags[rows[:, j]].ravel()], axis=1))
    return np.concatenate(out)


_BASE, _PAIR, _HEAT = 0, 1, 2


def _blocks(rows: np.ndarray, size: int = 50_000):
    return (rows[lo : lo + size] for lo in range(0, len(rows), size))


def _met(postings: Iterator[dict[str, np.ndarray]], slack: np.ndarray):
    """Pairs (x, y, level, times they met, slack) of cold keys and (x, level, hot keys, slack) of sets at hot ones, for a task."""
    pairs, heat = [np.empty((0, 3), np.int64)], [np.empty((0, 2), np.int64)]

    def counted(parts):
        rows = np.concatenate(parts)
        return np.unique(rows[:, :-1], axis=0, return_inverse=True), rows[:, -1]

    def added(parts):
        (rows, where), n = counted(parts)
        return np.column_stack([rows, np.bincount(where.ravel(), weights=n, minlength=len(rows)).astype(np.int64)]) if len(rows) else np.concatenate(parts)

    for got in postings:
        order = np.lexsort((got["tag"], got["key"]))
        key, who = got["key"][order], got["tag"][order]
        one = _groups([key, who])
        key, who = key[one], who[one]
        begin = _groups([key])
        many = np.diff(np.append(begin, len(key)))
        cold = many <= HOT
        met = _all_pairs(who, begin[cold], many[cold])
        pairs.append(np.column_stack([met, np.ones(len(met), np.int64)]))
        hot = who[np.repeat(~cold, many)]
        heat.append(np.column_stack([hot, np.ones(len(hot), np.int64)]))
        # counted again now and then, so that what a task holds is its distinct pairs
        if sum(map(len, pairs)) > 2 * len(pairs[0]) + PORTION:
            pairs = [added(pairs)]
        if sum(map(len, heat)) > 2 * len(heat[0]) + PORTION:
            heat = [added(heat)]
    for rows in _blocks(added(pairs)):
        level = rows[:, 0] >> 48
        yield _PAIR, rows[:, 0] & _LOW, rows[:, 1] & _LOW, level, rows[:, 2], slack[level]
    for rows in _blocks(added(heat)):
        level = rows[:, 0] >> 48
        yield _HEAT, rows[:, 0] & _LOW, None, level, rows[:, 1], slack[level]


def _first(docs: DataFrame, doc: str, text: str, width: int, percent: int) -> DataFrame:
    """Each row's set (kind 0: d, h, n, digest, sketch), candidates (kind 1: x, y, level, times, slack), hot keys (kind 2: x, level, times, slack)."""
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == doc)
    parts = partitions(docs)

    def send(batches):
        for b in sliced(batches):
            rows = b.num_rows
            sets = [shingles(t, width) for t in raw(b, text)]
            digests = [digest(s) for s in sets]
            own = [pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), b.column(b.schema.get_field_index(doc)), b.column(b.schema.get_field_index("_h")), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array([sketch(s) for s in sets], pa.binary())]
            names = ["bucket", "rows", "d", "h", "n", "digest", "sketch"]
            yield pa.RecordBatch.from_arrays(own, names)
            unique = {d: s for d, s in zip(digests, sets, strict=True) if d}
            entries = [(tag(d), s, x) for d, s in unique.items() for x in bands(len(s), percent)]
            for lo, hi in portions([len(e[1]) for e in entries], PORTION):
                tags, chosen, bs = zip(*entries[lo:hi], strict=True)
                keys, of, _, _ = signatures(list(chosen), list(bs), False)
                who = np.array(tags, np.int64) | np.array([x.level for x in bs], np.int64) << 48
                at, values = _send(parts, keys, tag=who[of])
                n = len(at)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(values, pa.binary()), *(pa.nulls(n, c.type) for c in own[2:])], names)

    slack = np.array([b.slack for b in all_bands(percent)], np.int64)
    columns = ["kind", "d", "h", "n", "digest", "sketch", "x", "y", "level", "times", "slack"]

    def meet(batches):
        passing = []
        types = None

        def listed(batches):
            nonlocal types
            for b in batches:
                types = types or b.schema
                yield b

        for got in _met(_by_bucket(listed(batches), passing.append), slack):
            k, x, y, *rest = got
            n = len(x)
            yield pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int32()), *(pa.nulls(n, types.field(c).type) for c in columns[1:6]), pa.array(x), pa.nulls(n, pa.int64()) if y is None else pa.array(y), *(pa.array(r.astype(np.int64)) for r in rest)], columns)
        for b in passing:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([_BASE] * n, pa.int32()), *b.columns[2:], *(pa.nulls(n, pa.int64()) for _ in range(5))], columns)

    sent = bounded(docs.select(doc, text, F.xxhash64(text).alias("_h"))).mapInArrow(send, f"bucket long, rows binary, d {kind}, h long, n long, digest binary, sketch binary")
    dealt = by_home(sent, F.coalesce("bucket", F.xxhash64("h", "d")), parts).sortWithinPartitions("bucket")
    return settled(dealt.mapInArrow(meet, f"kind int, d {kind}, h long, n long, digest binary, sketch binary, x long, y long, level long, times long, slack long"))


def _shipped(keys: DataFrame) -> DataFrame:
    """A settled table of 64-bit or 128-bit keys, to be broadcast if it is small; beyond that the join shuffles."""
    return F.broadcast(keys) if keys.count() <= SMALL else keys


def _sets(docs: DataFrame, wanted: DataFrame, doc: str, text: str, width: int) -> DataFrame:
    """digest, n, s: the whole shingle sets of the wanted ones (digest, rep), from the texts of their documents of the least id."""

    def run(batches):
        for b in sliced(batches):
            sets = [shingles(t, width) for t in raw(b, text)]
            yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["digest", "n", "s"])

    keys = settled(wanted.select("digest", F.xxhash64("rep").alias("_k")).distinct())
    small = keys.count() <= SMALL
    ship = F.broadcast if small else (lambda x: x)
    found = docs.select(text, F.xxhash64(doc).alias("_k")).join(ship(keys.select("_k").distinct()), "_k", "left_semi").select(text)
    out = settled(bounded(found).mapInArrow(run, "digest binary, n long, s array<long>").join(ship(keys.select("digest")), "digest", "left_semi").dropDuplicates(["digest"]))
    forget(keys)
    return out


def _near(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of tags as pairs of digests (a < b) whose sizes and sketches allow a link; a tag that two sets share stands for both."""
    left, right = (reps.select(F.col("tag").alias(t), F.col("digest").alias(f"d{k}"), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"k{k}")) for k, t in enumerate("xy"))
    both = pairs.select("x", "y").join(left, "x").join(right, "y").where(f"d0 <> d1 AND 100 * least(n0, n1) >= {percent} * greatest(n0, n1)")

    def run(batches):
        for b in batches:
            d0, d1, n0, n1, k0, k1 = (b.column(i).to_pylist() for i in range(6))
            kept = [(min(p, q), max(p, q)) for p, q, m, n, x, y in zip(d0, d1, n0, n1, k0, k1, strict=True) if (100 + percent) * apart(x, y) <= (100 - percent) * (m + n)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in kept], pa.binary()) for k in (0, 1)], ["a", "b"])

    return both.select("d0", "d1", "n0", "n1", "k0", "k1").mapInArrow(run, "a binary, b binary").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough, on whole sets."""
    left, right = (sets.select(F.col("digest").alias(r), F.col("s").alias(f"s{k}")) for k, r in enumerate("ab"))
    common = pairs.join(left, "a").join(right, "b").select("a", "b", (F.size("s0") + F.size("s1")).alias("n"), F.size(F.array_intersect("s0", "s1")).alias("i"))
    return common.where(f"100 * i >= {percent} * (n - i)").select("a", "b")


_HOT, _DEAR = 0, 1


def _neighbourhoods(own: DataFrame, parts: int, percent: int) -> DataFrame:
    """Heavy sets (tag, level, s) as candidates (x, y) and as dear segments: kind 0, hot (tag, level, segment, key), or kind 1, whose deletions are."""
    known = all_bands(percent)

    def send(batches):
        for b in sliced(batches):
            tags, levels = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            sets = [np.asarray(s, np.int64).view(np.uint64) for s in b.column(2).to_numpy(zero_copy_only=False)]
            for lo, hi in portions([len(s) for s in sets], PORTION // 4):
                keys, of, segment, role = signatures(sets[lo:hi], [known[k] for k in levels[lo:hi].tolist()], True)
                who = tags[lo:hi] | levels[lo:hi] << 48
                at, values = _send(parts, keys, tag=who[of], segment=segment.astype(np.int32), role=role)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(values, pa.binary())], ["bucket", "rows"])

    def meet(batches):
        for got in _by_bucket(batches):
            order = np.lexsort((got["tag"], got["role"], got["key"]))
            key, who, segment, role = (got[c][order] for c in ("key", "tag", "segment", "role"))
            one = _groups([key, role, who])
            key, who, segment, role = key[one], who[one], segment[one], role[one]
            begin = _groups([key])
            many = np.diff(np.append(begin, len(key)))
            gone = np.add.reduceat(role.astype(np.int64), begin)
            whole = many - gone
            pairs = [_all_pairs(who, begin[whole <= HOT], whole[whole <= HOT])]
            asked = (whole > 0) & (gone > 0)
            cheap = asked & (whole <= HOT) & (gone <= HOT)
            for f, d in np.unique(np.stack([whole[cheap], gone[cheap]], axis=1), axis=0).tolist():
                at = begin[cheap & (whole == f) & (gone == d)][:, None]
                i, j = (x.ravel() for x in np.meshgrid(np.arange(f), f + np.arange(d), indexing="ij"))
                pairs.append(np.stack([who[at + i].ravel(), who[at + j].ravel()], axis=1))
            met = np.concatenate(pairs) & _LOW
            met = np.unique(np.sort(met[met[:, 0] != met[:, 1]], axis=1), axis=0)
            for rows in _blocks(met):
                n = len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), *(pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["x", "y", "kind", "level", "segment", "key"])
            hot = np.flatnonzero(np.repeat(whole > HOT, many) & (role == 0))
            dear = np.flatnonzero(np.repeat(asked & ~cheap, many))
            for kind, rows in ((_HOT, hot), (_DEAR, dear)):
                for r in _blocks(rows):
                    n = len(r)
                    yield pa.RecordBatch.from_arrays([pa.array(who[r] & _LOW), pa.nulls(n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(who[r] >> 48), pa.array(segment[r].astype(np.int64)), pa.array(key[r])], ["x", "y", "kind", "level", "segment", "key"])

    sent = own.select("tag", "level", "s").mapInArrow(send, "bucket long, rows binary")
    return settled(by_home(sent, F.col("bucket"), parts).sortWithinPartitions("bucket").mapInArrow(meet, "x long, y long, kind int, level long, segment long, key long"))


def _most(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key with its most frequent value (ties: the least), counted in two steps so that no key's values are gathered."""
    return rows.groupBy(key, value).agg(F.count("*").alias("_n")).groupBy(key).agg(F.max_by(value, F.struct("_n", -F.col(value))).alias(value))


def _centred(met: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(c, x): the sets that neighbourhoods can't serve, as digests, each with the centres of its hot keys.

    Two sets of a key need a common centre, whichever it is.  A key begins with its member of the most hot keys; then sets
    take the centre of most of their keys, and keys the centre of most of their sets, so that a group of copies agrees on
    one.  Similar sets share more hot keys than k, so each set leaves out its k worst ones in an order that is the same for
    all: those most of whose members go by another centre, like empty segments, which unlike sets share.  The best of the
    keys that two sets share is then left out by neither.
    """
    spark = met.sparkSession
    sizes = F.broadcast(spark.createDataFrame([(b.level, b.segments, b.differ, b.spare) for b in all_bands(percent)], "level long, m long, differ long, spare long"))
    dear = met.where("kind is not null")
    each = dear.groupBy("x", "level", "segment").agg(F.max((F.col("kind") == _HOT).cast("long")).alias("hot")).groupBy("x", "level").agg(F.sum("hot").alias("hot"), F.count("*").alias("dear"))
    left = each.join(sizes, "level").where("(m - hot) + (m - dear) < differ + 1").select("x", "level", "hot", "spare")
    held = dear.where(f"kind = {_HOT}").select("x", "level", "key").join(left, ["x", "level"])
    centre = held.groupBy("key").agg(F.max_by("x", F.struct("hot", -F.col("x"))).alias("c"), F.count("*").alias("members")).select("key", "c", "members")
    now = settled(held.select("key", "x", "level", "spare").join(centre, "key"))
    rest = ["key", "x", "level", "spare", "members"]
    for _ in range(2):
        own = _most(now.where("members > 1"), "x", "c")
        agreed = _most(now.select("key", "x").join(own, "x"), "key", "c")
        last, now = now, settled(now.select(*rest).join(agreed, "key"))
        forget(last)
    own = _most(now.where("members > 1"), "x", "c").withColumnRenamed("c", "main")
    strange = now.join(own, "x").groupBy("key").agg(F.count_if(F.col("main") != F.col("c")).alias("strange"))
    worst = F.row_number().over(Window.partitionBy("x", "level").orderBy(F.desc("strange"), "key"))
    kept = now.join(strange, "key").withColumn("worst", worst).where("worst > spare AND members > 1")
    both = settled(kept.where("x <> c").select("c", "x").distinct())
    names = reps.select("tag", "digest")
    out = both.join(names.toDF("c", "cd"), "c").join(names.toDF("x", "xd"), "x").select(F.col("cd").alias("c"), F.col("xd").alias("x")).where("c <> x").distinct()
    out = settled(out)
    forget(now, both)
    return out


def _differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) among members (c, x) of centres: those linked to their centre, and pairs that share enough of their differences to it."""

    def run(batches):
        for b in sliced(batches):
            own, mid = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            gaps = [np.setxor1d(p, q, assume_unique=True) for p, q in zip(own, mid, strict=True)]
            ints = lambda v: pa.array(list(map(len, v)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ints(own), ints(mid), ints(gaps), pa.array(gaps, pa.list_(pa.int64()))], ["c", "x", "n", "m", "gap", "e"])

    joined = members.join(sets.select(F.col("digest").alias("x"), F.col("s").alias("s0")), "x").join(sets.select(F.col("digest").alias("c"), F.col("s").alias("s1")), "c")
    gaps = settled(joined.select("c", "x", "s0", "s1").mapInArrow(run, "c binary, x binary, n long, m long, gap long, e array<long>"))
    more, less = 100 + percent, 100 - percent
    linked = f"{more} * gap <= {less} * (n + m)"
    each = gaps.select("c", "x", "n", "gap", F.expr(linked).alias("inner"), F.explode("e").alias("e"))
    often = each.groupBy("c", "e").agg(F.count("*").alias("often"))
    seat = F.row_number().over(Window.partitionBy("c", "x").orderBy("often", "e")) - 1
    seated = settled(each.join(often, ["c", "e"]).withColumn("seat", seat).where("often > 1"))
    # a set that its centre isn't linked to asks with a prefix that holds one of the common differences, all sets answer with theirs
    ask = seated.where(f"NOT inner AND {percent} * {more} * seat <= {less} * n * (100 + {percent})").select("c", "e", *(F.col(c).alias(f"{c}0") for c in ("x", "n", "gap", "seat")))
    answer = seated.where(f"{more} * seat < 100 * gap").select("c", "e", *(F.col(c).alias(f"{c}1") for c in ("x", "n", "gap", "seat")))
    enough = f"x0 <> x1 AND 100 * least(n0, n1) >= {percent} * greatest(n0, n1) AND {more} * (gap0 + gap1 - 2 * least(gap0 - seat0, gap1 - seat1)) <= {less} * (n0 + n1)"
    pairs = ask.join(answer, ["c", "e"]).where(enough).select(F.least("x0", "x1").alias("a"), F.greatest("x0", "x1").alias("b"))
    out = settled(pairs.union(gaps.where(linked).select(F.least("c", "x"), F.greatest("c", "x"))).distinct())
    forget(gaps, seated)
    return out


def grouped(docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, tied: bool = True) -> DataFrame:
    """Per row: d, h (a hash of its text), n (shingles), digest, and node: the digest of its component, null without shingles.

    tied: a doc_id's sets are one node.
    """
    one = _first(docs, doc, text, width, percent)
    base = one.where(f"kind = {_BASE}").select("d", "h", "n", "digest")
    number = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    reps = settled(one.where(f"kind = {_BASE} AND n > 0").groupBy("digest").agg(F.min("d").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).withColumn("tag", number))
    heat = settled(one.where(f"kind = {_HEAT}").groupBy("x", "level").agg(F.sum("times").alias("hot"), F.first("slack").alias("slack")))
    hot0, hot1 = (heat.select(F.col("x").alias(t), "level", F.col("hot").alias(f"hot{k}")) for k, t in enumerate("xy"))
    often = one.where(f"kind = {_PAIR}").groupBy("x", "y", "level").agg(F.sum("times").alias("times"), F.first("slack").alias("slack"))
    spare = "(slack - CASE WHEN slack > 1 THEN 1 ELSE 0 END)"
    plain = often.join(hot0, ["x", "level"], "left").join(hot1, ["y", "level"], "left").where(f"times > {spare} - least(coalesce(hot0, 0), coalesce(hot1, 0))")
    pairs = settled(_near(plain.select("x", "y").distinct(), reps, percent))
    heavy = settled(heat.where(f"hot > {spare}").select(F.col("x").alias("tag"), "level"))
    forget(heat)
    more = []
    if heavy.limit(1).count():
        chosen = heavy.join(reps.select("tag", "digest", "rep"), "tag")
        own = _sets(docs, chosen.select("digest", "rep"), doc, text, width)
        met = _neighbourhoods(own.join(chosen.select("digest", "tag", "level"), "digest"), partitions(docs), percent)
        more.append(settled(_near(met.where("kind is null").select("x", "y").distinct(), reps, percent)))
        members = _centred(met, reps, percent)
        forget(met)
        if members.limit(1).count():
            more.append(_differences(members, own, percent))
        forget(own, members)
    for x in more:
        pairs = pairs.union(x)
    found = settled(pairs.distinct())
    ends = found.select(F.col("a").alias("digest")).union(found.select("b")).distinct()
    sets = _sets(docs, reps.select("digest", "rep").join(ends, "digest", "left_semi"), doc, text, width)
    edges = _verified(found, sets, percent)
    if tied:
        split = base.where("n > 0 AND d IS NOT NULL").groupBy("d").agg(F.min("digest").alias("a"), F.max("digest").alias("z")).where("a <> z").select("d", "a")
        edges = edges.union(base.join(split, "d").where("n > 0 AND a <> digest").select("a", F.col("digest").alias("b")).distinct())
    joined = components(edges)
    forget(found, sets, reps, heavy, *more)
    return base.join(joined.select(F.col("node").alias("digest"), F.col("component").alias("node")), "digest", "left").withColumn("node", F.when(F.col("n") > 0, F.coalesce("node", "digest")))


def links(docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: doc, n_shingles, component_id (the least doc of its component, its own without shingles)."""
    rows = grouped(docs, doc, text, width, percent)
    least = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("d").alias("least"))
    out = rows.join(least, "node", "left")
    return out.select(F.col("d").alias(doc), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("d")).otherwise(F.col("least")).alias("component_id"))


def distinct(docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: the one of the least doc (a null one comes last), then of the least hash of its text.

    Rows count by doc and text: a doc's rows with different texts are judged apart, equal rows are one.  Rows without
    shingles all stay.
    """
    rows = grouped(docs, doc, text, width, percent, tied=False).where("node IS NOT NULL")
    order = F.struct(F.col("d").isNull().alias("last"), "d", "h")
    first = rows.groupBy("node").agg(F.min(order).alias("first"))
    counted = settled(rows.groupBy("node", "d", "h").agg(F.count("*").alias("rows")).join(first, "node").select("d", "h", "rows", F.expr("d <=> first.d AND h = first.h").alias("stays")))
    key, same = F.xxhash64(F.col(doc), F.lit(7), F.xxhash64(text)), F.xxhash64("d", F.lit(7), "h")
    gone = settled(counted.where("NOT stays").select(same.alias("_k")).distinct())
    twice = settled(counted.where("stays AND rows > 1").select(same.alias("_k")).distinct())
    keyed = docs.withColumn("_k", key)
    kept = keyed.join(_shipped(gone), "_k", "left_anti")
    if twice.limit(1).count():
        ship = _shipped(twice)
        kept = kept.join(ship, "_k", "left_anti").unionAll(kept.join(ship, "_k", "left_semi").dropDuplicates(["_k"]))
    return kept.select(*docs.columns)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "documents"))
