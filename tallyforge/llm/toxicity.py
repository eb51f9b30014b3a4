"""Toxic spans by a linear-chain conditional random field over words.

Documents are labelled, words are not, so labels of words are derived first: a word (or a word's beginning) is suspect if
toxic documents hold it far more often than clean ones, by smoothed log-odds of document counts over all labelled
training rows.  In a toxic document the suspect words are tagged 1, all else 0; in clean documents every word is 0.

The field has two tags and the weights of a word's features (the word, its first letters, its last letters, its shape)
and of tag pairs, fitted by stochastic gradient steps on the likelihood, whose expectations come from forward-backward.
It is fitted on a bounded sample of labelled documents of any length (`SAMPLE_DOCS` or `SAMPLE_CHARS`, in the order of a
hash of the id, so that both labels keep their shares; in pieces of `PIECE` words, while scores are calibrated on whole
documents); the document counts of words cover all labelled training rows, and every suspect feature of a
sampled toxic document counts.

Scoring runs forward-backward over every whole text (side by side over many texts) and aggregates the marginals p: how
likely it is that some word is toxic (one minus the product of 1 - p), how many are expected, how many have p >= 0.5,
and how many are expected in a hundred words.  A logistic function of the four gives the score; it is fitted on every third sampled document, which the
field isn't fitted on.  Small p count as none, so that many doubts don't add up.  Words with p >= 0.5 are the offending
offsets.

Defined results: null and empty texts have no words and get the score of no evidence, 0 if nothing was learnt; without
labels of both kinds all scores are 0; labelled rows of unknown documents, and labels that are null, are not learnt from;
repeated document rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import table
from tallyforge.llm.language import bucket

#: Bounds of what is fitted: sampled documents and their characters, hashed feature weights.
SAMPLE_DOCS, SAMPLE_CHARS, SPACE = 6000, 48_000_000, 1 << 18
#: Words of a piece in which the field learns from a long document.
PIECE = 1000
#: A suspect has so much smoothed log-odds, and so large a likelihood ratio statistic that chance among millions of features is out.
LOG_ODDS, RATIO = 2.0, 30.0
EPOCHS, RATE, DECAY, FLOOR = 4, 0.3, 1e-5, 0.3
THRESHOLD = 0.3
#: Labels (12 bytes each) that may be broadcast.
SMALL = 1_000_000
#: Letters of a word's beginning and end.
HEADS, TAILS = (4, 5, 6), (4,)

_WORD = re.compile(r"[^\W_]+")


def spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _WORD.finditer(text)]


def lowered(text: str) -> list[str]:
    """The words at spans, in lower case (which may be longer than the word)."""
    low = text.lower()
    return _WORD.findall(low) if len(low) == len(text) else [text[a:b].lower() for a, b in spans(text)]


def traits(word: str) -> list[str]:
    """Features of a lower-case word; the first is the word."""
    return ["w" + word, *(f"h{k}{word[:k]}" for k in HEADS if len(word) > k), *(f"t{k}{word[-k:]}" for k in TAILS if len(word) > k)]


WIDTH = 1 + len(HEADS) + len(TAILS)


class _Features(dict):
    """A word's hashed features, padded with the empty feature 0."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        got = [zlib.crc32(t.encode("utf-8", "surrogatepass")) % (SPACE - 1) + 1 for t in traits(word)]
        out = self[word] = tuple(got + [0] * (WIDTH - len(got)))
        return out


_FEATURES = _Features()


class _Numbers(dict):
    """Words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        out = self[word] = len(self)
        return out


def features(words: list[str]) -> np.ndarray:
    return np.array([_FEATURES[w] for w in words], np.int32).reshape(-1, WIDTH)


def marginals(emit: np.ndarray, lengths: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward of many texts side by side: each word's share of tag 1, and the expected number of tag pairs.

    emit is (longest x texts), texts longest first: the log weight of tag 1 against tag 0.
    """
    steps, texts = emit.shape
    w = np.exp(pair)
    odds = np.exp(np.clip(emit, -30, 30))
    ahead, back = np.zeros_like(odds), np.ones_like(odds)  # tag 1's share of the normalised message
    live = np.searchsorted(-lengths, -np.arange(steps), side="left")
    share = np.zeros(texts)
    for k in range(steps):
        n = live[k]
        s = share[:n]
        one = odds[k, :n] if k == 0 else (((1 - s) * w[0, 1] + s * w[1, 1]) * odds[k, :n])
        nil = np.ones(n) if k == 0 else (1 - s) * w[0, 0] + s * w[1, 0]
        share[:n] = one / (one + nil)
        ahead[k, :n] = share[:n]
    ratio = np.full(texts, 0.5)
    for k in range(steps - 1, -1, -1):
        n = live[k]
        back[k, :n] = ratio[:n]
        r = ratio[:n]
        one, nil = r * odds[k, :n], 1 - r
        to_one, to_nil = w[1, 0] * nil + w[1, 1] * one, w[0, 0] * nil + w[0, 1] * one
        ratio[:n] = to_one / (to_one + to_nil)
    top = ahead * back
    a, b, o = ahead[:-1], back[1:], odds[1:]
    joint = np.stack([(1 - a) * w[0, 0] * (1 - b), (1 - a) * w[0, 1] * o * b, a * w[1, 0] * (1 - b), a * w[1, 1] * o * b])
    joint *= (np.arange(1, steps)[:, None] < lengths) / (joint.sum(axis=0) + 1e-300)
    return top / (top + (1 - ahead) * (1 - back) + 1e-300), joint.sum(axis=(1, 2)).reshape(2, 2)


class Field:
    """The fitted field: feature weights, tag pair weights."""

    def __init__(self):
        self.weight, self.pair, self.known = np.zeros(SPACE, np.float32), np.zeros((2, 2)), False
        self.link = np.array([-3.0, 6.0, 0.0, 0.0, 0.0])

    def fit(self, texts: list[tuple[list[str], np.ndarray]], batch: int = 48) -> Field:
        """texts: words and their tags."""
        ready = [(features(w), t) for w, t in texts if w]
        if not ready:
            return self
        self.known = True
        self.bias = float(np.log((sum(t.sum() for _, t in ready) + 1) / (sum(len(t) for _, t in ready) + 2)))
        rng, square = np.random.default_rng(7), np.full(SPACE, 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(ready))
            for lo in range(0, len(order), batch):
                part = sorted((ready[k] for k in order[lo : lo + batch]), key=lambda x: -len(x[1]))
                x, tags = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
                lengths = np.array([len(p[1]) for p in part])
                emit, row, col = self.grid(self.worth(x), lengths)
                p, pairs = marginals(emit, lengths, self.pair)
                sums = np.bincount(x.ravel(), weights=np.repeat(tags - p[row, col], WIDTH))
                own = np.unique(x)
                own = own[own > 0]
                g = sums[own] - DECAY * self.weight[own]
                square[own] += g * g
                self.weight[own] += RATE * g / np.sqrt(square[own])
                seen = np.zeros((2, 2))
                for _, t in part:
                    np.add.at(seen, (t[:-1].astype(int), t[1:].astype(int)), 1)
                self.pair += (seen - pairs) / lengths.sum()
        return self

    def worth(self, x: np.ndarray) -> np.ndarray:
        """Log weights of tag 1 of words, from their features."""
        return self.weight[x].sum(axis=1) + self.bias

    @staticmethod
    def grid(worth: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' log weights as (longest x texts), and where each word stands there."""
        col = np.repeat(np.arange(len(lengths)), lengths)
        row = np.arange(len(worth)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        emit = np.zeros((int(lengths.max()), len(lengths)))
        emit[row, col] = worth
        return emit, row, col

    def tag(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Scores, and the offending stretches, of whole texts."""
        if not self.known:
            return np.zeros(len(texts)), [[] for _ in texts]
        evidence, hits = self.read(texts)
        return self.logistic(evidence), hits

    def read(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """What the marginals say of each text, and the offending stretches."""
        words = [lowered(t) for t in texts]
        evidence, hits = np.zeros((len(texts), 4)), [[] for _ in texts]
        order = sorted((k for k in range(len(texts)) if words[k]), key=lambda k: -len(words[k]))
        lo = 0
        while lo < len(order):  # texts of like length go together, about 4 million words at once
            longest = len(words[order[lo]])
            hi = min(len(order), lo + max(1, 2_000_000 // longest))
            part = order[lo:hi]
            lengths = np.array([len(words[k]) for k in part])
            number = _Numbers()
            at = np.fromiter((n for k in part for n in map(number.__getitem__, words[k])), np.int64, int(lengths.sum()))
            emit, row, col = self.grid(self.worth(features(list(number)))[at], lengths)  # a word's features are summed once, however often it stands there
            p = marginals(emit, lengths, self.pair)[0][row, col]
            sure = np.where(p >= FLOOR, np.minimum(p, 1 - 1e-9), 0.0)
            total = np.bincount(col, weights=np.log1p(-sure), minlength=len(part))
            some = [-np.expm1(total), np.log1p(np.bincount(col, weights=sure, minlength=len(part))), np.log1p(np.bincount(col, weights=p >= 0.5, minlength=len(part)))]
            some.append(np.log1p(100 * np.bincount(col, weights=sure, minlength=len(part)) / lengths))
            evidence[part] = np.stack(some, axis=1)
            for c, r in {*zip(col[p >= 0.5].tolist(), row[p >= 0.5].tolist(), strict=True)}:
                hits[part[c]].append(r)
            lo = hi
        for k, rows in enumerate(hits):
            if rows:
                at = spans(texts[k])
                hits[k] = [at[r] for r in sorted(rows)]
        return evidence, hits

    def logistic(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.link[0] + evidence @ self.link[1:], -30, 30)))

    def calibrate(self, texts: list[str], toxic: np.ndarray) -> Field:
        """Fits the logistic function by penalised Newton steps; evidence never lowers a score."""
        if self.known and len(texts):
            evidence = self.read(texts)[0]
            x, link, on = np.column_stack([np.ones(len(texts)), evidence]), np.zeros(5), np.ones(5, bool)
            for _ in range(3):
                for _ in range(25):
                    p = 1 / (1 + np.exp(-np.clip(x[:, on] @ link[on], -30, 30)))
                    h = (x[:, on] * (p * (1 - p))[:, None]).T @ x[:, on] + 0.1 * np.eye(on.sum())
                    link[on] += np.linalg.solve(h, x[:, on].T @ (toxic - p) - 0.1 * link[on])
                bad = on & (link < 0) & (np.arange(5) > 0)
                if not bad.any():
                    break
                on &= ~bad
                link[:] = 0
            self.link = link
        return self


def suspects(labelled: DataFrame, asked: set[str], text: str = "text", toxic: str = "toxic") -> dict[str, float]:
    """The suspect ones of the asked features with their log-odds; document counts over all labelled rows."""

    def count(batches):
        total: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for t, y in zip(b.column(b.schema.get_field_index(text)).to_pylist(), b.column(b.schema.get_field_index(toxic)).to_pylist(), strict=True):
                total[y].update({f for w in set(lowered(t or "")) for f in traits(w)})
                if len(total[0]) + len(total[1]) > 2_000_000:
                    yield from flush(total)
        yield from flush(total)

    def flush(total):
        for y, c in total.items():
            if c:
                n = np.fromiter(c.values(), np.int64, len(c))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(n * y), pa.array(n * (1 - y))], ["f", "bad", "good"])
            c.clear()

    sizes = {r[toxic]: r["n"] for r in labelled.groupBy(toxic).agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return {}
    counts = labelled.select(text, F.col(toxic).cast("int").alias(toxic)).mapInArrow(count, "f string, bad long, good long").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.1) / (sizes[1] + 0.2)) - F.log((F.col("good") + 0.1) / (sizes[0] + 0.2))
    base = sizes[1] / (sizes[0] + sizes[1])
    seen = F.col("bad") + F.col("good")
    part = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    ratio = 2 * (part(F.col("bad"), seen * base) + part(F.col("good"), seen * (1 - base)))
    top = counts.withColumn("odds", odds).where((F.col("odds") >= LOG_ODDS) & (ratio >= RATIO))
    ship = labelled.sparkSession.sparkContext.broadcast(asked)

    def known(batches):
        for b in batches:
            yield b.filter(pa.array([f in ship.value for f in b.column(0).to_pylist()], pa.bool_()))

    return {r.f: r.odds for r in top.select("f", "odds").mapInArrow(known, "f string, odds double").collect()}


def fit(labelled: DataFrame, text: str = "text", toxic: str = "toxic", doc: str = "doc_id") -> Field:
    """A field from rows with a document label (0 or 1)."""
    rows = labelled.where(F.col(toxic).isin(0, 1) & F.col(text).isNotNull())
    order = F.xxhash64(F.col(doc), F.lit(9))
    share = min(1.0, 1.5 * SAMPLE_DOCS / max(1, rows.count()))
    thin = rows.where(order.bitwiseAND(F.lit(0xFFFFFF)) / 0x1000000 < share)
    last, chars = None, 0
    for r in thin.select(order.alias("o"), F.length(text).alias("n")).sort("o").limit(SAMPLE_DOCS).collect():
        chars += r.n
        if last is not None and chars > SAMPLE_CHARS:
            break
        last = r.o
    if last is None:
        return Field()
    thin = thin.where(order <= F.lit(last))
    learnt, held, marks = [], [], []
    for k, r in enumerate(thin.select(text, toxic, order.alias("o")).sort("o", text).limit(SAMPLE_DOCS).collect()):
        if k % 3 == 2:
            held.append(r[text])
            marks.append(r[toxic])
            continue
        learnt.append((lowered(r[text]), r[toxic]))
    suspect = suspects(rows, {f for words, y in learnt if y for w in set(words) for f in traits(w)}, text, toxic)
    if not suspect:
        return Field()
    texts = [(words, np.array([float(y and any(f in suspect for f in traits(w))) for w in words])) for words, y in learnt]
    texts = [(words[k : k + PIECE], tags[k : k + PIECE]) for words, tags in texts for k in range(0, len(words), PIECE)]
    return Field().fit(texts).calibrate(held, np.array(marks, float))


STRETCHES = "array<struct<start:int,end:int>>"


def scored(docs: DataFrame, field: Field, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs' columns in keep, score, and toxic_spans (code points, end exclusive).  One pass, no shuffle."""
    ship = docs.sparkSession.sparkContext.broadcast(field)  # SPACE weights
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                score, hits = ship.value.tag([t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()])
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(score, pa.float64()), pa.array([[{"start": s, "end": e} for s, e in x] for x in hits], kind)], [*keep, "score", "toxic_spans"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", score double, toxic_spans {STRETCHES}"
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where((bucket(4) != 2) & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    if labels.count() <= SMALL:
        labels = F.broadcast(labels)  # else both sides are shuffled by doc_id
    field = fit(docs.where(bucket(4) != 2).join(labels, "doc_id"))
    found = scored(docs, field)
    return found.select("doc_id", F.coalesce(bucket(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("toxic_spans").cast("long").alias("n_spans"))
