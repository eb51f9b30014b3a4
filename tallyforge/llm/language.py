"""Language identification by cross-parsing.

Per language a suffix automaton of labelled text is built.  A text is parsed greedily: each phrase is the longest match
with anything in the automaton, or one unseen symbol.  The more a text is like a language, the longer its phrases, so the
language that needs the fewest phrases for each letter wins (ties: the first in order of names).

Symbols are a language's letters in lower case: its `LETTERS` most frequent ones each have their own, the others of its
labelled text (in scripts of thousands) share `CLASSES` by their code point, and a letter that it doesn't know gets a
symbol that no automaton holds, so it is a phrase by itself.  One symbol stands for any run of anything else.  Whole texts are parsed,
whatever their length: all texts and languages of a batch step side by side, and the few longest ones end one by one.

The labelled text is a bounded sample: per language, whole labelled documents of `SHORT` to `LONG` characters in the
order of a hash of their id (of any length if it has fewer than `FEW` of these), until `SAMPLE` symbols are there.  Rows are thinned by that hash before they are sorted, so
the sample's cost doesn't grow with the corpus.

Defined results: null texts and texts without a letter are `und` with score 0; nothing labelled makes all texts `und`;
repeated rows get the same result each; extra columns are kept, also those that are named like results (`predicted`
returns its three under other names on request); an empty table gives no rows; ties go to the first language by name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded, portions, sliced, table

#: Labelled symbols and documents of a language's sample, and the sizes of its documents.
SAMPLE, SAMPLE_DOCS, SHORT, LONG = 60_000, 400, 60, 8_000
#: Documents of these sizes without which a language's others are taken too, up to SAMPLE characters of each.
FEW = 20
#: Letters of a language with a symbol of their own, and symbols that its rarer ones share.
LETTERS, CLASSES = 62, 64
#: Symbols of what stands between words, and of a letter that the language doesn't know; lanes from which stepping side by side is quicker than one by one.
BETWEEN, UNSEEN, ABREAST = 0, 1, 48
#: Characters of texts that are parsed side by side: bounds a task's memory.
PORTION = 2_000_000
UNKNOWN = "und"
_LETTER_RUNS = re.compile(r"[^\W\d_]+")


def bucket(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


class SuffixAutomaton:
    """Transitions by symbol (-1: none) of the minimal automaton of all substrings."""

    def __init__(self, symbols: list[int], alphabet: int):
        nxt, link, length, last = [{}], [-1], [0], 0
        for c in symbols:
            now = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = now
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    copy = len(nxt)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = copy
                        p = link[p]
                    link[q] = link[now] = copy
            last = now
        self.next = np.full((len(nxt), alphabet), -1, np.int32)
        for s, row in enumerate(nxt):
            self.next[s, list(row)] = list(row.values())


def phrases(flat: np.ndarray, starts: np.ndarray, stream: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of lanes, longest first: stretches of the stream, each parsed from its own start state.

    flat: next states' places for each state and symbol (-1: none); a state is the place of its row.
    """
    state, count = starts.astype(np.int64), np.ones(len(begin), np.int64)
    longest = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(longest), side="left")  # lanes longer than k
    k = 0
    while k < longest and live[k] > ABREAST:
        n = live[k]
        c = stream[begin[:n] + k]
        to = flat[state[:n] + c]
        dead = np.flatnonzero(to < 0)
        if len(dead):
            begun = state[dead] != starts[dead]  # an unseen symbol in the start state is a phrase by itself, already counted
            count[dead[begun]] += 1
            again = flat[starts[dead] + c[dead]]
            lone = again < 0
            again[lone] = starts[dead[lone]]
            alone = dead[lone]
            count[alone[lengths[alone] > k + 1]] += 1
            to[dead] = again
        state[:n] = to
        k += 1
    table = memoryview(flat)
    for lane in range(live[k] if k < longest else 0):
        now, start, more = int(state[lane]), int(starts[lane]), 0
        symbols = stream[begin[lane] + k : begin[lane] + lengths[lane]].tolist()
        last = len(symbols) - 1
        for i, c in enumerate(symbols):
            to = table[now + c]
            if to < 0:
                more += now != start
                to = table[start + c]
                if to < 0:
                    to = start
                    more += i < last
            now = to
        count[lane] += more
    return count


class Languages:
    """The fitted model."""

    def __init__(self, samples: dict[str, list[str]]):
        self.names = sorted(samples)
        #: Per language its letters' symbols.
        self.number: list[dict[str, int]] = []
        tables, self.starts, size = [], [], 0
        for name in self.names:
            counts: Counter = Counter()
            for t in samples[name]:
                counts.update("".join(_LETTER_RUNS.findall(t.lower())))
            letters = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
            self.number.append({c: k + 2 if k < LETTERS else LETTERS + 2 + ord(c) % CLASSES for k, c in enumerate(letters)})
            symbols: list[int] = []
            for t in samples[name]:
                symbols += self.symbols(self.letters(t), self.number[-1]).tolist() + [BETWEEN]
                if len(symbols) >= SAMPLE:
                    break
            own = SuffixAutomaton(symbols, len(letters) + 2 if len(letters) <= LETTERS else LETTERS + CLASSES + 2).next.astype(np.int64)
            self.starts.append(size)
            tables.append(np.where(own >= 0, own * own.shape[1] + size, -1).astype(np.int32 if size + own.size < 1 << 31 else np.int64).ravel())
            size += own.size
        self.flat = np.concatenate(tables) if tables else np.empty(0, np.int32)

    @staticmethod
    def letters(text: str) -> np.ndarray:
        """The text's letters in lower case as code points, one blank for each run of anything else between them."""
        return np.frombuffer(" ".join(_LETTER_RUNS.findall(text.lower())).encode("utf-32-le", "surrogatepass"), "<u4")

    @staticmethod
    def symbols(code: np.ndarray, number: dict[str, int]) -> np.ndarray:
        low = np.full(0x250, UNSEEN, np.uint8)
        for c, k in number.items():
            if ord(c) < 0x250:
                low[ord(c)] = k
        low[32] = BETWEEN
        out = low[np.minimum(code, 0x24F)]
        high = np.flatnonzero(code >= 0x24F)
        if len(high):
            some, where = np.unique(code[high], return_inverse=True)
            out[high] = np.array([number.get(chr(c), UNSEEN) for c in some.tolist()], np.uint8)[where]
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        """Language, score (0 to 1) and the winner's phrases per letter."""
        if not self.names or not len(texts):
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        codes = [self.letters(t if any(map(str.isalpha, t)) else "") for t in texts]
        size = np.array([len(c) for c in codes], np.int64)
        code, many = np.concatenate(codes), len(self.names)
        stream = np.concatenate([self.symbols(code, number) for number in self.number])
        first = np.cumsum(size) - size
        begin, lengths = (first + len(code) * np.arange(many)[:, None]).ravel(), np.tile(size, many)
        starts = np.repeat(np.array(self.starts, np.int64), len(texts))
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        total = np.zeros(len(lengths), np.int64)
        total[order] = phrases(self.flat, starts[order], stream, begin[order], lengths[order])
        total = total.reshape(many, len(texts)).astype(float)
        best = total.argmin(axis=0)
        least = total[best, np.arange(len(texts))]
        others = np.where(np.arange(many)[:, None] == best, np.inf, total).min(axis=0) if many > 1 else np.full(len(texts), np.inf)
        n = np.maximum(size, 1)
        # The winner's share against the second if each phrase less makes a language twice as likely.
        score = 1 / (1 + np.exp2(-np.minimum(np.where(np.isfinite(others), others - least, 60), 60)))
        score[size == 0] = 0
        names = [self.names[b] if s else UNKNOWN for b, s in zip(best.tolist(), size.tolist(), strict=True)]
        return names, score.tolist(), (least / n * (size > 0)).tolist()


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc: str = "doc_id") -> Languages:
    """A model from labelled rows; see SAMPLE for the bound."""
    within = F.length(text).between(SHORT, LONG)
    fits = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = fits.groupBy(lang).agg(F.count("*").alias("n"), F.count_if(within).alias("within")).collect()  # a row for each language
    few = [r[lang] for r in found if r["within"] < FEW]
    fits = fits.where(within | F.col(lang).isin(few)).withColumn(text, F.when(within, F.col(text)).otherwise(F.substring(text, 1, SAMPLE)))
    sizes = {r[lang]: r["n"] if r[lang] in few else r["within"] for r in found}
    order = F.xxhash64(F.col(doc), F.lit(7))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, F.lit(min(1.0, 2.0 * SAMPLE_DOCS / n))).otherwise(share)
    thin = fits.where((order.bitwiseAND(F.lit(0xFFFFFF)) / 0x1000000) < share)
    samples: dict[str, list[str]] = {}
    for r in thin.select(lang, text, order.alias("o")).sort("o", text).collect():  # about 2 * SAMPLE_DOCS rows a language
        samples.setdefault(r[lang], []).append(r[text])
    return Languages({k: v[:SAMPLE_DOCS] for k, v in samples.items()})


RESULTS = ("lang_pred", "score", "phrases_per_letter")


def predicted(docs: DataFrame, model: Languages, text: str = "text", keep: tuple[str, ...] | None = None, results: tuple[str, str, str] = RESULTS) -> DataFrame:
    """docs' columns in keep, and the language, score and phrases per letter under the names in results.  One pass, no shuffle."""
    ship = docs.sparkSession.sparkContext.broadcast(model)  # SAMPLE bounds each language's automaton
    keep = list(keep or docs.columns)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches):
        for b in sliced(batches):
            every = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            for lo, hi in portions([len(t) for t in every], PORTION):
                part, texts = b.slice(lo, hi - lo), every[lo:hi]
                names, score, cost = ship.value.predict(texts)
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(cost, pa.float64())], [*keep, *results])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", {} string, {} double, {} double".format(*results)
    return bounded(docs.select(*dict.fromkeys([*keep, text]))).mapInArrow(run, schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(bucket(3) != 1))
    found = predicted(docs.select("doc_id", "text"), model, keep=("doc_id",))
    return found.select("doc_id", F.coalesce(bucket(3) == 1, F.lit(False)).alias("held_out"), *RESULTS)


def accepted(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: documents in some language stay (null and letterless ones go, also if nothing is labelled).

    Long texts and repeated rows are judged as they are, each by itself; columns may have any names.
    """
    model = fit(docs.where(bucket(3) != 1))
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    own = tuple(f"_tallyforge_{c}" for c in RESULTS)
    # by the letter test, not by the name: a learned language may be called like the unknown one
    return predicted(docs, model, results=own).where(F.col(own[2]) > 0).select(*docs.columns)
