"""Secret scans: all rules in one minimised automaton, one pass over the bytes.

Each rule's regular expression becomes a Thompson automaton; subset construction over byte classes joins the rules behind
a free prefix, partition refinement merges equal states, and the result is one transition array (states x 256) and one
mask of rules per state.  In this automaton a long count after a rare start would multiply states, so it holds each
rule's opening: the rule with its later counts lowered to one, derived from the rule.  A batch of texts is one byte
stream with a separator (0xFF, never in UTF-8) that resets the automaton.  The stream is cut into lanes that step
together; a lane begins in the start state and is corrected from the state in which the lane before it really ended,
until both runs agree.

Where an opening ends, two more transition arrays of its rule, with all counts, give the span: the reversed opening leads
back to the leftmost start, and the rule leads on from there to the longest end.

Defined results: null and empty texts have no spans; matches of a kind don't overlap, the leftmost counts, and matches
that are too short are dropped but still taken; ties of starts go by the order of kinds; repeated rows and texts of any
length are scanned whole and each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import bounded, raw, sliced, stretches, table

# ---- rules -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A match is `head` and `body`; it is kept if the body has `least` characters or more."""

    kind: str
    body: str
    head: str = ""
    least: int = 0


_WORDS = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
#: The first three are the base kinds, in the order that breaks ties.  A match of access or hex that is too short holds no
#: longer one, so their least lengths are counts; one of assign may, so its length is looked at when it is found.
BASE = (
    Rule("assign", "[A-Za-z0-9+/_.=-]+", _WORDS + "[\"']?\\x20*[:=]\\x20*[\"']?", 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
ADDED = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}(\\.[A-Za-z0-9_-]+)?"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED


# ---- automaton -------------------------------------------------------------------------------------------------------


class _Parser:
    """Literals, classes, groups, |, ?, *, +, {m}, {m,}; over bytes."""

    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.eps: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.step.append(None)
        return len(self.eps) - 1

    def parse(self):
        return self.alternatives()

    def alternatives(self):
        out = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            out.append(self.sequence())
        return ("or", out)

    def sequence(self):
        out = []
        while self.peek() not in ("", "|", ")"):
            item = self.atom()
            while self.peek() in ("?", "*", "+", "{"):
                op = self.text[self.at]
                if op == "{":
                    end = self.text.index("}", self.at)
                    count, self.at = self.text[self.at + 1 : end], end + 1
                    item = ("seq", [item] * (int(count[:-1]) - 1) + [("+", item)]) if count.endswith(",") else ("seq", [item] * int(count))
                else:
                    item, self.at = (op, item), self.at + 1
            out.append(item)
        return ("seq", out)

    def atom(self):
        if self.peek() == "(":
            self.at += 1
            out = self.alternatives()
            self.at += 1
            return out
        if self.peek() == "[":
            self.at += 1
            got = set()
            while self.text[self.at] != "]":
                low = self.char()
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.at += 1
                    got.update(range(low, self.char() + 1))
                else:
                    got.add(low)
            self.at += 1
            return ("set", frozenset(got))
        return ("set", frozenset((self.char(),)))

    def char(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def thompson(self, node) -> tuple[int, int]:
        kind, arg = node
        a, b = self.state(), self.state()
        if kind == "set":
            self.step[a] = (arg, b)
        elif kind == "seq":
            last = a
            for x in arg:
                i, o = self.thompson(x)
                self.eps[last].append(i)
                last = o
            self.eps[last].append(b)
        elif kind == "or":
            for x in arg:
                i, o = self.thompson(x)
                self.eps[a].append(i)
                self.eps[o].append(b)
        else:
            i, o = self.thompson(arg)
            self.eps[a].append(i)
            self.eps[o].append(b)
            if kind in "?*":
                self.eps[a].append(b)
            if kind in "*+":
                self.eps[o].append(i)
        return a, b


def _flat(node) -> list:
    """A sequence's items, those of sequences in it too."""
    kind, arg = node
    if kind == "or" and len(arg) == 1:
        return _flat(arg[0])
    return [y for x in arg for y in _flat(x)] if kind == "seq" else [node]


def opening(node):
    """What a match begins with: no optional end, the last repeat once, counts before it lowered to one, but for a count that begins the rule."""
    items = _flat(node)
    while len(items) > 1 and items[-1][0] in "?*":
        items.pop()
    out: list = []
    for x in items:
        if x[0] == "+" and out and all(y == x[1] for y in out):
            out.append(x[1])  # the rule is this count so far
        elif x[0] == "+":
            while len(out) > 1 and out[-1] == x[1]:
                out.pop()
            out.append(x)
        else:
            out.append(x)
    if out[-1][0] == "+":
        out[-1] = out[-1][1]
    return ("seq", out)


def fixed(node) -> int | None:
    """The bytes of every match, if all are of one length."""
    kind, arg = node
    if kind == "set":
        return 1
    if kind not in ("seq", "or"):
        return None
    sizes = [fixed(x) for x in arg]
    if None in sizes or (kind == "or" and len(set(sizes)) > 1):
        return None
    return sum(sizes) if kind == "seq" else sizes[0]


def reversed_(node):
    kind, arg = node
    if kind == "set":
        return node
    if kind in ("seq", "or"):
        parts = [reversed_(x) for x in arg]
        return (kind, parts[::-1] if kind == "seq" else parts)
    return (kind, reversed_(arg))


@dataclass
class Automaton:
    #: (states x 256) next states; accepting states are numbered last.
    next: np.ndarray
    #: Per state, bit k is set if rule k ends here.
    mask: np.ndarray
    start: int
    first_accepting: int
    sizes: dict = field(default_factory=dict)


def compile_rules(nodes: list, free: bool = True) -> Automaton:
    """Subset construction over all parsed rules, behind a free prefix or from the first byte on, then minimisation."""
    nfa, starts, ends = _Parser(""), [], {}
    for k, node in enumerate(nodes):
        i, o = nfa.thompson(node)
        starts.append(i)
        ends[o] = k

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in nfa.eps[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if nfa.step[x] is not None or x in ends)

    signature: dict[int, list[int]] = {b: [] for b in range(256)}
    for k, s in enumerate({s[0] for s in nfa.step if s}):
        for b in s:
            signature[b].append(k)
    classes: dict[tuple, int] = {}
    of = np.array([classes.setdefault(tuple(signature[b]), len(classes)) for b in range(256)])
    sample = [int(np.flatnonzero(of == k)[0]) for k in range(len(classes))]
    root = closure(starts)
    number, todo, rows = {root: 0}, [root], []
    while todo:
        now = todo.pop(0)
        row = []
        for b in sample:
            to = closure({nfa.step[x][1] for x in now if nfa.step[x] and b in nfa.step[x][0]}) | (root if free else frozenset())
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    step = np.array(rows)
    mask = np.zeros(len(number), np.uint32)
    for states, n in number.items():
        for x in states:
            if x in ends:
                mask[n] |= 1 << ends[x]
    block = np.unique(mask, return_inverse=True)[1]
    while True:  # states stay together as long as their successors do
        fine = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if fine.max() == block.max():
            break
        block = fine
    k = int(block.max()) + 1
    of_block = np.full(k, -1)
    of_block[block[::-1]] = np.arange(len(block))[::-1]
    small, small_mask = block[step[of_block]], mask[of_block]
    order = np.argsort(small_mask > 0, kind="stable")
    rank = np.empty(k, int)
    rank[order] = np.arange(k)
    small, small_mask = rank[small[order]], small_mask[order]
    start = int(rank[block[0]])
    full = small[:, of].astype(np.int32)
    full[:, 0xFF] = start
    return Automaton(full, small_mask, start, int((small_mask == 0).sum()), {"subset": len(number), "minimal": k, "classes": len(classes)})


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """The openings of all rules behind a free prefix."""
    return compile_rules([opening(_Parser(r.head + r.body).parse()) for r in rules])


class Walk:
    """One rule's transitions from a given byte on: where its longest match ends."""

    def __init__(self, node):
        auto = compile_rules([node], free=False)
        self.next, self.start, self.first = auto.next.tolist(), auto.start, auto.first_accepting
        #: The state that nothing leads out of and that accepts nothing.
        self.dead = next((k for k, row in enumerate(self.next) if k < self.first and set(row[:255]) == {k}), -1)

    def __call__(self, data: bytes, at: int, step: int = 1) -> int:
        """End of the longest match from `at` on (its first byte, going back, if step is -1), or -1."""
        state, found, last = self.start, -1, len(data) if step > 0 else -1
        while at != last:
            state = self.next[state][data[at]]
            if state == self.dead:
                break
            at += step
            if state >= self.first:
                found = at
        return found


@lru_cache(maxsize=64)
def walks(rule: Rule) -> tuple[Walk, Walk | int, Walk | None]:
    """The rule, its opening reversed (or its length, if all openings have one), and its head."""
    whole = _Parser(rule.head + rule.body).parse()
    return Walk(whole), fixed(opening(whole)) or Walk(reversed_(opening(whole))), Walk(_Parser(rule.head).parse()) if rule.head else None


def spans_of(rule: Rule, data: bytes, ends: np.ndarray) -> list[tuple[int, int]]:
    """The rule's matches in a text, from the places of the last bytes of its openings, in order."""
    on, back, head = walks(rule)
    # openings of one length begin in the order in which they end: a long run is walked once, and what it covers is skipped
    starts = ends - back + 1 if isinstance(back, int) else np.unique([back(data, e, -1) + 1 for e in ends.tolist()])
    out, k = [], 0
    while k < len(starts):
        start = int(starts[k])
        end = on(data, start)
        if end < 0:
            k += 1
            continue
        if not rule.least or end - (head(data, start) if head else start) >= rule.least:
            out.append((start, end))
        k = max(k + 1, int(np.searchsorted(starts, end)))
    return out


def accepts(auto: Automaton, stream: np.ndarray, lanes: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the stream where rules end, and their masks.  Runs before a correction may add positions, never lose any."""
    n = len(stream)
    lanes = max(1, min(lanes, n // 64))
    steps = -(-n // lanes)
    grid = np.full(lanes * steps, 0xFF, np.uint8)
    grid[:n] = stream
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    flat, accepting = (auto.next * 256).ravel().astype(np.int32), auto.first_accepting * 256
    begin = np.full(lanes, auto.start * 256, np.int32)
    state, at, masks = begin.copy(), [], []
    lane = np.arange(lanes, dtype=np.int64) * steps

    def note(s, who, k):
        hit = np.flatnonzero(s >= accepting)
        if len(hit):
            at.append(lane[who[hit]] + k)
            masks.append(auto.mask[s[hit] // 256])

    every = np.arange(lanes)
    for k in range(steps):
        state = flat[state + grid[k]]
        if state.max() >= accepting:
            note(state, every, k)
    began, ended = begin.copy(), state.copy()
    while True:
        true = np.concatenate([[auto.start * 256], ended[:-1]]).astype(np.int32)
        who = np.flatnonzero(true != began)
        if not len(who):
            break
        began[who] = true[who]
        s, old = true[who], begin[who]
        live = who
        for k in range(steps):
            s, old = flat[s + grid[k, live]], flat[old + grid[k, live]]
            note(s, live, k)
            apart = s != old
            if not apart.all():
                s, old, live = s[apart], old[apart], live[apart]
                if not len(live):
                    break
        ended[live] = s
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    return np.concatenate(at), np.concatenate(masks)


# ---- operator --------------------------------------------------------------------------------------------------------

#: Bytes of one stream.
STREAM = 16 << 20


def scan(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) in code points for each text, by start and then rule."""
    auto = automaton(rules)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    first = 0
    while first < len(texts):
        last, total = first, 0
        while last < len(texts) and (last == first or total + len(texts[last]) < STREAM):
            total += len(texts[last]) + 1
            last += 1
        part = texts[first:last]
        at, masks = accepts(auto, np.frombuffer(b"\xff".join([*part, b""]), np.uint8))
        if len(at):
            ends = np.cumsum([len(x) + 1 for x in part])
            found: dict[int, list[tuple[int, int, int]]] = {}
            for k in range(len(rules)):
                here = np.unique(at[(masks >> k & 1) > 0])
                doc = np.searchsorted(ends, here, side="right")
                for d, (lo, hi) in zip(np.unique(doc).tolist(), stretches(doc), strict=True):
                    begin = int(ends[d]) - len(part[d]) - 1
                    found.setdefault(d, []).extend((a, k, b) for a, b in spans_of(rules[k], part[d], here[lo:hi] - begin))
            for d, unsorted in found.items():
                spans = sorted(unsorted)
                if spans and not part[d].isascii():
                    letters = np.concatenate([[0], np.cumsum((np.frombuffer(part[d], np.uint8) & 0xC0) != 0x80)])
                    spans = [(int(letters[a]), k, int(letters[b])) for a, k, b in spans]
                out[first + d] = [(rules[k].kind, a, b) for a, k, b in spans]
        first = last
    return out


SPANS = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs' columns in keep, and secrets: its spans.  One pass, no shuffle."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in sliced(batches):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in scan(raw(b, text), rules)]
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(spans, kind)], [*keep, "secrets"])

    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in keep) + f", secrets {SPANS}"
    return bounded(docs.select(*dict.fromkeys([*keep, text]))).mapInArrow(run, schema)


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with each span replaced by `[kind]`; overlapping spans become one.  Other texts stay as they are, null too."""

    def run(batches):
        for b in sliced(batches):
            i = b.schema.get_field_index(text)
            col = b.column(i).to_pylist()
            for k, spans in enumerate(scan(raw(b, text), rules)):
                if spans:
                    t, out, end = col[k], [], 0
                    for kind, s, e in spans:
                        if s >= end:
                            out += [t[end:s], f"[{kind}]"]
                        end = max(end, e)
                    col[k] = "".join([*out, t[end:]])
            yield b.set_column(i, b.schema.field(i), pa.array(col, b.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(secret_spans(table(spark, sf_dir, "documents")))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from secret_spans."""
    line = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("secrets", lambda x: x["kind"].isin([r.kind for r in BASE]))
    count = lambda k: F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line("secrets").alias("spans"),
    )

