"""Conversations repaired by error-correcting Earley parsing over a weighted grammar of roles.

The grammar `(s?(ua)+)?` is left-linear, and so are its error productions (delete a row, rerole it, insert a turn), so
every item is predicted at a conversation's start: a chart column holds one item for each nonterminal, however long the
conversation, with the least (cost, audit) of all parses that reach it.  Audits are compared by their items' order in the
column before and the letters added since: no audit of a column begins another one there, as each holds one letter of
K, R, D for every row.  The completed chart gives the repair.

`parse` reads conversations as streams of rows without their texts, sorted by Spark (spilling), and keeps four bytes a row
of the one that it is in.  `repair` then reads rows with their texts behind their conversation's parse, and puts out turns
as it goes; no conversation's texts are held.  Whether a row was seen earlier is found before, by the least turn of each
(conversation, role, text), with partial sums.  What one audit and one hash over a whole conversation need is one stream,
one row after the other, by their nature.

Defined results: null conv_id is a conversation; null roles and texts are one space; rows go by turn (null first), then
role, then the text's digest, and equal rows count as often as they stand there; texts of any length travel whole; gaps
are cut at the greatest long; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import settled, table

SPACE = r"\x20\x09-\x0D"
#: Nonterminals by what has been put out: nothing, a system turn, turns up to a user's, turns up to an assistant's.
NONE, SYSTEM, USER, ASSISTANT = range(4)
GOALS = (NONE, ASSISTANT)
#: Productions: head, the nonterminal before the terminal, the terminal (a role's initial).
GRAMMAR = ((SYSTEM, NONE, "s"), (USER, NONE, "u"), (USER, SYSTEM, "u"), (USER, ASSISTANT, "u"), (ASSISTANT, USER, "a"))
ROLE = {"u": "user", "a": "assistant"}
#: Error productions' weights; a truncated row that stays costs one more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: What a row's item may come from: the one before the row, and the letters since.
STEPS = [(k, "I" * n + letter) for k in range(4) for n in range(3) for letter in "KRD"]
CODE = {x: n for n, x in enumerate(STEPS)}
#: Turns of a part.
PART = 1000
LONGEST = 2**63 - 1
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PARSED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
OUT = f"{PARSED}, part long, turns array<struct<role:string,text:string>>, sha256 string"


class Chart:
    """The current column: for each nonterminal its least (cost, order); for each row so far, how its items came about."""

    def __init__(self) -> None:
        self.items: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self.back = bytearray()

    def _closed(self) -> list[tuple[int, int, str, int] | None]:
        """Items, or what insert productions complete at less cost, as (cost, order, letters, the item before them)."""
        out = [x and (*x, "", k) for k, x in enumerate(self.items)]
        for _ in range(2):  # more inserts would only put a pair between pairs
            for head, body, terminal in GRAMMAR:
                if terminal in ROLE and (x := out[body]):
                    new = (x[0] + INSERT, x[1], x[2] + "I", x[3])
                    out[head] = min(out[head] or new, new)
        return out

    def scan(self, initial: str, deleted: bool, truncated: bool) -> None:
        """The next column, over a row whose role has this initial."""
        closed = self._closed()
        heads = [[(x[0] + DELETE, x[1], x[2] + "D", x[3])] if x else [] for x in closed]
        for head, body, terminal in () if deleted else GRAMMAR:
            if not (x := closed[body]):
                continue
            if terminal == initial:
                heads[head].append((x[0] + KEEP + TRUNCATED * truncated, x[1], x[2] + "K", x[3]))
            elif terminal in ROLE:
                heads[head].append((x[0] + REROLE + TRUNCATED * truncated, x[1], x[2] + "R", x[3]))
        best = [min(x) if x else None for x in heads]
        order = {x: n for n, x in enumerate(sorted({(x[1], x[2]) for x in best if x}))}
        self.items = [x and (x[0], order[x[1], x[2]]) for x in best]
        self.back += bytes(CODE[x[3], x[2]] if x else 255 for x in best)

    def end(self) -> tuple[int, str]:
        """Cost and audit of the completed chart."""
        cost, _, letters, k = min(x for g in GOALS if (x := self._closed()[g]))
        out = [letters]
        for at in range(len(self.back) - 4, -1, -4):
            k, letters = STEPS[self.back[at + k]]
            out.append(letters)
        return cost, "".join(reversed(out))


class Facts:
    """One conversation's chart and figures, row by row."""

    def __init__(self) -> None:
        self.chart, self.low, self.high, self.turn, self.turns = Chart(), None, None, None, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = self.before = None

    def row(self, turn, role: str, mark: bytes, blank: bool, cut: bool, again: bool) -> None:
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn, self.turns = turn if self.low is None else self.low, turn, turn, self.turns + 1
        here, initial = (turn, role, mark), role[:1]
        duplicate = not blank and (again or here == self.before)
        truncated = cut and not blank and not duplicate
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before, self.last = here, initial
        self.chart.scan(initial, blank or duplicate, truncated)

    def end(self) -> tuple:
        cost, audit = self.chart.end()
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, LONGEST)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


class Turns:
    """One conversation's repaired turns, as its audit says."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.out = audit, 0, NONE, sha256(), []

    def _put(self, role: str | None, text: str) -> None:
        role = role if role is not None else ROLE["a" if self.state == USER else "u"]
        self.hash.update(f"{'' if self.state == NONE else chr(10)}{role}:{text}".encode())
        self.state = SYSTEM if self.state == NONE and role[:1] == "s" else ASSISTANT if self.state == USER else USER
        self.out.append({"role": role, "text": text})

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._put(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter != "D":
            self._put(role if letter == "K" else None, text)

    def part(self) -> list[dict]:
        out, self.out = self.out, []
        return out


def _rows(batches, names: tuple[str, ...]):
    for b in batches:
        yield from zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in names), strict=True)


def _batches(rows, fields: list[tuple[str, pa.DataType]], size: int):
    """Batches of rows of these fields, size at most."""
    schema, held = pa.schema(fields), []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


PARSED_FIELDS = [("conv_id", pa.int64()), *((c, pa.int64()) for c in FIGURES), ("audit", pa.string())]
OUT_FIELDS = [*PARSED_FIELDS, ("part", pa.int64()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), ("sha256", pa.string())]


def _parsed(batches):
    """A row of figures and audit for each conversation, from its rows in order."""

    def each():
        now, facts = None, None
        for conv_id, turn, role, mark, blank, cut, again, gone in _rows(batches, ("conv_id", "turn", "role", "mark", "blank", "cut", "again", "gone")):
            if facts is None or conv_id != now:
                if facts is not None:
                    yield now, *facts.end()
                now, facts = conv_id, Facts()
            if not gone:
                facts.row(turn, role, mark, blank, cut, again)
        if facts is not None:
            yield now, *facts.end()

    yield from _batches(each(), PARSED_FIELDS, 1000)


def _repaired(batches):
    """Parts of each conversation, from its parse and then its rows in order."""

    def each():
        turns, figures, part = None, None, 0

        def end():
            turns.inserted()
            return *figures, part, turns.part(), turns.hash.hexdigest()

        for row in _rows(batches, ("conv_id", *FIGURES, "audit", "role", "text")):
            if row[7] is not None:  # a parse: the next conversation begins
                if turns is not None:
                    yield end()
                turns, figures, part = Turns(row[7]), row[:8], 0
                continue
            turns.row(row[8], row[9])
            if len(turns.out) >= PART:
                yield figures[0], *[None] * 7, part, turns.part(), None
                part += 1
        if turns is not None:
            yield end()

    yield from _batches(each(), OUT_FIELDS, 100)


def marked(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, gone) without nulls in role and text, with mark, the digest of both."""
    out = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "gone")
    return out.withColumn("mark", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))


def parse(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, faults, cost and audit of each conversation of marked rows."""
    place = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn"))
    facts = rows.select("conv_id", "turn", "role", "mark", (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"), (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"), "gone")
    # rows of the same turn stand side by side; only what comes again at another turn has to be looked up
    seen = rows.where("not gone").groupBy("conv_id", "mark").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    seen = seen.select(F.col("conv_id").alias("_conv"), F.col("mark").alias("_mark"), "first")
    met = facts.join(seen, (facts["mark"] == seen["_mark"]) & facts["conv_id"].eqNullSafe(seen["_conv"]), "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place)
    met = met.select("conv_id", "turn", "role", "mark", "blank", "cut", again.alias("again"), "gone")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "mark").mapInArrow(_parsed, PARSED)


def repair(rows: DataFrame) -> DataFrame:
    """Parts of repaired conversations: conv_id, part (from 0, in order) and the part's turns; each conversation's last part also has its gaps, faults, cost, audit and the hash of its turns as lines `role:text`.

    rows: conv_id, turn, role, text, and gone (true for a row that is lost, and only names its conversation).
    """
    rows = marked(rows)
    parses = settled(parse(rows))
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    told = parses.select("*", none("turn", "long"), none("role", "string"), none("text", "string"), none("mark", "binary"), F.lit(0).alias("kind"))
    texts = rows.where("not gone").select("conv_id", *(none(c, "long") for c in FIGURES), none("audit", "string"), "turn", "role", "text", "mark", F.lit(1).alias("kind"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return told.unionByName(texts).repartition(parts, "conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "mark").mapInArrow(_repaired, OUT)


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage by crc32(conv_id:turn) % 20: 0 loses the row, 1 its text, 2 its [.!?], 3 repeats it, 4 makes its role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text: Column = F.when(F.col("fate").isin(0, 1), "").when(F.col("fate") == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(part("role"))
    out = rows.select("conv_id", "turn", "role", "text", fate.alias("fate"))
    out = out.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fate") == 0).alias("gone"), F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return out.drop("_copy")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repair(damaged(table(spark, sf_dir, "conversations")))
    return out.where("audit is not null").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha256").alias("repaired_sha256"))
