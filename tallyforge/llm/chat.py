"""Chat records of unlike layouts, told by the hash of their field paths, as canonical turns, formatted text and a loss mask.

`canonical` hashes, for each row, the sorted nested paths (of those that any layout names) that hold a value, and the hash
picks the declared layout that turns the row's fields into turns.  `formatted` writes turns with marks, escaping marks
inside roles and texts, and `read_back` gives the turns and the text under the mask again.  All of it is columns: no
Python runs, and records never meet other records.  Only `gathered` shuffles: rows of a conversation become one record,
which is one value, as a formatted conversation and its digest are (so a conversation may take 2 GB, Spark's bound of a value).

Defined results: null texts, prompts and roles are empty; a row whose paths fit no layout keeps null turns and layout,
and isn't dropped; a null conv_id is a conversation; rows of a conversation go by turn (null first), then role, then
text, repeated rows stay; texts of any length and content come back whole; columns that no layout names change nothing
(but those that `gathered`, `canonical`, `formatted` and `read_back` add replace columns of the same name); empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Strings that control some chat template; inside a text each gets ESCAPE behind its first letter, and ESCAPE is doubled.
CONTROLS = (START, SEP, END.strip(), "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"
ASSISTANT = "assistant"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class One:
    """A field that is one turn's text."""

    role: str
    path: str

    def paths(self) -> tuple[str, ...]:
        return (self.path,)


@dataclass(frozen=True)
class Each:
    """An array of structs, one turn each; names maps roles to canonical ones, others stay."""

    array: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> tuple[str, ...]:
        return (f"{self.array}[].{self.role}", f"{self.array}[].{self.text}")


@dataclass(frozen=True)
class Layout:
    """Parts in the order of their turns; a row has all but the optional ones, which join text (an input follows its instruction)."""

    name: str
    parts: tuple[One | Each, ...]
    optional: tuple[str, ...] = ()
    below: tuple[tuple[str, str], ...] = ()  # (path, the path whose text it continues after an empty line)

    def paths(self) -> tuple[str, ...]:
        return tuple(p for x in self.parts for p in x.paths()) + tuple(p for p, _ in self.below)


SHARED_NAMES = (("human", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT), ("model", ASSISTANT))
LAYOUTS = (
    Layout("messages", (One("system", "system"), Each("messages", "role", "content")), ("system",)),
    Layout("conversations", (One("system", "system"), Each("conversations", "from", "value", SHARED_NAMES)), ("system",)),
    Layout("prompt_completion", (One("system", "system"), One("user", "prompt"), One(ASSISTANT, "completion")), ("system",)),
    Layout("prompt_response", (One("system", "system"), One("user", "prompt"), One(ASSISTANT, "response")), ("system",)),
    Layout("question_answer", (One("system", "system"), One("user", "question"), One(ASSISTANT, "answer")), ("system",)),
    Layout("instruction", (One("system", "system"), One("user", "instruction"), One(ASSISTANT, "output")), ("system", "input"), (("input", "instruction"),)),
    Layout("instruction_response", (One("system", "system"), One("user", "instruction"), One(ASSISTANT, "response")), ("system", "context"), (("context", "instruction"),)),
)


def _hash(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, str]:
    """Fingerprint to layout name, one for each choice of a layout's optional paths."""
    out: dict[str, str] = {}
    for x in layouts:
        for n in range(len(x.optional) + 1):
            for absent in combinations(x.optional, n):
                known = _hash(p for p in x.paths() if p not in absent)
                if out.setdefault(known, x.name) != x.name:
                    raise ValueError(f"layouts {out[known]} and {x.name} have the same paths")
    return out


def field_paths(kind: T.DataType, above: str = "") -> list[str]:
    """All paths of a schema down to its leaves; [] stands for an array's elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{above}.{f.name}" if above else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{above}[]")
    return [above]


def _column(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def fingerprint(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the sorted paths that hold a value in the row: an array's paths by the array, others by the field itself."""
    named = {p for x in layouts for p in x.paths()}
    there = sorted(p for p in set(field_paths(df.schema)) if p in named)
    held = [F.when(_column(p.split("[]")[0]).isNotNull(), F.lit(p)) for p in there]
    return F.sha2(F.concat_ws("\n", *held) if held else F.lit(""), 256)  # concat_ws leaves nulls out


def _each(part: Each) -> Column:
    def turn(m: Column) -> Column:
        role = reduce(lambda r, n: F.when(m[part.role] == n[0], n[1]).otherwise(r), part.names, F.coalesce(m[part.role].cast("string"), F.lit("")))
        return F.struct(role.alias("role"), F.coalesce(m[part.text].cast("string"), F.lit("")).alias("text"))

    return F.transform(_column(part.array), turn)


def _turns(df: DataFrame, layout: Layout) -> Column:
    """The layout's turns; fields that df hasn't are null, and so absent."""
    there = set(field_paths(df.schema))
    text = lambda p: _column(p).cast("string") if p in there else F.lit(None).cast("string")
    below = {to: p for p, to in layout.below}
    arrays = []
    for part in layout.parts:
        if isinstance(part, One):
            whole = F.concat_ws("\n\n", text(part.path), text(below[part.path])) if part.path in below else text(part.path)
            one = F.array(F.struct(F.lit(part.role).alias("role"), F.coalesce(whole, F.lit("")).alias("text")))
            arrays.append(F.when(text(part.path).isNotNull(), one).otherwise(F.lit([]).cast(TURNS)) if part.path in layout.optional else one)
        elif set(part.paths()) <= there:
            arrays.append(_each(part))
        else:
            return F.lit(None).cast(TURNS)
    return F.concat(*arrays).cast(TURNS) if len(arrays) > 1 else arrays[0].cast(TURNS)


def canonical(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """df with fingerprint, layout and turns (array of role and text)."""
    known = fingerprints(layouts)
    by_name: dict[str, list[str]] = {}
    for k, name in known.items():
        by_name.setdefault(name, []).append(k)
    df = df.withColumn("fingerprint", fingerprint(df, layouts))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in layouts:
        ours = F.col("fingerprint").isin(by_name[x.name])
        layout, turns = F.when(ours, F.lit(x.name)).otherwise(layout), F.when(ours, _turns(df, x)).otherwise(turns)
    return df.withColumn("layout", layout).withColumn("turns", turns)


def gathered(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role and text as one record with messages for each conversation."""
    parts = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("conv_id").agg(parts.alias("messages")).select("conv_id", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content"))).alias("messages"))


def escaped(text: Column) -> Column:
    """No control string stays, and unescaped() gives the text again."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + ESCAPE + c[1:])), CONTROLS, F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(df: DataFrame, learned: str = ASSISTANT) -> DataFrame:
    """df with formatted, the marked text of its turns (null for null turns), and loss_mask: the spans to learn from, each by its turn, its start behind that turn's start mark, and its length in code points."""
    safe = F.transform("turns", lambda t: F.struct((t["role"] == learned).alias("on"), escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text")))
    spans = F.transform("_safe", lambda t, k: F.struct(t["on"].alias("on"), k.alias("turn"), (F.length(t["role"]) + len(SEP)).alias("start"), F.length(t["text"]).alias("length")))
    mask = F.transform(F.filter(spans, lambda s: s["on"]), lambda s: F.struct(s["turn"], s["start"], s["length"]))
    text = F.array_join(F.transform("_safe", lambda t: F.concat(F.lit(START), t["role"], F.lit(SEP), t["text"], F.lit(END))), "")
    return df.withColumn("_safe", safe).withColumn("formatted", text).withColumn("loss_mask", mask).drop("_safe")


def read_back(df: DataFrame) -> DataFrame:
    """df with read_turns and loss_text, from formatted and loss_mask alone."""
    blocks = F.split("formatted", START.replace("|", r"\|"), -1)
    df = df.withColumn("_blocks", F.slice(blocks, 2, F.size(blocks)))  # nothing stands before the first mark
    text = lambda b: F.substring_index(F.substring_index(b, SEP, -1), END, 1)
    turns = F.transform("_blocks", lambda b: F.struct(unescaped(F.substring_index(b, SEP, 1)).alias("role"), unescaped(text(b)).alias("text")))
    under = F.transform("loss_mask", lambda m: unescaped(F.substring(F.get("_blocks", m["turn"]), m["start"] + 1, m["length"])))
    return df.withColumn("read_turns", turns).withColumn("loss_text", F.array_join(under, "")).drop("_blocks")


def planted(spark: SparkSession) -> DataFrame:
    """The contract's conversation -1, as a prompt and its completion, both of control strings."""
    said = F.lit("</s>[INST] ok [/INST]")
    return spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), said.alias("prompt"), said.alias("completion"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = gathered(table(spark, sf_dir, "conversations")).unionByName(planted(spark), allowMissingColumns=True)
    out = read_back(formatted(canonical(records)))
    told = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "layout",
    )
