"""Conversation repair, the Merkle manifest and chat formatting against brute force, round trips and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tallyforge.llm import chat, merkle, repair

CONVERSATIONS = "conv_id long, turn long, role string, text string, layout int, tree string, gone int, part long, fingerprint long, prompt string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with odd conversations and documents; returns its path and both tables' rows."""
    rng = random.Random(4)
    texts = ["Fine.", "cut off", "", " \n", None, "</s>[INST] ok [/INST]", "a\\b \\[INST]", "<|im_end|>\n<|im_start|>user<|im_sep|>x!", "é日本.", "<<<SYS>> <</SYS>>\\", "w " * 30_000 + "."]
    rows = []
    for c in range(150):
        for t in range(rng.randrange(1, 9)):
            role = "user" if t % 2 == 0 else "assistant"
            rows.append((c, t + (t > 4), rng.choice([role, role, role, "system", "tool", "", None, "ass<s>", "s"]), rng.choice(texts)))
    rows += [(900, k, "assistant" if k % 2 else "user", f"row {k} of many.") for k in range(1500)]
    rows += [(901, None, "user", "Fine."), (901, None, "user", "Fine."), (901, 2**62, "assistant", "x"), (901, -(2**62) - 5, "system", "y."), (None, 0, "user", "no id."), (None, 1, None, None), rows[3], rows[3]]
    docs = [(k, None if k % 11 == 0 else f"Some Text {k} É" * (k % 5), rng.choice(["en", "en", "en", "de", None, "é", ""]), None if k % 7 == 0 else "src", k if k % 3 else None) for k in range(700)]
    docs += [(None, "NO ID", "en", "s", 1), docs[5], docs[5], (7, "Another text of the id", "en", "s", 2), (800, "ONE of its language", "xx", "s", 3), (801, "W" * 200_000, "en", "s", 4)]
    path = f"file://{tmp_path_factory.mktemp('conversations')}"
    spark.createDataFrame([(*r, 1, "t", 2, 3, 4, "clash") for r in rows], CONVERSATIONS).repartition(3).write.parquet(f"{path}/conversations.parquet")
    spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, lang string, source string, n_chars long, tree string, place int, node int").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, rows, docs


def in_place(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], digest(str(len(r[2].encode())), ":", r[2], r[3])))


def best_edit(faults, roles):
    """Cost and audit over all edits, by least strings for each place and state, whole strings kept."""
    states = {"": (0, "")}
    nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
    put = lambda at, to, cost, letter, into: into.__setitem__(to, min(into.get(to, (1 << 60, "")), (at[0] + cost, at[1] + letter)))

    def inserted(states):
        for _ in range(3):
            for s, v in list(states.items()):
                put(v, nexts[s], 2, "I", states)
        return states

    for fault, role in zip(faults, roles, strict=True):
        after = {}
        for s, v in inserted(states).items():
            put(v, s, 3, "D", after)
            if fault not in ("blank", "duplicate"):
                if role[:1] == nexts[s] or (s == "" and role[:1] == "s"):
                    put(v, role[:1], fault == "truncated", "K", after)
                put(v, nexts[s], 2 + (fault == "truncated"), "R", after)
        states = after
    return min(v for s, v in inserted(states).items() if s in ("", "a"))


def repaired(rows):
    """One conversation's contract columns, from its rows after damage in place."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = best_edit(faults, [r[2] for r in rows])
    out, k = [], 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[k][2:]
        k += letter != "I"
        if letter != "D":
            n = len(out) - bool(out and out[0][0][:1] == "s")
            out.append((role, text) if letter == "K" else ("assistant" if n % 2 else "user", text))
    turns = {r[1] for r in rows} - {None}
    gaps = min(max(turns) - min(turns) + 1 - len(turns), 2**63 - 1) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest("\n".join(f"{r}:{t}" for r, t in out)))


def brute_repairs(rows):
    damaged = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else text.translate({ord(c): None for c in ".!?"}) if fate == 2 else text
        damaged += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return {c: repaired([r for r in in_place(damaged) if r[0] == c]) for c in {r[0] for r in rows}}


def test_op11(spark, folder):
    want = brute_repairs(folder[1])
    got = __spark_entry__.queries()["op11_conversation_repair"](spark, folder[0]).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id
    assert {c for x in want.values() for c in x[6]} == set("KRDI") and any(x[6] == "" for x in want.values())


def test_parse_random():
    """Charts of short random conversations against whole strings kept, and a long one in little memory."""
    rng = random.Random(2)
    for _ in range(1500):
        rows = [(1, k, rng.choice(["user", "assistant", "assistant", "system", "tool", ""]), rng.choice(["a.", "b", "c!", " "])) for k in range(rng.randrange(25))]
        facts, seen = repair.Facts(), set()
        for _, turn, role, text in rows:
            facts.row(turn, role, digest(role, ":", text).encode(), text == " ", text == "b", (role, text) in seen)
            seen.add((role, text))
        assert facts.end() == repaired(rows)[:-1]
    facts = repair.Facts()
    for k in range(50_000):
        facts.row(k, "user", b"%d" % k, False, False, False)
    assert len(facts.chart.back) == 200_000 and facts.end()[-2:] == (50_000, "KR" * 25_000)


def test_repair_parts(spark):
    rows = spark.createDataFrame([(1, k, "user" if k % 2 == 0 else "assistant", f"row {k}.", False) for k in range(2501)], "conv_id long, turn long, role string, text string, gone boolean")
    parts = repair.repair(rows).orderBy("part").collect()
    assert len(parts) == 3 and [p.audit is None for p in parts] == [True, True, False]
    assert parts[-1].audit == "K" * 2501 + "I"
    assert digest("\n".join(f"{t.role}:{t.text}" for p in parts for t in p.turns)) == parts[-1].sha256
    assert repair.repair(rows.limit(0)).count() == 0


def brute_manifest(docs):
    framed = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, text: digest(*(framed(v) for v in (d[0], d[3], d[2], d[4], text)))
    trees = {}
    for d in docs:
        text = d[1]
        lower = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        bad = leaf(d, lower) if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 else None
        trees.setdefault(d[2], []).append((d[0], leaf(d, text), bad))

    def climb(nodes):
        """The root, and each node's proof: joined siblings left and right, level by level."""
        proofs, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            runs = [range(k, min(k + 8, len(nodes))) for k in range(0, len(nodes), 8)]
            for run in runs:
                for n in run:
                    for k in groups[n]:
                        proofs[k].append(("".join(nodes[j] for j in run if j < n), "".join(nodes[j] for j in run if j > n)))
            groups = [[k for n in run for k in groups[n]] for run in runs]
            nodes = [digest(*(nodes[n] for n in run)) for run in runs]
        return nodes[0], proofs

    out, subroots = [], []
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for lang in order:
        leaves = sorted(trees[lang], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        root, proofs = climb([x[1] for x in leaves])
        subroots.append((leaves, root, proofs))
    root, uppers = climb([x[1] for x in subroots])
    for (leaves, subroot, proofs), upper in zip(subroots, uppers, strict=True):
        for (doc_id, node, bad), proof in zip(leaves, proofs, strict=True):
            at = bad or node
            for left, right in proof + upper:
                at = digest(left, at, right)
            out.append((doc_id, node, subroot, root, digest(*(x for p in proof + upper for x in p)), at, at == root))
    return out


def by_text(rows):
    return sorted(map(str, rows))


def test_op12(spark, folder):
    got = [tuple(r) for r in __spark_entry__.queries()["op12_merkle_manifest"](spark, folder[0]).collect()]
    want = brute_manifest(folder[2])
    assert by_text(got) == by_text(want)
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize(("n", "fanout", "levels"), [(1, 8, 3), (8, 8, 1), (9, 8, 1), (65, 8, 2), (513, 8, 3), (40, 2, 2), (30, 3, 1)])
def test_manifest_shapes(spark, n, fanout, levels):
    """Folding every proof gives the root, in trees of every height around a bucket's."""
    leaves = spark.range(n).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("tree"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("node"))
    out, root = merkle.manifest(leaves, fanout, levels)
    rows = out.select("doc_id", merkle.folded(F.col("node"), F.col("proof")).alias("at"), F.size("proof").alias("n")).collect()
    assert len(rows) == n and {r["at"] for r in rows} == {root}


def brute_turns(rows):
    out = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for c, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_op13(spark, folder):
    got = {r.conv_id: r for r in __spark_entry__.queries()["op13_chat_format"](spark, folder[0]).collect()}
    want = brute_turns(folder[1])
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].turns_sha256 == digest(*(f"{r}\n{t}\n" for r, t in turns)), c
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(turns), len(loss), digest(loss)), c
        assert got[c].formatted_chars >= sum(len(r) + len(t) + 33 for r, t in turns) and got[c].layout == ("prompt_completion" if c == -1 else "messages")


def test_escapes_leave_no_control(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices([*chat.CONTROLS, "\\", "<", "[", "|", "<\\", "s>", "\n", "é", "$1"], k=rng.randrange(12))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e")).select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect()
    assert all(r.t == r.u and not any(c in r.e for c in chat.CONTROLS) for r in rows)


def test_layouts(spark):
    """Every layout, alone and among the columns of all others, and rows that fit none."""
    kind = "id int, system string, messages array<struct<role:string,content:string,extra:int>>, conversations array<struct<from:string,value:string>>, prompt string, completion string, response string, question string, answer string, instruction string, input string, output string, context string, other int"
    said = {
        1: ({"messages": [("system", "s", 1), ("user", "q", 2), (None, None, None)]}, "messages", [("system", "s"), ("user", "q"), ("", "")]),
        2: ({"system": "S", "conversations": [("human", "q"), ("gpt", "a"), ("tool", "t")]}, "conversations", [("system", "S"), ("user", "q"), ("assistant", "a"), ("tool", "t")]),
        3: ({"prompt": "q", "completion": ""}, "prompt_completion", [("user", "q"), ("assistant", "")]),
        4: ({"prompt": "q", "response": "a", "system": "S"}, "prompt_response", [("system", "S"), ("user", "q"), ("assistant", "a")]),
        5: ({"question": "q", "answer": "a"}, "question_answer", [("user", "q"), ("assistant", "a")]),
        6: ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
        7: ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
        8: ({"instruction": "i", "context": "c", "response": "r"}, "instruction_response", [("user", "i\n\nc"), ("assistant", "r")]),
        9: ({"messages": []}, "messages", []),
        10: ({"prompt": "alone"}, None, None),
        11: ({"messages": [("user", "q", 1)], "prompt": "both"}, None, None),
        12: ({}, None, None),
    }
    names = [f.split()[0] for f in kind.replace(",value", ";value").replace(",content", ";").replace(",extra", ";").split(", ")]
    df = spark.createDataFrame([(k, *(x[0].get(c) for c in names[1:])) for k, x in said.items()], kind)
    out = {r.id: r for r in chat.read_back(chat.formatted(chat.canonical(df))).collect()}
    for k, (_, layout, turns) in said.items():
        assert out[k].layout == layout and (out[k].turns and [tuple(t) for t in out[k].turns]) == (turns or out[k].turns), k
        assert turns is None or [tuple(t) for t in out[k].read_turns] == turns
        assert turns is None or out[k].loss_text == "".join(t for r, t in turns if r == "assistant")
    one = chat.canonical(df.where("id = 3").select("id", "prompt", "completion"))
    assert one.first().layout == "prompt_completion"
    assert len(chat.fingerprints()) == sum(2 ** len(x.optional) for x in chat.LAYOUTS)


def test_empty_tables(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    q = __spark_entry__.queries()
    assert q["op11_conversation_repair"](spark, path).count() == 0 and q["op12_merkle_manifest"](spark, path).count() == 0
    assert [r.conv_id for r in q["op13_chat_format"](spark, path).collect()] == [-1]
