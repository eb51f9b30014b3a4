"""The match cascade and neighbours by value against brute force."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F
from test_outcomes import ratio

from tallyforge.operators import matching, neighbours, outcomes


def chosen(account, candidates):
    """Of candidates (rid, raw, name, state, city) the city's, then those written alike, then the least id."""
    _, raw, _, _, city = account
    pool = [c for c in candidates if city and c[4] == city] or candidates
    pool = [c for c in pool if c[1].strip().lower() == raw.strip().lower()] or pool
    return min(pool)[0]


def brute(accounts, members):
    out = {}
    for a in accounts:
        i, _, name, state, city = a
        if not name:
            continue
        grades = [("high", 100, [m for m in members if m[3] == state and m[2] == name]), ("medium", 90, [m for m in members if m[3] == state])] if state else [("low", 95, members)]
        for grade, least, pool in grades:
            scored = [(ratio(name, m[2]), -m[0], m[2]) for m in pool if m[2] and ratio(name, m[2]) >= least - 1e-9]
            if not scored:
                continue
            score, _, best = max(scored)
            group = [m for m in pool if m[2] == best]
            if grade == "low" and not (any(city and m[4] == city for m in group) or (len(group) == 1 and len(name.split()) >= 3)):
                continue
            out[i] = (chosen(a, group), grade, int(score + 1e-9), len(group), grade == "low" or len(group) > 1)
            break
    return out


@pytest.mark.parametrize("seed", range(3))
def test_cascade(spark, seed, monkeypatch):
    monkeypatch.setattr(matching, "COMMON", (5, 40, 10_000)[seed])
    rng = random.Random(seed)
    words = ["oak", "elm", "title", "escrow", "of", "the", "llc", "aaaa", "abab", "x"]
    names = [" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(40)] + ["", "ab", "a"]

    def spoilt(name):
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(name) + 1)
            name = name[:k] + rng.choice(["", "q", "a"]) + name[k + rng.randrange(2) :]
        return " ".join(name.split())

    raw = lambda n: rng.choice([n, n.upper(), f" {n}", "Other"])
    members = [(k, raw(n), n, rng.choice(["tx", "ca", "ny", ""]), rng.choice(["reno", "elko", ""])) for k, n in enumerate(rng.choices(names, k=120))]
    accounts = [(k, raw(n), spoilt(n), rng.choice(["tx", "ca", "nv", ""]), rng.choice(["reno", "elko", ""])) for k, n in enumerate(rng.choices(names, k=250))]
    a, m = spark.createDataFrame(accounts, "id int, raw string, name string, state string, city string"), spark.createDataFrame(members, "rid int, raw string, name string, state string, city string")
    got = {r.id: (r.rid, r.confidence, r.score, r.candidates, r.needs_review) for r in matching.cascade(a, m).collect()}
    want = brute(accounts, members)
    assert got == want and {v[1] for v in want.values()} == {"high", "medium", "low"}


@pytest.mark.parametrize("least", [90.0, 95.0])
def test_close_names(spark, least):
    """All pairs of like names, whatever few letters they are of."""
    rng = random.Random(7)
    names = sorted({"".join(rng.choices("ab c", k=rng.randrange(1, 30))).strip() or "a" for _ in range(250)} | {"a" * 25, "a" * 26, "ab" * 20, "ab" * 21})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.name, r.other) for r in matching.close_names(df, df, least, []).collect()}
    assert got == {(x, y) for x in names for y in names if ratio(x, y) >= least}


def test_nearest(spark):
    rng = random.Random(3)
    value = lambda: rng.choice([0.0, -3.0, 5.0, 5.0, float(round(rng.random() * 50)), rng.random() * 1e4])
    pool = [(k, rng.choice(["a", "a", "a", "b", None]), value()) for k in range(300)] + [(900 + k, "few", 5.0) for k in range(7)] + [(950, "a", None)]
    targets = [(k, rng.choice(["a", "b", "few", None, "none"]), value()) for k in range(80)] + [(500, "a", None)]
    t, p = spark.createDataFrame(targets, "id int, lane string, t double"), spark.createDataFrame(pool, "rid int, lane string, v double")
    got = {}
    for r in neighbours.nearest(t, p).orderBy("id", "rank").collect():
        got.setdefault(r.id, (r.level, []))[1].append(r.rid)
    want = {}
    for i, lane, x in targets:
        if x is None or x < 0:
            continue
        own = [(max(v, 0.0), r) for r, b, v in pool if v is not None and lane is not None and b == lane]
        level, rows = ("lane", own) if len(own) >= 8 else ("global", [(max(v, 0.0), r) for r, _, v in pool if v is not None])
        order = sorted(rows, key=lambda y: (abs(math.log1p(y[0]) - math.log1p(x)), y[1]))
        want[i] = (level, [r for _, r in order[: max(8, min(len(rows), 20))]])
    assert got == want


def test_over_range(spark):
    rng = random.Random(9)
    pool = [(k, rng.choice(["a", "b", None]), rng.choice([0.0, 1.0, 2.0, round(rng.random() * 9, 1), 10 ** rng.uniform(-6, 9), None])) for k in range(600)]
    asked = [(k, rng.choice(["a", "b", "c"]), x) for k, x in enumerate([0.0, 1.0, 0.5, *(10 ** rng.uniform(-7, 9) for _ in range(150))])]
    q = spark.createDataFrame(asked, "id int, k string, x double").select("id", "k", (F.col("x") * 0.5).alias("low"), (F.col("x") * 2).alias("high"))
    got = {r.id: (r.n, r.least) for r in neighbours.over_range(q, spark.createDataFrame(pool, "rid long, k string, v double"), ["k"], "low", "high").collect()}
    want = {}
    for i, k, x in asked:
        met = [r for r, b, v in pool if b == k and v is not None and x * 0.5 <= v <= x * 2]
        if met:
            want[i] = (len(met), min(met))
    assert got == want


def test_over_range_broadcasts_nothing(spark, tmp_path):
    """A small file may hold a million rows that repeat; the driver must not gather them."""
    path = f"file://{tmp_path}/t"
    spark.createDataFrame([(1, "a", 0.5, 2.0)], "id long, k string, low double, high double").write.parquet(path)
    q = spark.read.parquet(path)
    p = q.select(F.col("id").alias("rid"), "k", F.col("low").alias("v"))
    assert "Broadcast" not in neighbours.over_range(q, p, ["k"], "low", "high")._jdf.queryExecution().executedPlan().toString()


def test_overlap_counts(spark):
    """Pairs by sets of words against pairs by keys, and 200 million pairs that no one makes."""
    rng = random.Random(4)
    rows = [(k - 150, rng.choice(["a", "b", None]), sorted({rng.choice("pqrstu") for _ in range(rng.randrange(9))})) for k in range(300)]
    df = spark.createDataFrame([*rows, *rows[:20], (None, "a", ["p", "q"]), (900, "a", None)], "k long, g string, w array<string>")
    want = {}
    for k, g, w in rows:
        for k2, g2, w2 in rows:
            hits = len({*w} & {*w2})
            if g and g == g2 and k < k2 and hits >= 2 and hits / len(w) >= 0.5:
                want[g] = want.get(g, 0) + 1
    assert {r.g: r.pairs for r in matching.overlap_counts(df, "g", "k", "w").collect()} == want
    many = spark.range(20_000).select("id", F.lit("a").alias("g"), F.array(F.lit("p"), F.lit("q")).alias("w"))
    assert [tuple(r) for r in matching.overlap_counts(many, "g", "id", "w").collect()] == [("a", 20_000 * 19_999 // 2)]


@pytest.mark.parametrize("direct", [0, 25, 1 << 15])
def test_close_names_in_slices(spark, monkeypatch, direct):
    """Blocks with grams and without, in slices, long names and names of any letters; no pair that isn't close becomes a row."""
    monkeypatch.setattr(matching, "DIRECT", direct)
    monkeypatch.setattr(outcomes, "SAMPLES", 16)
    monkeypatch.setattr(outcomes, "RECORDS", 12)
    monkeypatch.setattr(matching, "PAIRS", 40)
    rng = random.Random(5)
    blocks = ["x"] * 6 + ["y", None, "z"]
    names = sorted({("".join(rng.choices("abé ", k=rng.choice([1, 3, 12, 13, 64, 65, 70]))), rng.choice(blocks)) for _ in range(120)}, key=str)
    spoilt = sorted({(n[:k] + n[k + 1 :], b) for n, b in names if len(n) > 1 for k in (len(n) // 2,)}, key=str)
    a, b = (spark.createDataFrame(x, "name string, s string") for x in (spoilt, [x for x in names if x[1] != "z"]))
    got = [(r.name, r.s, r.other, r.score) for r in matching.close_names(a, b, 90.0, ["s"]).collect()]
    assert sorted(got) == sorted((x, s, y, ratio(x, y)) for x, s in spoilt for y, t in names if s == t and s not in (None, "z") and ratio(x, y) >= 90.0)


def test_close_names_walk():
    """Beginnings that have lost too much are left: ten million pairs take no time."""
    digits = "zero one two three four five six seven eight nine".split()
    others = [" ".join(digits[int(c)] for c in f"{k:04d}") for k in range(5000)]
    began = time.monotonic()
    found = {(x, y) for x, y, _ in matching.near([y[:2] + y[3:] for y in others[:2000]], others, 95.0)}
    assert time.monotonic() - began < 30 and all((y[:2] + y[3:], y) in found for y in others[:2000])
