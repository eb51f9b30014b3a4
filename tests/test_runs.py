"""A run that is stopped, resumed, changed and tampered with; groups, clusters and canaries against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import graph, sampling
from tallyforge.operators.runs import Gate, Run, Stage
from tallyforge.plans import run as plan

SF = "/root/testdata/sf0.001"


def stages(calls, factor=2):
    def count(name, make):
        def wrapped(*frames):
            calls.append(name)
            return make(*frames)

        return wrapped

    return [
        Stage("source", (), count("source", lambda spark=None: _source()), artifact=False),
        Stage("double", ("source",), count("double", lambda s: s.select("id", (F.col("id") * factor).alias("x"))), version=str(factor)),
        Stage("sums", ("double",), count("sums", lambda d: d.groupBy(F.col("id") % 3).agg(F.sum("x").alias("x")))),
        Stage("odd", ("source",), count("odd", lambda s: s.where("id % 2 = 1"))),
    ]


def _source():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().range(100)


def test_run_resumes(spark, tmp_path):
    folder, calls = f"file://{tmp_path}/run", []
    gates = [Gate("all_rows", "n = 100"), Gate("wrong", "n = 1"), Gate("later", "n = 1", known="n > 1000")]
    make = lambda factor=2: Run(spark, folder, stages(calls, factor), gates, lambda s: s.agg(F.count("*").alias("n")), ("source",))
    with pytest.raises(InterruptedError):
        make().go(stop_before="sums")
    assert calls == ["source", "double"] and not make().done("sums")
    # a stage that broke off: files without a receipt
    spark.range(5).write.parquet(make().path("sums"))
    run = make()
    got = {r.stage: (r.files > 0, r.artifact) for r in run.go().collect()}
    assert calls == ["source", "double", "sums", "odd"] and run.made == ["sums", "odd", "gates"]
    assert got == {"source": (True, False), "double": (True, True), "sums": (True, True), "odd": (True, True), "gates": (True, True)}
    assert sum(r.x for r in run.table("sums").collect()) == 9900 and run.faults().count() == 0
    assert {r.gate: r.state for r in run.table("gates").collect()} == {"all_rows": "PASS", "wrong": "FAIL", "later": "PENDING"}
    again = make()
    assert again.go().count() == 5 and again.made == [] and len(calls) == 4
    # a changed stage is made anew with what reads it, beside the old one
    changed = make(3)
    changed.go()
    assert changed.made == ["double", "sums"] and sum(r.x for r in changed.table("sums").collect()) == 14850 and sum(r.x for r in run.table("sums").collect()) == 9900
    # tampering
    spark.range(3).write.mode("overwrite").parquet(run.path("odd"))
    assert {(r.stage, r.state) for r in run.faults().collect()} == {("odd", "missing"), ("odd", "new")}
    with pytest.raises(ValueError, match="which no earlier stage makes"):
        Run(spark, folder, [Stage("x", ("nothing",), lambda n: n)])


def test_whole_run_resumes(spark, tmp_path):
    """Stopped between any two stages, the run ends with what an uninterrupted one gives."""
    rows = lambda r: {n: sorted(map(str, r.table(n).collect())) for n in r.stages}
    straight = plan.whole(spark, SF, f"file://{tmp_path}/straight")
    straight.go()
    broken = f"file://{tmp_path}/broken"
    for name in ("decisions", "accepted", "gates"):
        with pytest.raises(InterruptedError):
            plan.whole(spark, SF, broken).go(stop_before=name)
    last = plan.whole(spark, SF, broken)
    last.go()
    assert last.made == ["gates"] and rows(last) == rows(straight)


def test_groups(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + k, 501 + k) for k in range(90)] + [(7, 7), (1000, 1000)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = {x: find(x) for x in list(root)}
    assert {r.node: r.root for r in graph.groups(spark.createDataFrame(links, "a long, b long")).collect()} == want
    assert graph.groups(spark.createDataFrame([], "a long, b long")).count() == 0


def test_name_clusters(spark):
    names = [("m", n, n.lower().split()) for n in ["Oak Title", "Oak Escrow", "Elm Escrow", "Elm Law", "Ash Law", "Pine Title", "Solo", "Solo", "Solo", "Solo", "Solo"]] + [("k", "Oak Title", ["oak", "title"])]
    got = {(r.market, r.cluster): (r.members, r.names, r.shown) for r in graph.name_clusters(spark.createDataFrame(names, "market string, name string, words array<string>"), "words", "market", rare=2).collect()}
    assert got == {("m", "Ash Law"): (6, 6, "Ash Law"), ("m", "Solo"): (5, 1, "Solo")}


def test_reduced():
    rng = random.Random(2)
    for _ in range(200):
        strata = {(rng.choice("ab"), rng.choice("xyz"), rng.choice("12345")): rng.randrange(1, 50) for _ in range(rng.randrange(1, 25))}
        size = rng.randrange(5, 20)
        try:
            kept = sampling.reduced(strata, size)
        except ValueError:
            continue
        assert len(kept) <= max(size, 0) or len(strata) <= size
        assert all({s[k] for s in kept} == {s[k] for s in strata} for k in range(3))
        assert len(kept) == min(size, len(strata))
    with pytest.raises(ValueError, match="losing a value"):
        sampling.reduced({("a", str(k)): 1 for k in range(9)}, 5)


def test_canary(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice("xyzw"), rng.random()) for k in range(400)] + [(900, "only", "x", 0.5)]
    df = spark.createDataFrame(rows, "id int, d string, e string, v double")
    got = [tuple(r) for r in sampling.canary(df, "id", ["d", "e"], [F.desc("v")], first=7, rest=9).collect()]
    top = [r[0] for r in sorted(rows, key=lambda r: (-r[3], r[0]))[:7]]
    assert sorted(i for i, w in got if w == "top") == sorted(top)
    drawn = [i for i, w in got if w == "stratum"]
    by = {r[0]: r for r in rows}
    assert len(drawn) == len(set(drawn)) == 9 and not set(drawn) & set(top) and {by[i][1] for i in drawn} == {"a", "b", None, "only"}
    assert max(Counter((by[i][1], by[i][2]) for i in drawn).values()) == 1
    assert sampling.canary(df.limit(3), "id", ["d", "e"], [F.desc("v")], first=7, rest=9).count() == 3
