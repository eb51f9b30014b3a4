"""Functions, rules, sources and streams on literals."""

from pyspark.sql import functions as F

from tallyforge.functions import entity as E
from tallyforge.functions import numbers as N
from tallyforge.functions import text as X
from tallyforge.operators import rules as R
from tallyforge.sources import files
from tallyforge.streaming import windows


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(columns))).first())


def test_text(spark):
    lit = F.lit
    assert one(spark, X.host(lit("https://me@WWW.Acme.co.uk:80/a?b")), X.entity_name(lit("Açme & Sons, Inc.")), X.phone10(lit("+1 (212) 555-0100")), X.slug(lit(" A b/C "))) == ("acme.co.uk", "acme and sons", "2125550100", "a_b_c")
    assert one(spark, X.registered_domain(lit("x.acme.co.uk")), X.registered_domain(lit("localhost")), X.same_domain(lit("a.b.com"), lit("b.com")), X.foreign_country_domain(lit("b.de"))) == ("acme.co.uk", "", True, True)
    assert one(spark, X.clean(lit(None)), X.truthy(lit("T"), "release"), X.truthy(lit("t")), X.first_filled(lit(" "), lit(None), lit("x"))) == ("", False, True, "x")
    assert one(spark, E.name_similarity(lit("Acme Title LLC"), lit("acme title")), E.name_similarity(lit("Acme Title"), lit("Acme Title Group")), E.name_similarity(lit("Acme Title Group"), lit("Acme Title"))) == (1.0, 0.97, 0.94)


def test_numbers(spark):
    lit = F.lit
    low, high = N.money_range(lit("$12K – $1.5m"))
    assert one(spark, low, high, N.money(lit("$150K+")), N.number(lit("1,234.5")), N.number(lit("inf")), N.number(lit("x"))) == (12000.0, 1500000.0, None, 1234.5, None, None)
    assert one(spark, N.band(lit(2700), (0, 500, 2500), 2500.0, 500), N.band(lit(-1), (0, 5)), N.bucket(lit(999), (0, 50, 200)), N.recency(lit(365.0))) == (2500.0, None, 1, 0.5)


def test_rules(spark):
    x = [("a", F.lit(None).cast("boolean")), ("b", F.lit(True)), ("c", F.lit(True))]
    assert one(spark, R.first_match(x), R.all_matches(x), R.pick_by_priority(R.all_matches(x), ("c",))) == ("b", ["b", "c"], "c")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string")
    files.write_once(df.coalesce(1), str(tmp_path / "t"))
    assert sorted(map(tuple, files.read_unique(spark, str(tmp_path / "t"), "id").collect())) == [("1", "x"), ("2", "")]
    assert files.read_optional(spark, str(tmp_path / "none"), ["a"]).columns == ["a"]
    before = files.manifest(spark, str(tmp_path / "t")).where("path like '%.csv'")
    assert files.verify(spark, str(tmp_path / "t"), before).where("state = 'changed'").count() == 0
    try:
        files.write_once(df, str(tmp_path / "t"))
        raise AssertionError("it was overwritten")
    except Exception as e:
        assert "PATH_ALREADY_EXISTS" in str(e)


def test_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = windows.window_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == events.count()


def test_sources_and_ledgers(spark, tmp_path):
    from tallyforge.operators import joins as J

    (tmp_path / "a.csv").write_bytes("Id,Name\n1,Café\n".encode("latin-1"))
    (tmp_path / "b.csv").write_text("Id,Name\n1,Café\n", encoding="utf-8")
    assert [files.read_probed(spark, f"file://{tmp_path}/{n}.csv").first().Name for n in "ab"] == ["Café", "Café"]
    rows = spark.createDataFrame([("A ", 1), ("a", 2), ("b", 3)], "id string, n int")
    assert {(r.id, r.n) for r in files.last_row_wins(rows, "id", "n", fold=True).collect()} == {("a", 2), ("b", 3)}
    listed = files.write_artifact(rows.coalesce(1), f"file://{tmp_path}/out").where("path LIKE '%.json'").collect()
    assert len(listed) == 1 and listed[0].bytes > 0 and files.verify(spark, f"file://{tmp_path}/out", files.manifest(spark, f"file://{tmp_path}/out")).count() == 0
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    x, y = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int"), spark.createDataFrame([(1, 7)], "k int, v int")
    kept, missing = J.with_ledger(base, {"x": x, "y": y}, "k")
    assert [tuple(r) for r in kept.collect()] == [(1, 5, 7)] and {(r.k, r.missing) for r in missing.collect()} == {(2, "y"), (3, "x; y")}
    assert one(spark, X.phones(F.lit("call (775) 555-0100 or 775.555.0100, 8005550199 not 12345678901"))) == (["7755550100", "8005550199"],)


def test_json_find(spark):
    import json as J

    from tallyforge.functions import entity

    cells = ['{"a": {"name": "x \\"name\\": 1", "name2": 3}, "name": [1, {"name": 2.5}], "b": "\\"name\\": 7"}', '{"name": null, "c": [{"name": true}, {"name": "é\\u0041"}]}', "name: 3", '["name", "name"]', '{"name": 1', "", None]

    def walk(x):
        if isinstance(x, dict):
            for k, v in x.items():
                if k == "name" and not isinstance(v, (dict, list)) and v is not None:
                    yield v if isinstance(v, str) else J.dumps(v)
                yield from walk(v)
        elif isinstance(x, list):
            for v in x:
                yield from walk(v)

    def want(c):
        try:
            return list(walk(J.loads(c or "")))
        except ValueError:
            return []

    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "k int, c string")
    assert [r.f for r in df.select("k", entity.json_find("c", "name").alias("f")).orderBy("k").collect()] == [want(c) for c in cells]


def test_fold_ascii(spark):
    """As decomposition says, for every letter that has one, and for texts of many scripts."""
    import random
    import unicodedata

    from tallyforge.functions import text

    fold = lambda s: unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()
    rng = random.Random(6)
    every = [chr(k) for k in range(0x80, 0x20000, 7) if not 0xD800 <= k < 0xE000] + list("ßØæﬁ½…㎏Ⅷ№™ａ𝐀Ωя中é́Ǆ⑽🄰")
    cells = ["x".join(rng.choices(every, k=30)) for _ in range(400)] + ["Ελλάς Москва Zürich", "école ﬃ", "plain [text] ^-]", ""]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "k int, c string")
    got = [r.f for r in df.select("k", text.fold_ascii("c").alias("f")).orderBy("k").collect()]
    assert got == [fold(c.strip(" ")) for c in cells]
