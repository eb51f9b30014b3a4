"""Estimators in a pipeline: medians against brute force, quantiles by coverage and loss, both saved and loaded."""

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallyforge.operators import estimators as E
from tallyforge.plans import outcomes  # noqa: F401  registers the query
from tallyforge.plans.catalog import QUERIES


def test_sparse_median(spark, tmp_path):
    rows = [(k, "a" if k % 3 else "b", float(k * k % 101)) for k in range(60)] + [(100, "few", 5.0), (101, None, 7.0), (102, "a", None)]
    df = spark.createDataFrame(rows, "id int, c string, y double")
    stages = [SQLTransformer(statement="SELECT *, y + 1 AS z FROM __THIS__"), E.SparseMedian(cohortCol="c", labelCol="z", leastRows=8, formula="10.0D", formulaVersion="f1", weight=0.5)]
    model = Pipeline(stages=stages).fit(df)
    got = {r.id: (r.prediction, r.formula_version) for r in model.transform(df).collect()}
    known = [y + 1 for _, _, y in rows if y is not None]
    own = {c: np.median([y + 1 for _, d, y in rows if d == c and y is not None]) for c in "ab"}
    assert got == {i: (0.5 * own.get(c, np.median(known)) + 5.0, "f1") for i, c, _ in rows}
    model.write().overwrite().save(f"file://{tmp_path}/m")
    again = PipelineModel.load(f"file://{tmp_path}/m")
    assert {r.id: (r.prediction, r.formula_version) for r in again.transform(df).collect()} == got
    Pipeline(stages=stages).save(f"file://{tmp_path}/p")
    assert Pipeline.load(f"file://{tmp_path}/p").getStages()[1].getOrDefault("leastRows") == 8
    empty = E.SparseMedian(cohortCol="c", labelCol="y").fit(df.limit(0))
    assert {r.prediction for r in empty.transform(df).collect()} == {None}


def pinball(y, p, q):
    return float(np.mean(np.maximum(q * (y - p), (q - 1) * (y - p))))


def test_quantile_boost(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(2400):
        a, b, kind = int(rng.integers(0, 10)), float(rng.random()), str(rng.choice(["red", "blue", "green"]))
        prior = float(np.exp(0.3 * a)) if k % 4 == 0 else None
        y = float(np.exp(0.3 * a + {"red": 0, "blue": 1, "green": 0.4}[kind] + rng.normal() * 0.2) + 5 * (b > 0.5))
        rows.append((k, "legal" if k % 2 else "title", a, b if k % 7 else None, kind, prior, "2020-01-01", "2020-06-01" if k % 8 else "2019-06-01", y))
    rows += [(5000 + k, "few", 1, 1.0, "red", None, None, None, float(k)) for k in range(10)] + [(6000, None, 1, None, None, None, None, None, 1.0), (6001, "new", 1, None, None, None, None, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, lane string, a int, b double, kind string, prior double, seen string, asof string, y double")
    train, test = df.where("id % 3 <> 0 AND lane IS NOT NULL AND lane <> 'new'"), df.where("id % 3 = 0 OR lane IS NULL OR lane IN ('few', 'new')")
    boost = E.QuantileBoost(laneCol="lane", labelCol="y", featureCols=["a", "b"], categoryCols=["kind"], priorCol="prior", priorAtCol="seen", asOfCol="asof", trees=14, rate=0.3)
    model = boost.fit(train)
    got = model.transform(test).select("id", "lane", "y", "estimate.*").collect()
    kinds = {(r.lane, r.kind, r["mode"]) for r in got}
    assert kinds == {("legal", "boosted", "external"), ("title", "boosted", "external"), ("title", "boosted", "history"), ("few", "empirical", "external"), (None, "none", "unavailable"), ("new", "none", "unavailable")}
    assert all(r["mode"] != "history" or (r.id % 4 == 0 and r.id % 8 != 0) for r in got)
    for lane in ("legal", "title"):
        own = [r for r in got if r.lane == lane]
        y = np.array([r.y for r in own])
        assert all(r.p10 <= r.p50 <= r.p90 for r in own) and 0.65 < np.mean([r.p10 <= r.y <= r.p90 for r in own]) < 0.95
        flat = [np.quantile([r[8] for r in rows if r[1] == lane and r[0] % 3], q) for q in E.QUANTILES]
        for k, q in enumerate(E.QUANTILES):
            assert pinball(y, np.array([(r.p10, r.p50, r.p90)[k] for r in own]), q) < 0.7 * pinball(y, np.full(len(y), flat[k]), q)
    model.save(f"file://{tmp_path}/boost")
    again = E.QuantileBoostModel.load(f"file://{tmp_path}/boost")
    assert sorted(map(str, again.transform(test).select("id", "estimate").collect())) == sorted(map(str, model.transform(test).select("id", "estimate").collect()))
    # all rows count: whatever the partitions, the sums are the same
    other = boost.fit(train.repartition(7))
    a, b = (m.transform(test.where("lane = 'legal'")).select("id", "estimate.p50").orderBy("id").toPandas()["p50"] for m in (model, other))
    assert np.allclose(a, b, rtol=1e-6)
    assert test.where("id < 0").count() == 0 and model.transform(test.where("id < 0")).count() == 0
    assert boost.fit(train.limit(0)).transform(test).where(F.col("estimate.kind") == "none").count() == test.count()


def test_bins():
    """Missing values, NaN, values at a cut, lanes without cuts and rows without a lane."""
    lane = pa.array(["a", None, "b", "a", "a", "new", "a", "a"])
    x = pa.array([1.0, 1.0, 5.0, None, float("nan"), 9.0, 2.0, 2.5])
    groups, bins = E._bins(lane, [x], [pa.array([0, 1, 2, 3, 4, 5, 6, 7], pa.int8())], {"a": [[1.0, 2.0]], "b": [[]]})
    assert bins.tolist() == [[1, 1, 1, 0, 3, 1, 2, 3], [0, 1, 2, 3, 4, 5, 6, 7]]
    assert {k: v.tolist() for k, v in groups} == {"a": [0, 3, 4, 6, 7], "b": [2], "new": [5]}


def test_lineitem_is_read_once(spark):
    """Trees grow over a written table; before, each step of the fit and the result joined orders and lineitem again."""
    got = QUERIES["quantile_boost"](spark, "/root/testdata/sf0.001")
    assert "lineitem" not in got._jdf.queryExecution().optimizedPlan().toString() and "FileScan" in got._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in str(got.inputFiles()) and got.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
