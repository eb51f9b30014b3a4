"""Estimators for a pyspark.ml Pipeline: medians of cohorts, and quantiles by boosted trees; both are saved and loaded as others are."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.aggregates import exact_quantiles
from tallyforge.sources.scratch import forget, written


class _Stored(MLReadable, MLWritable):
    """A model whose state is a table of its own: params as metadata, the table beside them."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.state.write.parquet(f"{path}/state")


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(self.sparkSession.read.parquet(f"{path}/state"))
        model._resetUid(found["uid"])
        DefaultParamsReader.getAndSetParams(model, found)
        return model


# ---- medians of cohorts ------------------------------------------------------------------------------------------------


class _CohortParams(HasLabelCol, HasPredictionCol):
    cohortCol = Param(Params._dummy(), "cohortCol", "column whose values are cohorts", TypeConverters.toString)
    leastRows = Param(Params._dummy(), "leastRows", "rows a cohort needs for a median of its own", TypeConverters.toInt)
    formula = Param(Params._dummy(), "formula", "SQL of a figure to blend in; blank for none", TypeConverters.toString)
    formulaVersion = Param(Params._dummy(), "formulaVersion", "version of the formula", TypeConverters.toString)
    weight = Param(Params._dummy(), "weight", "share of the formula in a prediction", TypeConverters.toFloat)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(leastRows=8, formula="", formulaVersion="none", weight=0.25, labelCol="label", predictionCol="prediction")


class SparseMedian(Estimator, _CohortParams, DefaultParamsReadable, DefaultParamsWritable):
    """A cohort's median label, or the median of all where a cohort has few rows; a formula may be blended in."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> SparseMedianModel:
        label, cohort = F.col(self.getOrDefault("labelCol")), self.getOrDefault("cohortCol")
        known = dataset.where(label.isNotNull())
        own = exact_quantiles(known, [cohort], label, [0.5]).select(F.col(cohort).cast("string").alias("cohort"), "n", F.get("quantiles", F.lit(0)).alias("median"))
        whole = exact_quantiles(known, [], label, [0.5]).select(F.lit(None).cast("string").alias("cohort"), "n", F.get("quantiles", F.lit(0)).alias("median"))
        kept = own.where((F.col("n") >= self.getOrDefault("leastRows")) & F.col("cohort").isNotNull())
        return self._copyValues(SparseMedianModel(written(kept.unionByName(whole))))


class SparseMedianModel(Model, _CohortParams, _Stored):
    """state: cohort (null for all rows), n and median."""

    def __init__(self, state: DataFrame | None = None):
        super().__init__()
        self.state = state

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, out = F.col(self.getOrDefault("cohortCol")).cast("string"), self.getOrDefault("predictionCol")
        own = self.state.where("cohort IS NOT NULL").select(F.col("cohort").alias("_cohort"), F.col("median").alias("_median"))
        whole = self.state.where("cohort IS NULL").agg(F.max("median").alias("_all"))  # one row, also if nothing was known
        df = dataset.join(own, key == F.col("_cohort"), "left").join(whole).withColumn(out, F.coalesce("_median", "_all")).drop("_cohort", "_median", "_all")
        if self.getOrDefault("formula"):
            w = self.getOrDefault("weight")
            df = df.withColumn(out, (1 - w) * F.col(out) + w * F.expr(self.getOrDefault("formula")))
        return df.withColumn("formula_version", F.lit(self.getOrDefault("formulaVersion") if self.getOrDefault("formula") else "none"))


# ---- boosted quantiles -------------------------------------------------------------------------------------------------

#: Quantiles, least rows of a boosted lane and of a leaf, clip points, half-life of a prior in days.
QUANTILES, LEAST, LEAF, CLIP, HALF_LIFE = (0.1, 0.5, 0.9), 24, 5, (0.01, 0.99), 365.0
#: Bins of a feature (0 is for missing values), of residuals, and categories that have a bin of their own.
BINS, RESIDUALS, CATEGORIES = 33, 1024, 31
MODES = ("external", "history")
#: Rows that are summed together, at least.
TOGETHER = 1 << 16
#: Boosters: a mode and a quantile each.
BOOSTERS = [(m, q) for m in range(len(MODES)) for q in range(len(QUANTILES))]


def _bins(lane: pa.Array, numeric: list[pa.Array], categories: list[pa.Array], cuts: dict[str, list[list[float]]]) -> tuple[list[tuple[str, np.ndarray]], np.ndarray]:
    """The rows of each lane, and the bins of all features, a line for each: 0 for a missing value, then how many of the lane's cuts lie below; categories by their numbers."""
    lane = lane.dictionary_encode()
    code = lane.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    groups = [(name, np.flatnonzero(code == k)) for k, name in enumerate(lane.dictionary.to_pylist())]
    out = np.ones((len(numeric) + len(categories), len(lane)), np.uint8)
    for k, x in enumerate(numeric):
        v = x.to_numpy(zero_copy_only=False)
        for name, at in groups:
            if name in cuts:
                out[k, at] = np.searchsorted(np.array(cuts[name][k], float), v[at]) + 1
        out[k, x.is_null().to_numpy(zero_copy_only=False)] = 0
    for k, x in enumerate(categories):
        out[len(numeric) + k] = x.to_numpy(zero_copy_only=False)
    return groups, out


class _BoostParams(HasLabelCol):
    laneCol = Param(Params._dummy(), "laneCol", "column whose values have trees of their own", TypeConverters.toString)
    featureCols = Param(Params._dummy(), "featureCols", "numeric features", TypeConverters.toListString)
    categoryCols = Param(Params._dummy(), "categoryCols", "features that are names", TypeConverters.toListString)
    priorCol = Param(Params._dummy(), "priorCol", "an earlier figure; blank for none", TypeConverters.toString)
    priorAtCol = Param(Params._dummy(), "priorAtCol", "when the earlier figure was seen", TypeConverters.toString)
    asOfCol = Param(Params._dummy(), "asOfCol", "when the label was seen, or is asked for", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "trees of each lane, mode and quantile", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of each tree's step", TypeConverters.toFloat)
    estimateCol = Param(Params._dummy(), "estimateCol", "where estimates go", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(categoryCols=[], priorCol="", priorAtCol="", asOfCol="", trees=24, rate=0.15, estimateCol="estimate", labelCol="label")

    def _features(self) -> tuple[list[Column], Column]:
        """Numeric features, those of the prior last, and whether the prior counts: it is there and was seen before the label."""
        out = [F.col(c).cast("double") for c in self.getOrDefault("featureCols")]
        if not self.getOrDefault("priorCol"):
            return out, F.lit(False)
        prior, seen, now = (F.col(self.getOrDefault(p)) for p in ("priorCol", "priorAtCol", "asOfCol"))
        age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(seen.cast("timestamp"))) / 86_400e6
        valid = F.coalesce((prior >= 0) & (age > 0), F.lit(False))
        weight = F.exp(-F.log1p(F.lit(1.0)) * age / HALF_LIFE)
        return [*out, F.when(valid, F.log1p(prior.cast("double"))), F.when(valid, age), F.when(valid, weight)], valid

    def _categories(self, names: list[dict[str, int]]) -> list[Column]:
        """The numbers of the category features: the order of their labels, 0 for others."""
        out = []
        for c, known in zip(self.getOrDefault("categoryCols"), names, strict=True):
            table = F.create_map(*(F.lit(v) for kv in known.items() for v in kv)) if known else None
            out.append((F.coalesce(F.element_at(table, F.lower(F.trim(F.col(c).cast("string")))), F.lit(0)) if known else F.lit(0)).cast("tinyint"))
        return out


def _node(tree: dict, i: int, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of each of a lane's rows after `depth` splits, two at most; a lane without a split keeps its rows to the left."""
    over = lambda d, k: bins[int(tree["feature"][d][i, k])] > int(tree["cut"][d][i, k])
    if not depth:
        return np.zeros(bins.shape[1], np.uint8)
    right = over(0, 0)
    if depth == 1:
        return right.view(np.uint8)
    return right.view(np.uint8) * np.uint8(2) + np.where(right, over(1, 1), over(1, 0)).view(np.uint8)


def _raised(trees: list[dict], i: int, bins: np.ndarray, base: np.ndarray) -> np.ndarray:
    out = np.full(bins.shape[1], float(base[i]))
    for t in trees:
        out += t["leaf"][i].take(_node(t, i, bins, 2))
    return out


class QuantileBoost(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """p10, p50 and p90 of a lane's label by trees of depth two on log1p, without and with an earlier figure.

    All rows count.  Rows are binned once, by numpy.  Each level of each tree is one job for all lanes, modes and quantiles:
    tasks count gradients by bin over a lane's rows at a time, whose splits are the same, Spark adds the counts, and the driver, which gets a figure for each lane, booster, node, feature and
    bin (however many rows there are), picks the splits.  A lane with few rows has its empirical quantiles.
    """

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> QuantileBoostModel:
        lane, label = F.col(self.getOrDefault("laneCol")).cast("string"), F.col(self.getOrDefault("labelCol")).cast("double")
        known = dataset.where(lane.isNotNull() & (label >= 0))
        numeric, _ = self._features()
        ends = exact_quantiles(known.select(lane.alias("lane"), label.alias("y")), ["lane"], F.col("y"), list(CLIP), "clip")
        ends = written(ends)  # a row for each lane, asked for twice
        clipped = known.withColumn("_lane", lane).join(ends.select(F.col("lane").alias("_lane"), "clip"), "_lane")
        clipped = clipped.withColumn("_y", F.least(F.greatest(label, F.get("clip", F.lit(0))), F.get("clip", F.lit(1))))
        empirical = {r["_lane"]: (r["n"], list(r["q"])) for r in exact_quantiles(clipped, ["_lane"], F.col("_y"), list(QUANTILES), "q").collect()}  # a row for each lane
        share = [k / (BINS - 1) for k in range(1, BINS - 1)]
        sketch = known.groupBy(lane.alias("lane")).agg(*(F.percentile_approx(x, share, 1000).alias(f"c{k}") for k, x in enumerate(numeric)))
        cuts = {r["lane"]: [sorted(set(r[f"c{k}"] or [])) for k in range(len(numeric))] for r in sketch.collect()}
        names = []
        for c in self.getOrDefault("categoryCols"):
            value = F.lower(F.trim(F.col(c).cast("string")))
            often = known.where(value.isNotNull()).groupBy(value.alias("v")).agg(F.count("*").alias("n"), F.avg(F.log1p(label)).alias("m")).orderBy(F.desc("n"), "v").limit(CATEGORIES).collect()
            names.append({r["v"]: k + 1 for k, r in enumerate(sorted(often, key=lambda r: (r["m"], r["v"])))})
        lanes = sorted(k for k, (n, _) in empirical.items() if n >= LEAST)
        model: dict = {"lanes": lanes, "cuts": cuts, "names": names, "empirical": {k: q for k, (_, q) in empirical.items()}, "boosters": None}
        if lanes:
            index = F.create_map(*(F.lit(v) for k, x in enumerate(lanes) for v in (x, k)))
            table = written(_table(clipped.select("_lane", F.log1p("_y").alias("y"), *(x.alias(f"x{k}") for k, x in enumerate(numeric)), *(x.alias(f"c{k}") for k, x in enumerate(self._categories(names)))), lanes, cuts, len(numeric)))
            model["boosters"] = _boost(table, [empirical[k] for k in lanes], len(self.getOrDefault("featureCols")), len(numeric), len(names), self.getOrDefault("trees"), self.getOrDefault("rate"))
            forget(table)
        forget(ends)
        text = json.dumps(model, sort_keys=True)
        return self._copyValues(QuantileBoostModel(dataset.sparkSession.createDataFrame([(text,)], "model string")))


def _table(rows: DataFrame, lanes: list[str], cuts: dict[str, list[list[float]]], numeric: int) -> DataFrame:
    """lane (its number), y and bins (a byte for each feature) of rows (_lane, y, numeric features, categories) of these lanes."""

    def run(batches):
        for b in batches:
            groups, bins = _bins(b.column(0), b.columns[2 : 2 + numeric], b.columns[2 + numeric :], cuts)
            lane = np.full(b.num_rows, -1, np.int32)
            for name, at in groups:
                lane[at] = lanes.index(name) if name in lanes else -1
            kept, width = np.flatnonzero(lane >= 0), len(bins)
            own = np.ascontiguousarray(bins[:, kept].T)
            packed = pa.Array.from_buffers(pa.binary(), kept.size, [None, pa.py_buffer(np.arange(kept.size + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(own)])
            yield pa.RecordBatch.from_arrays([pa.array(lane[kept]), b.column(1).take(pa.array(kept)), packed], ["lane", "y", "bins"])

    return rows.mapInArrow(run, "lane int, y double, bins binary")


def _by_lane(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """lane, y and bins (a line for each feature) of the rows of a lane, some batches together."""

    def parts(held):
        t = pa.Table.from_batches(held).combine_chunks()
        lane, y, bins = t["lane"].to_numpy(), t["y"].to_numpy(), t["bins"].combine_chunks()
        width = len(bins[0].as_py())
        flat = np.frombuffer(bins.buffers()[2], np.uint8)[bins.offset * width : (bins.offset + len(bins)) * width].reshape(len(bins), width)
        for i in np.unique(lane):
            at = np.flatnonzero(lane == i)
            yield int(i), y[at], np.ascontiguousarray(flat[at].T)

    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= TOGETHER:
            yield from parts(held)
            held, n = [], 0
    if held:
        yield from parts(held)


def _sums(table: DataFrame, work, shape: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and counts of this shape, summed over all rows: work adds a lane's rows to both, and each task sends a row for each figure that it met."""

    def run(batches):
        weight, count = np.zeros(shape), np.zeros(shape, np.int64)
        for lane, y, bins in _by_lane(batches):
            work(lane, y, bins, weight, count)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weight.ravel()[at]), pa.array(count.ravel()[at])], ["key", "weight", "count"])

    rows = table.mapInArrow(run, "key long, weight double, count long").groupBy("key").agg(F.sum("weight").alias("w"), F.sum("count").alias("n")).toPandas()
    weight, count = np.zeros(shape), np.zeros(shape, np.int64)
    weight.ravel()[rows["key"]], count.ravel()[rows["key"]] = rows["w"], rows["n"]
    return weight, count


def _split(weight: np.ndarray, count: np.ndarray, least: int) -> tuple[int, int]:
    """The feature and bin (features by bins) behind which a node is cut, by the most gain; bin BINS cuts nothing."""
    w, n = weight.cumsum(1)[:, :-1], count.cumsum(1)[:, :-1]
    total, rows = weight[0].sum(), count[0].sum()
    fits = (n >= least) & (rows - n >= least)
    if not fits.any():
        return 0, BINS
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, w * w / n + (total - w) ** 2 / (rows - n) - total * total / rows, -1)
    f, c = np.unravel_index(gain.argmax(), gain.shape)
    return (int(f), int(c)) if gain[f, c] > 1e-12 else (0, BINS)


def _boost(table: DataFrame, lanes: list[tuple[int, list[float]]], plain: int, numeric: int, categories: int, trees: int, rate: float) -> list[dict]:
    """For each booster its base by lane and its trees.  Features: plain numeric ones, the prior's, categories; external boosters don't see the prior's."""
    width, many = numeric + categories, len(lanes)
    seen = [np.array([f for f in range(width) if not plain <= f < numeric or m == 1]) for m in range(len(MODES))]
    base = [np.array([np.log1p(q[k]) for _, q in lanes]) for _, k in BOOSTERS]
    reach = max(float(np.log1p(q[-1])) for _, q in lanes) * 4 + 4  # residuals lie within
    grown: list[list[dict]] = [[] for _ in BOOSTERS]
    least = np.array([min(LEAF, max(1, n // 4)) for n, _ in lanes])
    for _ in range(trees):
        new = [{"feature": [np.zeros((many, 1), int), np.zeros((many, 2), int)], "cut": [np.full((many, 1), BINS), np.full((many, 2), BINS)]} for _ in BOOSTERS]
        for depth in range(2):
            nodes = 2**depth

            def gradients(i, y, bins, above, count, depth=depth, nodes=nodes, new=new):
                wide = bins.astype(np.int64)
                for b, (m, _) in enumerate(BOOSTERS):
                    over = y > _raised(grown[b], i, bins, base[b])
                    at = (_node(new[b], i, bins, depth).astype(np.int64) * 2 + over) * BINS
                    for f in seen[m]:
                        n = np.bincount(at + wide[f], minlength=nodes * 2 * BINS).reshape(nodes, 2, BINS)
                        above[b, i, :, f] += n[:, 1]
                        count[b, i, :, f] += n.sum(1)

            w, n = _sums(table, gradients, (len(BOOSTERS), many, nodes, width, BINS))
            for b, (_, k) in enumerate(BOOSTERS):
                w[b] -= (1 - QUANTILES[k]) * n[b]  # a row above counts q, one below q - 1
            for b, (m, _) in enumerate(BOOSTERS):
                for i in range(many):
                    for node in range(nodes):
                        f, c = _split(w[b, i, node, seen[m]], n[b, i, node, seen[m]], least[i])
                        new[b]["feature"][depth][i, node], new[b]["cut"][depth][i, node] = seen[m][f], c

        def residuals(i, y, bins, weight, count, new=new):
            for b in range(len(BOOSTERS)):
                r = y - _raised(grown[b], i, bins, base[b])
                at = np.clip(((r + reach) / (2 * reach) * RESIDUALS).astype(np.int64), 0, RESIDUALS - 1) + _node(new[b], i, bins, 2).astype(np.int64) * RESIDUALS
                weight[b, i] += np.bincount(at, r, 4 * RESIDUALS).reshape(4, RESIDUALS)
                count[b, i] += np.bincount(at, minlength=4 * RESIDUALS).reshape(4, RESIDUALS)

        w, n = _sums(table, residuals, (len(BOOSTERS), many, 4, RESIDUALS))
        for b, (_, k) in enumerate(BOOSTERS):
            leaf = np.zeros((many, 4))
            for i in range(many):
                for node in range(4):
                    if total := n[b, i, node].sum():
                        at = int(np.searchsorted(n[b, i, node].cumsum(), max(1, np.ceil(QUANTILES[k] * total))))
                        leaf[i, node] = rate * w[b, i, node, at] / n[b, i, node, at]  # the mean residual of the bin that holds the quantile
            grown[b].append({**new[b], "leaf": leaf})
    plain_lists = lambda t: {"feature": [x.tolist() for x in t["feature"]], "cut": [x.tolist() for x in t["cut"]], "leaf": t["leaf"].tolist()}
    return [{"base": base[b].tolist(), "trees": [plain_lists(t) for t in grown[b]]} for b in range(len(BOOSTERS))]


class QuantileBoostModel(Model, _BoostParams, _Stored):
    """state: one row, the model as JSON (some kilobytes for each lane)."""

    def __init__(self, state: DataFrame | None = None):
        super().__init__()
        self.state = state

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = json.loads(self.state.first()["model"])
        arrays = lambda t: {"feature": [np.array(x) for x in t["feature"]], "cut": [np.array(x) for x in t["cut"]], "leaf": np.array(t["leaf"])}
        boosters = model["boosters"] and [(np.array(b["base"]), [arrays(t) for t in b["trees"]]) for b in model["boosters"]]
        index = {x: k for k, x in enumerate(model["lanes"])}
        ship = dataset.sparkSession.sparkContext.broadcast((boosters, index, model["empirical"]))

        cuts, wide = model["cuts"], len(self._features()[0])

        @F.arrow_udf("struct<p10: double, p50: double, p90: double, kind: string, mode: string>")
        def run(lane: pa.Array, prior: pa.Array, *features: pa.Array) -> pa.Array:
            own, known, flat = ship.value
            groups, bins = _bins(lane, list(features[:wide]), list(features[wide:]), cuts)
            out, there = np.zeros((3, len(lane))), np.zeros(len(lane), bool)
            history = prior.to_numpy(zero_copy_only=False).astype(bool)
            kind, mode = np.full(len(lane), "none", object), np.full(len(lane), "unavailable", object)
            for name, at in groups:
                if name in known:
                    for m in range(len(MODES)):
                        rows = at[history[at] == bool(m)]
                        x = np.ascontiguousarray(bins[:, rows])
                        raw = [_raised(own[b][1], known[name], x, own[b][0]) for b, (mm, _) in enumerate(BOOSTERS) if mm == m]
                        out[:, rows] = np.sort(np.maximum(0.0, np.expm1(raw)), axis=0)
                    kind[at] = "boosted"
                elif name in flat:
                    out[:, at] = np.array(flat[name], float)[:, None]
                    kind[at] = "empirical"
                else:
                    continue
                mode[at], there[at] = np.where(history[at], MODES[1], MODES[0]), True
            return pa.StructArray.from_arrays([*(pa.array(x, pa.float64(), mask=~there) for x in out), pa.array(kind, pa.string()), pa.array(mode, pa.string())], ["p10", "p50", "p90", "kind", "mode"])

        lane = F.col(self.getOrDefault("laneCol")).cast("string")
        numeric, valid = self._features()
        return dataset.withColumn(self.getOrDefault("estimateCol"), run(lane, valid, *numeric, *self._categories(model["names"])))
