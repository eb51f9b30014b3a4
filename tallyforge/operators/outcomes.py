"""Outcomes, rates and audits: label joins, first outcomes with a ledger, rates with pending labels, rank tests, run audits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.aggregates import exact_quantiles, with_range
from tallyforge.operators.rules import Rules, first_match


def same_key(a: DataFrame, b: DataFrame, key: str, other: str, how: str = "inner", suffix: str = "_other") -> DataFrame:
    """Rows whose ids agree but for case and blanks; columns of b that a has too get a suffix."""
    renamed = b.select(*(F.col(c).alias(c + suffix if c in a.columns else c) for c in b.columns))
    own = other + suffix if other in a.columns else other
    return a.join(renamed, F.lower(F.trim(a[key].cast("string"))) == F.lower(F.trim(renamed[own].cast("string"))), how)


def best_duplicate(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Each key's row of the greatest value; ties keep the first in order."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(value), -F.col(order))).alias("_r")).select(key, "_r.*")


def first_outcomes(df: DataFrame, rejects: Rules, unit: str, at: str, tie: str) -> tuple[DataFrame, DataFrame]:
    """The earliest accepted row of each unit, and how many rows were left out for which reason (repeats of a unit too)."""
    marked = df.withColumn("_why", first_match(rejects))
    kept = marked.where("_why IS NULL").drop("_why")
    rest = [c for c in df.columns if c != unit]
    chosen = kept.groupBy(unit).agg(F.min_by(F.struct(*rest), F.struct(at, tie)).alias("_r"), F.count("*").alias("_n"))
    ledger = marked.where("_why IS NOT NULL").groupBy(F.col("_why").alias("reason")).agg(F.count("*").alias("rows"))
    again = chosen.agg(F.lit("duplicate_unit").alias("reason"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("rows")).where("rows > 0")
    return chosen.select(unit, "_r.*"), ledger.unionAll(again)


def rate(good: Column, known: Column, total: Column) -> list[Column]:
    """numerator, denominator, pending, rate (null while labels are pending), and the rate if one good label were bad."""
    n, k = F.count_if(known), F.count_if(known & good)
    pending = F.count_if(total & ~known)
    share = F.when((n > 0) & (pending == 0), k / n)
    return [k.alias("good"), n.alias("known"), pending.alias("pending"), share.alias("rate"), F.when((n > 0) & (pending == 0), F.greatest(k - 1, F.lit(0)) / n).alias("one_flip")]


def anchored_or_median(df: DataFrame, prior: Column, lane: str, value: str) -> DataFrame:
    """df with baseline: a usable prior, else the lane's median of value."""
    medians = exact_quantiles(df, [lane], F.col(value), [0.5]).select(lane, F.get("quantiles", F.lit(0)).alias("_m"))
    return df.join(medians, lane, "left").withColumn("baseline", F.coalesce(prior, F.col("_m"))).drop("_m")


def integer_quantile(value: Column, q: float) -> Column:
    """An interpolated quantile of whole numbers, rounded half up, 1 at least."""
    return F.greatest(F.lit(1), F.round(F.percentile(value, q).cast("decimal(38,10)"), 0).cast("int"))


def mann_whitney(df: DataFrame, group: str, value: str) -> DataFrame:
    """n1, n2, u and z of two groups (group is true or false): mean ranks for ties, tie and continuity correction.

    Ranks come from counts per distinct value, so no task holds all rows of a group.
    """
    counts = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(value).agg(F.count("*").alias("t"), F.count_if(F.col(group)).alias("a"))
    ranged = with_range(counts, value)
    totals = ranged.groupBy("_p").agg(F.sum("t").alias("_t")).withColumn("_first", F.coalesce(F.sum("_t").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = F.sum("t").over(Window.partitionBy("_p").orderBy(value)) - F.col("t")
    ranks = ranged.withColumn("_b", before).join(totals, "_p").select("t", "a", (2 * (F.col("_first") + F.col("_b")) + F.col("t") + 1).alias("r2"))
    d = lambda c: F.sum(c.cast("decimal(38,0)")).cast("double")
    s = ranks.agg(F.sum("a").alias("n1"), F.sum(F.col("t") - F.col("a")).alias("n2"), d(F.col("a") * F.col("r2")).alias("r2"), d(F.col("t").cast("decimal(12,0)") * F.col("t") * F.col("t") - F.col("t")).alias("ties"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n, u = n1 + n2, F.col("r2") / 2 - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    top = F.greatest(u, n1 * n2 - u)
    return s.select("n1", "n2", u.alias("u"), ((top - n1 * n2 / 2 - 0.5) / spread).alias("z"))


def two_sided(z: Column) -> Column:
    """The two-sided p-value of a standard normal z, by a continued approximation of the tail (error below 1.2e-7)."""
    t = 1 / (1 + 0.5 * F.abs(z) / F.sqrt(F.lit(2.0)))
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    #: Chebyshev coefficients of the complementary error function.
    poly = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + F.lit(c)
    return F.least(F.lit(1.0), t * F.exp(-x * x + poly))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a column of the table held in the bits of a number."""
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    row = 0
    for c in b:
        x = row | at.get(c, 0)
        row = x & ~(x - ((row << 1) | 1))
    return row.bit_count()


def indel_ratio(a: Column, b: Column, sort_words: bool = False) -> Column:
    """100 for equal texts: twice the longest common subsequence over both lengths, the words sorted first if asked for."""

    @F.pandas_udf("double")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        order = (lambda s: " ".join(sorted(s.split()))) if sort_words else (lambda s: s)
        for x, y in parts:
            both = [(order(p or ""), order(q or "")) for p, q in zip(x, y, strict=True)]
            yield pd.Series([200.0 * _common(p, q) / (len(p) + len(q)) if p or q else 100.0 for p, q in both], dtype="float64")

    return run(a, b)


#: Rows of a block's two sides that meet in one task, more or less, and table cells held at once.
SAMPLES, RECORDS, CELLS = 2048, 8192, 1 << 15


def _by_words(s: str | None) -> str:
    return " ".join(sorted((s or "").split()))


class _Names:
    """Names whose common subsequences with others are counted all at once: names that begin alike, or end alike, share their columns of the table."""

    def __init__(self, names: list[str]):
        self.lengths = np.array([len(x) for x in names])
        rows, width = len(names), int(self.lengths.max())
        letters, codes = np.unique(np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)
        self.at = {chr(c): k + 1 for k, c in enumerate(letters)}
        column = np.arange(width)
        grid = np.zeros((rows, width), np.int64)
        grid[column < self.lengths[:, None]] = codes + 1
        back = np.where(column < self.lengths[:, None], np.take_along_axis(grid, np.maximum(self.lengths[:, None] - 1 - column, 0), 1), 0) if width else grid
        self._levels: list[tuple] = []
        least = None
        for turned, g in ((False, grid), (True, back)):
            order = np.lexsort(g.T[::-1]) if width else np.arange(rows)
            g = g[order]
            new = np.logical_or.accumulate(g[1:] != g[:-1], axis=1)
            node = np.vstack([np.zeros((1, width), np.int64), np.cumsum(new, axis=0)])
            if least is None or node[-1].sum() < least:
                least, self.turned = node[-1].sum(), turned
                self.leaf = np.empty(rows, np.int64)
                self.leaf[order] = node[:, -1] if width else 0
                self._levels = []
                for t in range(width):
                    first = np.flatnonzero(np.concatenate([[True], new[:, t]]))
                    grows = len(first) > (node[-1, t - 1] + 1 if t else 1)
                    chars = g[first, t]
                    self._levels.append((node[first, t - 1] if grows and t else np.zeros(len(first), np.int64) if grows else None, chars[:1] if (chars == chars[0]).all() else chars))

    def common(self, names: list[str]) -> np.ndarray:
        """Lengths of the longest common subsequences of these names, 64 letters at most each, with each of its own."""
        mask = np.zeros((len(names), len(self.at) + 1), np.uint64)
        full = np.zeros((len(names), 1), np.uint64)
        for i, name in enumerate(names):
            own: dict[int, int] = {}
            for k, c in enumerate(reversed(name) if self.turned else name):
                if code := self.at.get(c):
                    own[code] = own.get(code, 0) | 1 << k
            mask[i, list(own)] = np.array(list(own.values()), np.uint64)
            full[i] = (1 << len(name)) - 1
        row = np.full((len(names), 1), ~np.uint64(0))
        for parent, chars in self._levels:
            if parent is not None:
                row = row.take(parent, 1)
            u = mask.take(chars, 1)
            if u.any():
                u = np.bitwise_and(row, u)
                kept = row - u
                row = np.bitwise_or(np.add(row, u, out=row), kept, out=kept)
        return np.bitwise_count(~row & full).take(self.leaf, 1)


class _Inside:
    """Which of some names stand in another name, or have it in them."""

    def __init__(self, names: list[str | None]):
        self.names, self.rows = names, {}
        for k, x in enumerate(names):
            if x is not None:
                self.rows.setdefault(x, []).append(k)
        self.lengths = sorted({len(x) for x in self.rows})
        self.distinct = list(self.rows)
        self.text = "\0".join(self.distinct)
        self.starts = np.cumsum([0, *(len(x) + 1 for x in self.distinct)])
        self.plain = not any("\0" in x for x in self.distinct)

    def of(self, name: str) -> list[int]:
        found = {name[k : k + n] for n in self.lengths if n <= len(name) for k in range(len(name) - n + 1)} & self.rows.keys()
        if self.plain:
            at = -1 if "\0" in name else self.text.find(name)
            while at >= 0:
                k = int(np.searchsorted(self.starts, at, "right")) - 1
                if k == len(self.distinct):
                    break
                found.add(self.distinct[k])
                at = self.text.find(name, int(self.starts[k + 1])) if k + 1 < len(self.distinct) else -1
        else:
            found |= {x for x in self.distinct if name in x}
        return [k for x in found for k in self.rows[x]]


def _best(samples: list[tuple], records: list[tuple]) -> Iterator[tuple]:
    """rid, similarity, contains and score of the best record (rid, rname, rcity, extra) for each sample (name, city); records come by rid."""
    names, inside = _Names([_by_words(r[1]) for r in records]), _Inside([r[1] for r in records])
    cities, extra = np.array([r[2] or "" for r in records], object), np.array([r[3] for r in records], float)
    with_city: dict[str, np.ndarray] = {}
    step = max(1, CELLS // len(records))
    for k in range(0, len(samples), step):
        part = samples[k : k + step]
        texts = [_by_words(name) for name, _ in part]
        common = names.common([t if len(t) <= 64 else "" for t in texts])
        for i, t in enumerate(texts):
            if len(t) > 64:
                common[i] = 0
        both = np.array([len(t) for t in texts])[:, None] + names.lengths
        common = common.astype(float)
        for i, t in enumerate(texts):
            if len(t) > 64:
                common[i] = [_common(t, _by_words(r[1])) for r in records]
        similarity = np.where(both > 0, 200.0 * common / np.maximum(both, 1), 100.0)
        for (name, city), own in zip(part, similarity, strict=True):
            plus = extra
            if city:
                if city not in with_city:
                    with_city[city] = extra + 15.0 * (cities == city)
                plus = with_city[city]
            hits = [] if name is None else inside.of(name)
            if hits:
                plus = plus.copy()
                plus[hits] += 12.0
            score = own + plus
            b = int(score.argmax())
            contains = None if name is None or records[b][1] is None else b in hits
            yield records[b][0], float(own[b]), contains, float(score[b])


def in_cells(left: DataFrame, right: DataFrame, block: list[str], run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """What run makes of left's and right's rows (distinct ones) of each block; of a large block it gets a slice of either side at a time, and each slice meets each."""
    side = lambda df, s, t: df.select(*block, F.lit(s).alias("_s"), F.lit(t).alias("_t"))
    sizes = side(left, 1, 0).unionByName(side(right, 0, 1)).groupBy(*block).agg(F.ceil(F.sum("_s") / SAMPLES).alias("_s"), F.ceil(F.sum("_t") / RECORDS).alias("_t"))
    large = F.broadcast(sizes.where("_s > 1 OR _t > 1"))  # a row for SAMPLES or RECORDS rows at most
    s, t = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("_s", "_t"))
    own = lambda df, n: F.pmod(F.xxhash64(*df.columns), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    cell, tasks = [*block, "_i", "_j"], int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number, as rows are few and their work is much
    dealt = lambda df, i, j: df.join(large, block, "left").withColumns({"_i": i, "_j": j}).drop("_s", "_t").repartition(tasks, *cell).groupBy(*cell)
    return dealt(left, own(left, s), every(t)).cogroup(dealt(right, every(s), own(right, t))).applyInArrow(run, schema)


def candidate_scores(samples: DataFrame, records: DataFrame, block: str) -> DataFrame:
    """The best record of each sample in its block (id, name, city; rid, rname, rcity, rstate, rtype) by similarity and agreement.

    All distinct names of a block are compared, as any may be the best one; alike records but for state and kind are one,
    the best of them.  A task gets a slice of a block's samples and one of its records, and returns a row for each sample.
    """
    types = dict(records.dtypes)
    extra = F.when(F.col("rstate"), 10).otherwise(0) + F.when(F.col("rtype"), 4).otherwise(0)
    firm = records.where(F.col(block).isNotNull()).groupBy(block, "rname", "rcity").agg(F.max_by(F.struct("rid", extra.alias("extra")), F.struct(extra, -F.col("rid"))).alias("_r")).select(block, "rname", "rcity", "_r.*")
    asked = samples.where(F.col(block).isNotNull()).select(block, "name", "city").distinct()
    schema = f"`{block}` {dict(samples.dtypes)[block]}, name string, city string, rid {types['rid']}, similarity double, contains boolean, score double"

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        a, b = a.select([block, "name", "city"]), b.select(["rid", "rname", "rcity", "extra"]).sort_by("rid")
        out = a.slice(0, a.num_rows if b.num_rows else 0)
        rows = list(zip(*(a[c].to_pylist() for c in ("name", "city")), strict=True)) if out.num_rows else []
        found = list(zip(*_best(rows, list(zip(*(c.to_pylist() for c in b.columns), strict=True))), strict=True)) if rows else [[]] * 4
        for name, values, kind in zip(("rid", "similarity", "contains", "score"), found, (b.schema.field("rid").type, pa.float64(), pa.bool_(), pa.float64()), strict=True):
            out = out.append_column(name, pa.array(values, kind))
        return out

    best = in_cells(asked, firm, [block], run, schema).select(F.col(block).alias("_b"), F.col("name").alias("_n"), F.col("city").alias("_c"), "rid", "similarity", "contains", "score")
    same = (F.col(block) == F.col("_b")) & F.col("name").eqNullSafe(F.col("_n")) & F.col("city").eqNullSafe(F.col("_c"))
    met = samples.join(best.hint("merge"), same)
    top = met.groupBy("id").agg(F.max_by(F.struct("rid", "similarity", "contains", "score"), F.struct("score", -F.col("rid"))).alias("b")).select("id", "b.*")
    return top.withColumn("plausible", (F.col("similarity") >= 84) | F.col("contains"))


def audit(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row per check: rows that fail it, and whether none does.  One pass for all checks."""
    failed = [F.struct(F.lit(n).alias("check"), F.count_if(~F.coalesce(c, F.lit(False))).alias("failed")) for n, c in checks.items()]
    return df.agg(F.array(*failed).alias("c")).select(F.explode("c").alias("c")).select("c.check", "c.failed", (F.col("c.failed") == 0).alias("passed"))


def unfinished(df: DataFrame, done: DataFrame, key: str, same: str) -> DataFrame:
    """Rows still to do: those not done, and those done for another value of `same`."""
    return df.join(done.select(key, same), [key, same], "left_anti")


def in_order(df: DataFrame, order: DataFrame, key: str, place: str, unknown: int = 999_999) -> DataFrame:
    """df with the place of each key in another table's order; keys that aren't there come last."""
    return df.join(order.select(key, place), key, "left").withColumn(place, F.coalesce(place, F.lit(unknown)))
