"""Joins by key, time, range and cohort.  A side is never broadcast here: Spark decides by its size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.aggregates import exact_quantiles


def last_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is first in a total order: one shuffle, and a key's rows aren't gathered."""
    # max_by keeps one row for each key on each side of the shuffle, which a window wouldn't
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, "_r.*")


def latest(df: DataFrame, key: str, at: str, tie: str, where: Column | None = None) -> DataFrame:
    """Each key's newest row (ties: the greatest of tie)."""
    kept = df if where is None else df.where(where)
    rest = [c for c in df.columns if c != key]
    return kept.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(at, tie)).alias("_r")).select(key, "_r.*")


def usable_prior(value: Column, observed: Column, as_of: Column) -> Column:
    """A prior counts only if it is there and was seen strictly before."""
    return F.coalesce(value.isNotNull() & observed.isNotNull() & (as_of > observed), F.lit(False))


def cohort_fallback(df: DataFrame, stats: DataFrame, levels: list[list[str]], least: list[int]) -> DataFrame:
    """df with the statistics of the first cohort level that has enough rows, and that level's number.

    stats: one row per cohort and level: level, the key columns (null where unused), n, value.
    """
    out = df
    for k, keys in enumerate(levels):
        own = stats.where((F.col("level") == k) & (F.col("n") >= least[k])).select(*(F.col(c).alias(f"_k_{c}") for c in keys), F.col("value").alias(f"_v{k}"), F.col("n").alias(f"_n{k}"))
        on = [df[c].eqNullSafe(F.col(f"_k_{c}")) for c in keys] or [F.lit(True)]
        out = out.join(own, on, "left").drop(*(f"_k_{c}" for c in keys))
    level = F.coalesce(*(F.when(F.col(f"_v{k}").isNotNull(), F.lit(k)) for k in range(len(levels))))
    value, n = F.coalesce(*(F.col(f"_v{k}") for k in range(len(levels)))), F.coalesce(*(F.col(f"_n{k}") for k in range(len(levels))))
    return out.withColumns({"cohort_level": level, "cohort_value": value, "cohort_n": n}).drop(*(f"_{p}{k}" for k in range(len(levels)) for p in "vn"))


def cohort_stats(df: DataFrame, levels: list[list[str]], value: str, q: float) -> DataFrame:
    """Rows and a quantile of value in all cohorts of all levels: values are counted once, and the counts, not the rows, go to each level."""
    every = sorted({c for keys in levels for c in keys})
    counts = df.where(F.col(value).isNotNull()).groupBy(*every, value).agg(F.count("*").alias("_n"))
    rows = [F.struct(F.lit(k).alias("level"), *((F.col(c) if c in keys else F.lit(None).cast(dict(df.dtypes)[c])).alias(c) for c in every)) for k, keys in enumerate(levels)]
    flat = counts.select(value, "_n", F.explode(F.array(*rows)).alias("_g")).select(value, "_n", "_g.*")
    return exact_quantiles(flat, ["level", *every], F.col(value), [q], weight=F.col("_n")).withColumn("value", F.get("quantiles", F.lit(0))).drop("quantiles")


def in_ratio(df: DataFrame, other: DataFrame, key: list[str], x: str, y: str, low: float, high: float) -> DataFrame:
    """Pairs of equal key whose y / x lies in [low, high], by bands of equal ratio: each row meets its own band and its neighbours only.  Zero goes with zero."""
    import math

    width = math.log(high / low) / 2
    cell = lambda c: F.floor(F.log(c) / width).cast("int")
    zero = F.lit(-(1 << 30))
    bands = F.when(F.col(x) > 0, F.sequence(cell(F.col(x) * low), cell(F.col(x) * high))).otherwise(F.array(zero))
    left = df.where(F.col(x) >= 0).withColumn("_b", F.explode(bands))
    right = other.where(F.col(y) >= 0).withColumn("_b", F.when(F.col(y) > 0, cell(F.col(y))).otherwise(zero))
    return left.join(right, [*key, "_b"]).where((F.col(y) >= low * F.col(x)) & (F.col(y) <= high * F.col(x))).drop("_b")


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Per state (both, only_a, only_b, duplicate_a, duplicate_b, blank_a, blank_b) the number of ids.  One shuffle for both sides."""
    side = lambda df, n: df.select(F.trim(F.col(key).cast("string")).alias("id"), F.lit(n).alias("s"))
    ids = side(a, 1).unionAll(side(b, 2)).groupBy("id").agg(F.count_if(F.col("s") == 1).alias("a"), F.count_if(F.col("s") == 2).alias("b"))
    blank = F.coalesce(F.col("id"), F.lit("")) == ""
    states = {"both": ~blank & (F.col("a") > 0) & (F.col("b") > 0), "only_a": ~blank & (F.col("b") == 0), "only_b": ~blank & (F.col("a") == 0), "duplicate_a": ~blank & (F.col("a") > 1), "duplicate_b": ~blank & (F.col("b") > 1)}
    sums = [F.count_if(w).alias(n) for n, w in states.items()] + [F.coalesce(F.sum(F.when(blank, F.col(s))), F.lit(0)).cast("long").alias(f"blank_{s}") for s in "ab"]
    return ids.agg(*sums)


def changed_cells(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per cell that differs, on normalised text: key, column, old_value, new_value."""
    norm = lambda c: F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), "\r\n", "\n")
    both = old.select(key, *(F.col(c).alias(f"_o_{c}") for c in columns)).join(new.select(key, *(F.col(c).alias(f"_n_{c}") for c in columns)), key)
    cells = F.array(*(F.struct(F.lit(c).alias("column"), norm(F.col(f"_o_{c}")).alias("old_value"), norm(F.col(f"_n_{c}")).alias("new_value")) for c in columns))
    return both.select(key, F.explode(cells).alias("_c")).select(key, "_c.*").where("old_value <> new_value")


def with_ledger(df: DataFrame, others: dict[str, DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of df that every other table has, and for the rest which tables lack them: (key, missing)."""
    out = df
    for name, other in others.items():
        own = other.select(*(F.col(c).alias(c if c == key else f"{name}_{c}") for c in other.columns), F.lit(True).alias(f"_has_{name}"))
        out = out.join(own, key, "left")
    lacking = F.array_compact(F.array(*(F.when(F.col(f"_has_{n}").isNull(), F.lit(n)) for n in others)))
    out = out.withColumn("_missing", lacking)
    drop = ["_missing", *(f"_has_{n}" for n in others)]
    return out.where(F.size("_missing") == 0).drop(*drop), out.where(F.size("_missing") > 0).select(key, F.array_join("_missing", "; ").alias("missing"))


def cluster_size(df: DataFrame, key: str, name: str = "cluster_size") -> DataFrame:
    """df with the rows of each key's cluster: summed up, then joined, so that no task sorts a cluster."""
    sizes = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias(name))
    return df.join(sizes, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
