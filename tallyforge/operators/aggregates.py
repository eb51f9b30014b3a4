"""Aggregates: usage features, quantiles, regression and precision metrics, drift, coverage, votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the two-sided 95 % point of the normal distribution.
Z95 = 1.959963984540054


def frequency(df: DataFrame, column: str, blank: str = "(blank)") -> DataFrame:
    value = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit(blank))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def breakdown(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n) of several dimensions, stacked: one read, one shuffle."""
    cells = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions))
    return df.select(F.explode(cells).alias("c")).groupBy("c.dimension", "c.value").agg(F.count("*").alias("n"))


def text_list(c: Column) -> Column:
    """Distinct values, sorted, joined by '; '."""
    return F.array_join(F.array_sort(F.collect_set(c)), "; ")


def money_sum(c: Column, where: Column | None = None) -> Column:
    """Exact sum of cents as a double."""
    x = c.cast("decimal(18,2)")
    return F.coalesce(F.sum(x if where is None else F.when(where, x)), F.lit(0)).cast("double")


def regression_metrics(actual: Column, predicted: Column, low: Column | None = None, high: Column | None = None) -> list[Column]:
    """Errors of a prediction as aggregates, in exact cents where they are sums; medians are regression_report's."""
    err = (predicted.cast("decimal(18,2)") - actual.cast("decimal(18,2)")).cast("decimal(18,2)")
    n = F.count("*")
    out = [
        n.alias("n"), (F.sum(F.abs(err)).cast("double") / n).alias("mae"), (F.sum(err).cast("double") / n).alias("bias"),
        (F.count_if(err > 0) / n).alias("over_rate"), (F.count_if(err < 0) / n).alias("under_rate"),
    ]
    if low is not None:
        out += [(F.count_if((actual >= low) & (actual <= high)) / n).alias("coverage"), F.count_if(low > high).alias("violations")]
    return out


def wilson_low(good: Column, n: Column, z: float = Z95) -> Column:
    p, z2 = good / n, z * z
    return (p + z2 / (2 * n) - z * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n)) / (1 + z2 / n)


def shares(df: DataFrame, group: str, sides: tuple[Column, Column]) -> DataFrame:
    """Per value the share among rows of either side: group, p, q."""
    counts = df.groupBy(group).agg(F.count_if(sides[0]).alias("a"), F.count_if(sides[1]).alias("b"))
    everything = Window.partitionBy()
    return counts.select(group, (F.col("a") / F.sum("a").over(everything)).alias("p"), (F.col("b") / F.sum("b").over(everything)).alias("q"))


def psi(p: Column, q: Column, eps: float = 1e-6) -> Column:
    a, b = F.greatest(p, F.lit(eps)), F.greatest(q, F.lit(eps))
    return (b - a) * F.log(b / a)


def stability(value: Column) -> Column:
    return F.when(value < 0.10, "stable").when(value < 0.25, "review").otherwise("material")


def column_coverage(df: DataFrame) -> DataFrame:
    """Per column how many rows hold something (text: more than blanks)."""
    n = F.count("*")
    there = [F.struct(F.lit(c).alias("column"), F.count_if((F.trim(F.col(c)) != "") if kind == "string" else F.col(c).isNotNull()).alias("present"), n.alias("n")) for c, kind in df.dtypes]
    flat = df.agg(F.array(*there).alias("a")).select(F.explode("a").alias("c"))
    return flat.select("c.column", "c.present", (F.col("c.present") * 100.0 / F.col("c.n")).alias("percent"))


#: Ranges for each doubling of a value; 2.2 million ranges hold all doubles.
PER_DOUBLING = 512


def range_of(c: Column) -> Column:
    """The number of a value's range: ranges go up with the value, each some 0.14 % wide.

    A range is a function of the value alone: no job looks for bounds, no row is compared with a list, and it is the same
    wherever and however often it is computed.
    """
    v = c.cast("double")
    size = F.floor((F.log2(F.abs(v)) + 1100) * PER_DOUBLING).cast("int")  # the least double is 2^-1074
    return F.when(F.isnan(v), 1 << 30).when(v > 0, size).when(v < 0, -size).otherwise(0)  # NaN is the greatest


def with_range(df: DataFrame, c: str) -> DataFrame:
    """df with _p, its value's range."""
    return df.withColumn("_p", range_of(F.col(c)))


def exact_quantiles(df: DataFrame, keys: list[str], value: Column, qs: list[float], name: str = "quantiles", weight: Column | None = None) -> DataFrame:
    """keys, n and the interpolated quantiles (an array) of each group, whatever its size.

    Counts per value are summed by ranges of values; only the ranges that a quantile's place falls in are ranked value by
    value: no buffer holds a group's values, as an exact percentile's would.  Rows of null keys are a group.  A row counts
    `weight` times (once without it).
    """
    rows = df.select(F.struct(F.lit(0).alias("_"), *keys).alias("_k"), value.cast("double").alias("_v"), *([] if weight is None else [weight.alias("_w")])).where("_v IS NOT NULL")
    counts = rows.groupBy("_k", "_v").agg((F.count("*") if weight is None else F.sum("_w")).alias("_c"))
    ranged = with_range(counts, "_v")
    group = Window.partitionBy("_k")
    totals = ranged.groupBy("_k", "_p").agg(F.sum("_c").alias("_t"))
    totals = totals.withColumn("_first", F.sum("_t").over(group.orderBy("_p")) - F.col("_t")).withColumn("n", F.sum("_t").over(group))
    places = [f(F.lit(q) * (F.col("n") - 1)) for q in qs for f in (F.floor, F.ceil)]
    needed = F.exists(F.array(*places), lambda k: (F.col("_first") <= k) & (k < F.col("_first") + F.col("_t")))
    totals = totals.where(needed).drop("_t")
    end = F.col("_first") + F.sum("_c").over(Window.partitionBy("_k", "_p").orderBy("_v"))
    ranked = ranged.join(totals, ["_k", "_p"]).withColumn("_end", end).withColumn("_begin", F.col("_end") - F.col("_c"))
    out = []
    for q in qs:
        place = F.lit(q) * (F.col("n") - 1)
        low, high = F.floor(place), F.ceil(place)
        at = lambda k: F.max(F.when((F.col("_begin") <= k) & (k < F.col("_end")), F.col("_v")))
        out += [at(low).alias(f"_l{len(out)}"), at(high).alias(f"_h{len(out)}")]
    found = ranked.groupBy("_k").agg(F.first("n").alias("n"), *out)
    values = []
    for k, q in enumerate(qs):
        place = F.lit(q) * (F.col("n") - 1)
        low, high, a, b = F.floor(place), F.ceil(place), F.col(f"_l{2 * k}"), F.col(f"_h{2 * k}")
        values.append(F.when(low == high, a).otherwise((high - place) * a + (place - low) * b))
    return found.select(*(F.col(f"_k.{c}").alias(c) for c in keys), "n", F.array(*values).alias(name))


def regression_report(df: DataFrame, keys: list[str], actual: Column, predicted: Column, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """regression_metrics of each group of keys, and its median errors found without a buffer of errors."""
    err = (predicted.cast("decimal(18,2)") - actual.cast("decimal(18,2)")).cast("decimal(18,2)")
    out = df.groupBy(*keys).agg(*regression_metrics(actual, predicted, low, high))
    both = F.explode(F.array(F.struct(F.lit("median_ae").alias("what"), F.abs(err).alias("error")), F.struct(F.lit("median_bias").alias("what"), err.alias("error"))))
    mid = exact_quantiles(df.select(*keys, both.alias("_e")).select(*keys, "_e.*"), [*keys, "what"], F.col("error"), [0.5])
    wide = mid.groupBy(*(F.col(c).alias(f"_{c}") for c in keys)).agg(*(F.max(F.when(F.col("what") == n, F.get("quantiles", F.lit(0)))).alias(n) for n in ("median_ae", "median_bias")))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out.join(wide, same, "left").drop(*(f"_{c}" for c in keys))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """n and rank correlation with mean ranks for ties.

    Ranks come from counts per distinct value; the running sum goes over ranges of values and then over the ranges, so no
    task holds all rows.
    """
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))

    def ranks(c: str) -> DataFrame:
        counts = pairs.groupBy(c).agg(F.count("*").alias("n"))
        ranged = with_range(counts, c)
        local = ranged.withColumn("_before", F.sum("n").over(Window.partitionBy("_p").orderBy(c)) - F.col("n"))
        totals = ranged.groupBy("_p").agg(F.sum("n").alias("t")).withColumn("_first", F.coalesce(F.sum("t").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        return local.join(totals, "_p").select(c, (F.col("_first") + F.col("_before") + (F.col("n") + 1) / 2).alias(f"r{c}"))

    ranked = pairs.join(ranks("x"), "x").join(ranks("y"), "y")
    n = F.count("*")
    # ranks are multiples of one half: sums of four times their products are exact integers
    a, b = (F.col("rx") * 2).cast("decimal(20,0)"), (F.col("ry") * 2).cast("decimal(20,0)")
    sums = ranked.agg(n.alias("n"), F.sum(a).alias("sa"), F.sum(b).alias("sb"), F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb"), F.sum(a * b).alias("ab"))
    d = lambda c: F.col(c).cast("double")
    top = d("n") * d("ab") - d("sa") * d("sb")
    return sums.select("n", (top / F.sqrt((d("n") * d("aa") - d("sa") * d("sa")) * (d("n") * d("bb") - d("sb") * d("sb")))).alias("rho"))


def unique_top(votes: DataFrame, group: str, candidate: str, weight: Column, least: float, lead: float) -> DataFrame:
    """The candidate with the most weight of each group if it has enough and leads clearly; null otherwise."""
    sums = votes.groupBy(group, candidate).agg(weight.alias("w"))
    best = sums.groupBy(group).agg(F.max(F.struct("w", candidate)).alias("top"), F.sum("w").alias("total"))
    second = sums.join(best.select(group, F.col(f"top.{candidate}").alias("_c")), group).where(F.col(candidate) != F.col("_c")).groupBy(group).agg(F.max("w").alias("second"))
    out = best.join(second, group, "left").withColumn("second", F.coalesce("second", F.lit(0)))
    clear = (F.col("top.w") >= least) & (F.col("top.w") - F.col("second") >= lead) & (F.col("top.w") > F.col("second"))
    return out.select(group, F.when(clear, F.col(f"top.{candidate}")).alias("winner"), F.col("top.w").alias("top_weight"), F.col("second").alias("second_weight"))


def ranks(df: DataFrame, keys: list[str], value: str, order: list[Column], name: str = "rank") -> DataFrame:
    """df with each row's place among its keys' rows by falling value, then order: places within ranges of the value, behind the rows of greater ranges."""
    ranged = with_range(df, value)
    totals = ranged.groupBy(*keys, "_p").agg(F.count("*").alias("_t"))
    before = (F.sum("_t").over(Window.partitionBy(*keys).orderBy(F.desc("_p"))) - F.col("_t")).alias("_before")
    totals = totals.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_p").alias("_q"), before)
    same = F.col("_p") == F.col("_q")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    within = F.row_number().over(Window.partitionBy(*keys, "_p").orderBy(F.desc(value), *order))
    return ranged.withColumn("_within", within).join(totals, same).withColumn(name, (F.col("_before") + F.col("_within")).cast("int")).select(*df.columns, name)
