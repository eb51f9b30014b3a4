"""Rows near a value, and sums over ranges of values, without a pair of rows for each that is near.

Values fall into ranges that depend on the value alone (`with_range`).  A range query is cut into dyadic blocks of whole
ranges, whose sums are found once, and two ends, met by running sums within their range; nearest rows are met by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.aggregates import range_of, with_range

#: Doublings of blocks: the largest holds 2^LEVELS ranges.
LEVELS = 12


def _blocks(queries: DataFrame) -> DataFrame:
    """queries (with the ranges _a and _z of their ends) by level and block: the dyadic blocks that fill the ranges between, two a level at most, but for the largest.

    At level k the blocks wholly between run from ceil((_a + 1) / 2^k) to floor(_z / 2^k) - 1; of these an odd first one and
    an even last one stand alone, and what is between them goes up.
    """
    levels = queries.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    ends = levels.withColumns({"_lo": F.expr("shiftright(_a + shiftleft(1, level), level)"), "_hi": F.expr("shiftright(_z, level) - 1")}).where("_lo <= _hi")
    alone = "array_compact(array(CASE WHEN pmod(_lo, 2) = 1 THEN _lo END, CASE WHEN pmod(_hi, 2) = 0 AND NOT (_lo = _hi AND pmod(_lo, 2) = 1) THEN _hi END))"
    return ends.withColumn("block", F.explode(F.expr(f"CASE WHEN level = {LEVELS} THEN sequence(_lo, _hi) ELSE {alone} END"))).drop("_lo", "_hi")


def over_range(queries: DataFrame, pool: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """id, n and least for each query (id, keys, low, high): how many rows of pool (keys, v, rid) have low <= v <= high, and their least rid.

    low and high must lie in different ranges (2 % apart is enough), or be the same value 0.  Queries that nothing meets are left out.
    Blocks meet their queries sorted, never broadcast: a file of many rows that repeat looks small, and the driver would hold them all.
    """
    pool = with_range(pool.where("v IS NOT NULL"), "v")
    ends = queries.where(F.col(low).isNotNull() & F.col(high).isNotNull())
    # blocks of whole ranges between the ends
    asked = _blocks(ends.select("id", *keys, range_of(F.col(low)).alias("_a"), range_of(F.col(high)).alias("_z"))).select("id", *keys, "level", "block")
    ranges = pool.groupBy(*keys, "_p").agg(F.count("*").alias("n"), F.min("rid").alias("least"))
    whole = ranges.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumn("block", F.expr("shiftright(_p, level)"))
    blocks = whole.groupBy(*keys, "level", "block").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    inner = asked.join(blocks.hint("merge"), [*keys, "level", "block"]).select("id", "n", "least")

    def end(c: str, upward: bool, queries: DataFrame) -> DataFrame:
        """What of pool lies in the range of a query's end, on its side."""
        q = with_range(queries.select(*keys, F.col(c).alias("v"), F.lit(None).cast("long").alias("rid"), "id", F.lit(1).alias("_q")), "v")
        p = pool.select(*keys, "v", "rid", F.lit(None).cast(dict(ends.dtypes)["id"]).alias("id"), F.lit(0).alias("_q"), "_p")
        order = [F.col("v").asc() if upward else F.col("v").desc(), F.col("_q")]
        w = Window.partitionBy(*keys, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        both = p.unionByName(q.select(*p.columns))
        return both.withColumns({"n": F.count("rid").over(w), "least": F.min("rid").over(w)}).where("_q = 1").select("id", "n", "least")

    low_end = end(low, False, ends).where("n > 0")
    high_end = end(high, True, ends.where(F.col(low) != F.col(high))).where("n > 0")  # a single value is counted once
    return inner.unionByName(low_end).unionByName(high_end).groupBy("id").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def nearest(targets: DataFrame, pool: DataFrame, minimum: int = 8, maximum: int = 20, scale=F.log1p, floor: float | None = 0.0) -> DataFrame:
    """id, level, rank and rid: the rows of pool (rid, lane, v) nearest to each target (id, lane, t) on a rising scale.

    Values of pool below the floor count as the floor; targets below it are left out.
    A target takes its lane's rows if these are `minimum` or more, else all; of n it takes max(minimum, min(n, maximum)).
    Ties take the least rid.  Rows are numbered once in each direction, and a target meets that many places before and
    behind its own, so what it reads is bounded.
    """
    k = max(minimum, maximum)
    pool, targets = pool.where("v IS NOT NULL"), targets.where("t IS NOT NULL")
    if floor is not None:
        pool, targets = pool.withColumn("v", F.greatest("v", F.lit(floor))), targets.where(F.col("t") >= floor)
    sizes = pool.where("lane IS NOT NULL").groupBy("lane").agg(F.count("*").alias("n")).where(F.col("n") >= minimum)
    every = pool.agg(F.count("*").alias("_n"))  # one row
    asked = targets.join(sizes, "lane", "left").join(every)
    asked = asked.select("id", "t", F.when(F.col("n").isNotNull(), F.col("lane")).alias("lane"), F.when(F.col("n").isNotNull(), "lane").otherwise("global").alias("level"), F.greatest(F.lit(minimum), F.least(F.coalesce("n", "_n"), F.lit(maximum))).alias("take"))
    both = pool.where("lane IS NOT NULL").unionByName(pool.withColumn("lane", F.lit(None).cast(dict(pool.dtypes)["lane"])))
    # of rows of the same value only the first k can be taken: a value that a third of the rows have is cut before it is numbered
    few = both.withColumn("_r", F.row_number().over(Window.partitionBy("lane", "v").orderBy("rid"))).where(F.col("_r") <= k).drop("_r")
    found = None
    for upward in (True, False):
        q = asked.select("lane", F.col("t").alias("v"), F.lit(None).cast(dict(pool.dtypes)["rid"]).alias("rid"), "id", "level", "take", F.lit(0 if upward else 1).alias("_q"))  # equal values lie ahead of a target going up, and behind it going down
        p = few.select("lane", "v", "rid", *(F.lit(None).cast(dict(asked.dtypes)[c]).alias(c) for c in ("id", "level", "take")), F.lit(1 if upward else 0).alias("_q"))
        ranged = with_range(p.unionByName(q), "v")
        order = [F.col("v").asc() if upward else F.col("v").desc(), F.col("_q"), F.col("rid")]
        # numbers over ranges, then within a range
        totals = ranged.groupBy("lane", "_p").agg(F.count("rid").alias("_t"))
        over = Window.partitionBy("lane").orderBy(F.col("_p").asc() if upward else F.col("_p").desc())
        totals = totals.select(F.col("lane").alias("_lane"), F.col("_p").alias("_at"), (F.sum("_t").over(over) - F.col("_t")).alias("_first"))
        numbered = ranged.withColumn("_k", F.count("rid").over(Window.partitionBy("lane", "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
        numbered = numbered.join(totals, F.col("lane").eqNullSafe(F.col("_lane")) & (F.col("_p") == F.col("_at"))).withColumn("_k", F.col("_k") + F.col("_first"))
        places = numbered.where("rid IS NOT NULL").select(F.col("lane").alias("_lane"), F.col("_k").alias("_place"), F.col("v"), "rid")
        wanted = numbered.where("id IS NOT NULL").select("id", "level", "take", "lane", F.col("v").alias("t"), F.explode(F.sequence(F.col("_k") + 1, F.col("_k") + F.col("take"))).alias("_want"))
        met = wanted.join(places, F.col("lane").eqNullSafe(F.col("_lane")) & (F.col("_want") == F.col("_place"))).select("id", "level", "take", "t", "v", "rid")
        found = met if found is None else found.unionByName(met)
    far = F.abs(scale(F.col("v")) - scale(F.col("t")))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(far, "rid"))  # twice `take` rows at most
    return found.select("id", "level", "take", "rid", rank.alias("rank")).where("rank <= take").drop("take")
