"""Deterministic samples: by hash order, in turns over strata, by shard; a canary that keeps every value of its dimensions."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_print(key: str, run: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{run}:"), F.col(key).cast("string")).cast("binary"), 256)


def hash_order(df: DataFrame, key: str, run: str, n: int) -> DataFrame:
    """The n rows of the least hash; each task keeps n, none sorts the table."""
    return df.withColumn("print", hash_print(key, run)).orderBy("print", key).limit(n)


def round_robin(df: DataFrame, key: str, strata: list[str], run: str, n: int) -> DataFrame:
    """First one of each stratum, then the second, until n; within a stratum by hash."""
    turn = F.row_number().over(Window.partitionBy(*strata).orderBy(hash_print(key, run), key))
    # no stratum gives more than n rows, which a window group limit keeps before the shuffle
    return df.withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", *strata).limit(n)


def shard(key: str, n: int) -> Column:
    return F.pmod(F.col(key), F.lit(n))


def reduced(strata: dict[tuple, int], size: int) -> set[tuple]:
    """Strata to keep, `size` at most: the smallest go first, but none that alone has one of its dimensions' values."""
    kept = set(strata)
    left = [Counter(key[k] for key in kept) for k in range(len(next(iter(kept), ())))]
    for key in sorted(strata, key=lambda s: (strata[s], s)):
        if len(kept) <= size:
            break
        if all(left[k][v] > 1 for k, v in enumerate(key)):
            kept.discard(key)
            for k, v in enumerate(key):
                left[k][v] -= 1
    if len(kept) > size:
        raise ValueError(f"{len(strata)} strata can't be brought to {size} without losing a value of a dimension")
    return kept


def canary(df: DataFrame, key: str, dimensions: list[str], top: list[Column], first: int = 20, rest: int = 30, seed: str = "run") -> DataFrame:
    """key and why (top, or stratum): the first rows of the whole order, then rows of the strata in turn, by a hash of the key.

    Strata are a histogram on the driver, no larger than the product of the dimensions' values; if they are more than
    `rest`, the smallest go as long as every value of every dimension stays.  Rows meet their stratum's turn by a join.
    """
    head = df.orderBy(*top, key).limit(first).select(key, F.lit("top").alias("why"))
    others = df.join(head, key, "left_anti").select(key, *(F.coalesce(F.col(d).cast("string"), F.lit("")).alias(d) for d in dimensions))
    counts = {tuple(r[d] for d in dimensions): r["n"] for r in others.groupBy(*dimensions).agg(F.count("*").alias("n")).collect()}
    # a stratum's turns: one row of each in the order of its name, again and again until all are dealt
    keys = sorted(reduced(counts, rest)) if counts else []
    turns: Counter = Counter()
    while sum(turns.values()) < rest and (open_ := [k for k in keys if turns[k] < counts[k]]):
        turns.update(open_[: rest - sum(turns.values())])
    schema = ", ".join(f"{d} string" for d in dimensions) + ", _take int"
    plan = df.sparkSession.createDataFrame([(*k, n) for k, n in turns.items()], schema)
    place = F.row_number().over(Window.partitionBy(*dimensions).orderBy(hash_print(key, seed), key))
    # no stratum gives more than `rest` rows: a limit that Spark applies before the shuffle
    drawn = others.withColumn("_r", place).where(F.col("_r") <= rest).join(F.broadcast(plan), dimensions).where("_r <= _take")
    return head.unionByName(drawn.select(key, F.lit("stratum").alias("why")))
