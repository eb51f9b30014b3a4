"""Ordered rules: one CASE for the first match, one array for all, one pass for a funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rules = list[tuple[str, Column]]


def sure(c: Column) -> Column:
    """A condition that isn't known doesn't hold."""
    return F.coalesce(c, F.lit(False))


def first_match(rules: Rules, default: str | None = None) -> Column:
    out = F.lit(default)
    for name, when in reversed(rules):
        out = F.when(sure(when), F.lit(name)).otherwise(out)
    return out


def all_matches(rules: Rules) -> Column:
    """Names of all rules that hold, in the rules' order."""
    return F.array_compact(F.array(*(F.when(sure(w), F.lit(n)) for n, w in rules)))


def pick_by_priority(reasons: Column, priority: tuple[str, ...]) -> Column:
    """The first of the priorities that is there, else the first reason."""
    listed = [F.when(F.array_contains(reasons, p), F.lit(p)) for p in priority]
    return F.coalesce(*listed, F.get(reasons, F.lit(0)))


def funnel(df: DataFrame, rules: Rules) -> DataFrame:
    """Per rule, in order: rows that fail there first, and rows that remain behind it.  One aggregate, then a window over the rules."""
    failed = first_match(rules)
    order = F.create_map(*(x for k, (n, _) in enumerate(rules) for x in (F.lit(n), F.lit(k))))
    counts = df.groupBy(failed.alias("reason")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    seen = F.sum(F.when(F.col("reason").isNotNull(), F.col("n")).otherwise(0)).over(Window.partitionBy().orderBy(F.coalesce(F.element_at(order, F.coalesce("reason", F.lit(""))), F.lit(len(rules)))))
    return counts.select("reason", F.col("n").alias("excluded"), (total - seen).alias("remaining")).where("reason is not null")


def required_columns(df: DataFrame, required: set[str], prohibited: set[str]) -> dict[str, list[str]]:
    """What a table's columns lack, have beyond, or must not have."""
    own = set(df.columns)
    return {"missing": sorted(required - own), "unexpected": sorted(own - required), "prohibited": sorted(own & prohibited)}
