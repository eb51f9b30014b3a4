"""Registered queries and their SQL twins; each plan module adds its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import reach

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with its SQL twin if it has one."""

    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(reach(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
