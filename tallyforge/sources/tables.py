"""The driver's tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class tables:  # noqa: N801
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")
