"""Sessions whose Python workers can import this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def reach(spark: SparkSession) -> SparkSession:
    """Adds the folder that holds this package to the workers' path.  A cluster gets the package with --py-files instead."""
    own, env = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    if own not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (own, env.get("PYTHONPATH", "")) if x)
    return spark
