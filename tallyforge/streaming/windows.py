"""Event counts over a stream: watermarked windows, late rows dropped, state bounded by the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per window and kind, for a stream or a table; append mode gives each window once, when it is closed."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    return timed.withWatermark(at, late).groupBy(F.window(at, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def latest_per_key(events: DataFrame, key: str, at: str = "ts", late: str = "2 hours") -> DataFrame:
    """Rows of a stream with repeats within the watermark dropped."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([key])
