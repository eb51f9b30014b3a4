"""Events replayed as updates in runs that go on where the last one ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans.catalog import query
from tallyforge.sources.scratch import scratch
from tallyforge.sources.tables import tables
from tallyforge.streaming.updates import Updates


def events_as_updates(t: tables) -> DataFrame:
    """An event updates its user; what is worth little was stamped two days before."""
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000)
    return t.events.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"), (hour - F.when(F.col("value") < 12, 48).otherwise(0)).cast("long").alias("stamp"), F.col("event_type").alias("payload"))


@query("replayed_updates", """
WITH u AS (SELECT CAST(user_id AS VARCHAR) AS key, event_id seq, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) - CASE WHEN value < 12 THEN 48 ELSE 0 END AS stamp, event_type payload FROM events),
 w AS (SELECT *, max(stamp) OVER (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) m, first_value(payload) OVER (PARTITION BY key, stamp ORDER BY seq) f FROM u)
SELECT key, seq, stamp, CASE WHEN m IS NULL OR stamp > m THEN 'applied' WHEN stamp < m THEN 'late' WHEN payload = f THEN 'duplicate' ELSE 'conflict' END outcome FROM w""")
def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events come in two portions, each judged by a run of its own."""
    rows = events_as_updates(tables(spark, sf_dir))
    half = rows.agg(F.avg("seq")).first()[0] or 0
    updates = Updates(spark, scratch(spark))
    for part in (F.col("seq") <= half, F.col("seq") > half):
        updates.put(rows.where(part))
        updates.run(rows.schema)
    return updates.outcomes().select("key", "seq", "stamp", "outcome")
