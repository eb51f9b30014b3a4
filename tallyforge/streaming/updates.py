"""A stream of updates, resumable: each key's state outlives a run, and rows that come late or conflict go to a side table.

An update names a key, a stamp and a payload.  The first update of a key and every one with a later stamp is applied; the
same stamp and payload again is a duplicate, the same stamp with another payload a conflict, an earlier stamp is late.
State is a stamp and a payload for each key, kept by Structured Streaming with its checkpoint: a run that ends, or is
killed, goes on where the last committed batch ended, and the output holds each update once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "key string, seq long, stamp long, payload string, outcome string"
STATE = "stamp long, payload string"
APPLIED, DUPLICATE, CONFLICT, LATE = "applied", "duplicate", "conflict", "late"


def _judged(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The key's updates of one batch, by seq.  A batch's rows of one key are put in order; a key has few in a batch."""
    last, payload = state.get if state.exists else (None, None)
    rows = pd.concat(list(parts)).sort_values("seq", kind="stable")
    outcomes = []
    for stamp, said in zip(rows["stamp"].tolist(), rows["payload"].tolist(), strict=True):
        if last is None or stamp > last:
            last, payload = stamp, said
            outcomes.append(APPLIED)
        else:
            outcomes.append(LATE if stamp < last else DUPLICATE if said == payload else CONFLICT)
    state.update((last, payload))
    yield rows.assign(key=key[0], outcome=outcomes)[["key", "seq", "stamp", "payload", "outcome"]]


def judged(updates: DataFrame) -> DataFrame:
    """updates (a stream of key, seq, stamp, payload) with their outcome."""
    rows = updates.select(F.col("key").cast("string").alias("key"), F.col("seq").cast("long").alias("seq"), F.col("stamp").cast("long").alias("stamp"), F.coalesce("payload", F.lit("")).alias("payload")).where("key IS NOT NULL AND stamp IS NOT NULL")
    return rows.groupBy("key").applyInPandasWithState(_judged, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


class Updates:
    """A folder with an inbox, which updates are written to, and an outbox, which holds each with its outcome."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def put(self, updates: DataFrame) -> None:
        """More updates, not judged yet."""
        updates.write.mode("append").parquet(f"{self.folder}/inbox")

    def run(self, schema) -> None:
        """Judges what is new in the inbox, then ends.  A state's partitions stay as the first run had them."""
        stream = self.spark.readStream.schema(schema).parquet(f"{self.folder}/inbox")
        out = judged(stream).writeStream.format("parquet").option("path", f"{self.folder}/outbox").option("checkpointLocation", f"{self.folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
        out.awaitTermination()

    def outcomes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/outbox")

    def quarantine(self) -> DataFrame:
        return self.outcomes().where(F.col("outcome").isin(CONFLICT, LATE))
