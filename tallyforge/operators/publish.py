"""Publishing a desired state: staged rows, conflicts, a canary, the rest, and a ledger, as tables; nothing is sent anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.rules import first_match


def staged(desired: DataFrame, live: DataFrame, key: str, columns: list[str], stamp: str, canary: float = 0.05, seed: int = 42) -> DataFrame:
    """Each desired row with its lot: `conflict` (unknown, or changed since it was read), `unchanged`, `canary` or `remaining`.

    The canary is a stable share by a hash of the key.  A blank desired value never clears a live one.
    """
    now = live.select(key, F.col(stamp).alias("_stamp"), *(F.col(c).alias(f"_live_{c}") for c in columns))
    both = desired.join(now, key, "left")
    kept = {c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.col(f"_live_{c}").cast("string"), F.lit("")) for c in columns}
    both = both.withColumns(kept)
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.coalesce(F.col(f"_live_{c}").cast("string"), F.lit("")))
    first = F.pmod(F.crc32(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), F.lit(10_000)) < int(canary * 10_000)
    lot = first_match([("conflict", F.col("_stamp").isNull() | ~F.col("_stamp").eqNullSafe(F.col(stamp))), ("unchanged", same), ("canary", first)], "remaining")
    return both.withColumn("lot", lot).drop("_stamp", *(f"_live_{c}" for c in columns))


def ledger(sent: DataFrame, read_back: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per sent row: success, and the error class of what was read back (missing, or the first column that differs)."""
    seen = read_back.select(key, F.lit(True).alias("_there"), *(F.col(c).cast("string").alias(f"_seen_{c}") for c in columns))
    wrong = [(f"mismatch:{c}", ~F.col(c).cast("string").eqNullSafe(F.col(f"_seen_{c}"))) for c in columns]
    out = sent.join(seen, key, "left").withColumn("error", first_match([("missing", F.col("_there").isNull()), *wrong], ""))
    return out.select(key, (F.col("error") == "").alias("success"), "error")


def reconciled(lots: DataFrame) -> DataFrame:
    """Rows of each lot, and of all."""
    return lots.groupBy("lot").agg(F.count("*").alias("rows")).unionAll(lots.agg(F.lit("all").alias("lot"), F.count("*").alias("rows")))
