"""The account that a shared domain's accounts agree on: by parents and suggested survivors, then by evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A vote of hierarchy, scores of evidence, and what the best score needs and must lead by.
VOTE, MEMBER, BOUND, NAMED, PLACED, ENOUGH, LEAD = 2, 10, 10, 10, 20, 30, 20


def _top(scores: DataFrame) -> DataFrame:
    """domain, best, score and second of (domain, candidate, score), with partial sums only."""
    ranked = scores.groupBy("domain").agg(F.max(F.struct("score", "candidate")).alias("_t"))
    rest = scores.join(ranked, "domain").where("candidate <> _t.candidate").groupBy("domain").agg(F.max("score").alias("second"))
    return ranked.join(rest, "domain", "left").select("domain", F.col("_t.candidate").alias("best"), F.col("_t.score").alias("score"), F.coalesce("second", F.lit(0)).alias("second"))


def shared_survivors(rows: DataFrame) -> DataFrame:
    """domain, survivor and how for each domain of rows (domain, id, parent, suggested, confidence, member, bound, named, placed).

    A parent, and a suggested survivor of medium or high confidence, gets VOTE from each account below it if it has the
    domain too; a unique maximum wins.  Without one, evidence must be strong and decisively unique.
    """
    ids = rows.select("domain", F.col("id").alias("candidate"))
    sure = F.lower(F.trim(F.coalesce("confidence", F.lit("")))).isin("medium", "high")
    asked = rows.select("domain", F.col("parent").alias("candidate")).unionAll(rows.where(sure & (F.col("suggested") != F.col("id"))).select("domain", F.col("suggested").alias("candidate"))).where("candidate <> ''")
    votes = asked.groupBy("domain", "candidate").agg((F.count("*") * VOTE).alias("score")).join(ids.distinct(), ["domain", "candidate"], "left_semi")
    by_votes = _top(votes).where("score > second").select("domain", F.col("best").alias("_voted"))
    points: Column = sum((F.when(F.col(c), n).otherwise(0) for c, n in (("member", MEMBER), ("bound", BOUND), ("named", NAMED), ("placed", PLACED))), F.lit(0))
    scored = rows.select("domain", F.col("id").alias("candidate"), points.cast("long").alias("score")).where("score > 0")
    by_evidence = _top(scored).where((F.col("score") >= ENOUGH) & (F.col("score") - F.col("second") >= LEAD)).select("domain", F.col("best").alias("_scored"))
    out = rows.select("domain").distinct().join(by_votes, "domain", "left").join(by_evidence, "domain", "left")
    how = F.when(F.col("_voted").isNotNull(), "resolved_parent_child_or_suggested_survivor").when(F.col("_scored").isNotNull(), "resolved_unique_entity_location_identity").otherwise("unresolved_shared_domain")
    return out.select("domain", F.coalesce("_voted", "_scored", F.lit("")).alias("survivor"), how.alias("how"))
