"""Release steps: desired state, changes, staging, read-back, rollback, multi-source overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import joins as J
from tallyforge.operators import rules as R
from tallyforge.plans.catalog import query
from tallyforge.sources.tables import tables

_NEW = "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN '0-NEW' ELSE o_orderpriority END o_orderpriority, o_orderkey % 97 stamp FROM orders WHERE o_orderkey % 11 <> 0"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and orders as a later desired state: some rows gone, some cells changed."""
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_orderkey") % 97).alias("stamp"))
    k = F.col("o_orderkey")
    new = o.where(k % 11 != 0).withColumns({"o_orderstatus": F.when(k % 10 == 0, "X").otherwise(F.col("o_orderstatus")), "o_orderpriority": F.when(k % 7 == 0, "0-NEW").otherwise(F.col("o_orderpriority"))})
    return o, new


@query("changed_only_diff", f"SELECT o.o_orderkey FROM orders o JOIN ({_NEW}) n USING (o_orderkey) WHERE o.o_orderstatus <> n.o_orderstatus OR o.o_orderpriority <> n.o_orderpriority")
def changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    return J.changed_cells(old, new, "o_orderkey", ["o_orderstatus", "o_orderpriority"]).select("o_orderkey").distinct()


@query("source_conflicts_unpivot", f"""
SELECT o_orderkey, 'o_orderstatus' AS column, o.o_orderstatus old_value, n.o_orderstatus new_value FROM orders o JOIN ({_NEW}) n USING (o_orderkey) WHERE o.o_orderstatus <> n.o_orderstatus
UNION ALL SELECT o_orderkey, 'o_orderpriority', o.o_orderpriority, n.o_orderpriority FROM orders o JOIN ({_NEW}) n USING (o_orderkey) WHERE o.o_orderpriority <> n.o_orderpriority""")
def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    return J.changed_cells(old, new, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("readback_verify", f"""
SELECT CASE WHEN n.o_orderkey IS NULL THEN 'missing' WHEN o.o_orderkey IS NULL THEN 'unexpected' WHEN o.o_orderstatus <> n.o_orderstatus OR o.o_orderpriority <> n.o_orderpriority THEN 'mismatch' ELSE 'ok' END outcome, count(*) n FROM orders o FULL JOIN ({_NEW}) n ON o.o_orderkey = n.o_orderkey GROUP BY 1""")
def readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    o, n = old.alias("o"), new.alias("n")
    differs = (F.col("o.o_orderstatus") != F.col("n.o_orderstatus")) | (F.col("o.o_orderpriority") != F.col("n.o_orderpriority"))
    outcome = R.first_match([("missing", F.col("n.o_orderkey").isNull()), ("unexpected", F.col("o.o_orderkey").isNull()), ("mismatch", differs)], "ok")
    return o.join(n, F.col("o.o_orderkey") == F.col("n.o_orderkey"), "full").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query("rollback_cas", f"SELECT n.o_orderkey, n.stamp = o.o_orderkey % 89 current, CASE WHEN n.stamp = o.o_orderkey % 89 THEN 'rollback' ELSE 'stale' END action FROM orders o JOIN ({_NEW}) n USING (o_orderkey)")
def rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row is rolled back only if its stamp is still the one that was written."""
    old, new = _sides(spark, sf_dir)
    both = new.join(old.select("o_orderkey", (F.col("o_orderkey") % 89).alias("seen")), "o_orderkey")
    same = F.col("stamp") == F.col("seen")
    return both.select("o_orderkey", same.alias("current"), F.when(same, "rollback").otherwise("stale").alias("action"))


@query("snapshot_reconcile", f"SELECT (SELECT count(*) FROM orders) rows_a, (SELECT count(*) FROM ({_NEW})) rows_b, count(*) FILTER (WHERE n.o_orderkey IS NULL) only_a, count(*) FILTER (WHERE o.o_orderkey IS NULL) only_b FROM orders o FULL JOIN ({_NEW}) n ON o.o_orderkey = n.o_orderkey")
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    r = J.reconcile(old, new, "o_orderkey")
    return r.select((F.col("both") + F.col("only_a")).alias("rows_a"), (F.col("both") + F.col("only_b")).alias("rows_b"), "only_a", "only_b")


@query("override_merge", f"SELECT o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) status, n.o_orderkey IS NOT NULL overlaid FROM orders o LEFT JOIN ({_NEW}) n USING (o_orderkey)")
def override(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    n = new.select("o_orderkey", F.col("o_orderstatus").alias("s"))
    return old.join(n, "o_orderkey", "left").select("o_orderkey", F.coalesce("s", "o_orderstatus").alias("status"), F.col("s").isNotNull().alias("overlaid"))


@query("id_set_operations", f"SELECT 'missing' kind, o_orderkey FROM (SELECT o_orderkey FROM orders EXCEPT SELECT o_orderkey FROM ({_NEW})) UNION ALL SELECT 'common', o_orderkey FROM (SELECT o_orderkey FROM orders INTERSECT SELECT o_orderkey FROM ({_NEW}))")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (x.select("o_orderkey") for x in _sides(spark, sf_dir))
    return old.subtract(new).select(F.lit("missing").alias("kind"), "o_orderkey").unionAll(old.intersect(new).select(F.lit("common"), "o_orderkey"))


@query("anti_semi_membership", "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) has_orders FROM customer")
def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    keys = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    c = t.customer.select("c_custkey")
    return c.join(keys, "c_custkey", "left_semi").withColumn("has_orders", F.lit(True)).unionAll(c.join(keys, "c_custkey", "left_anti").withColumn("has_orders", F.lit(False)))
