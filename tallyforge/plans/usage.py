"""Account features: usage, histories, priors, cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions import numbers as N
from tallyforge.operators import aggregates as A
from tallyforge.operators import joins as J
from tallyforge.operators import neighbours as B
from tallyforge.operators import rules as R
from tallyforge.plans.catalog import query
from tallyforge.sources.tables import tables

AS_OF = "timestamp'1998-08-01'"


@query("usage_features_by_account", """
WITH o AS (
  SELECT o_custkey k, count(*) n_orders, count(*) FILTER (WHERE o_orderdate >= timestamp '1998-08-01' - interval 180 day AND o_orderdate < timestamp '1998-08-01') orders_180d,
    count(DISTINCT date_trunc('month', o_orderdate)) active_months, bool_or(o_orderstatus = 'P') has_open, min(o_orderdate) first_order, max(o_orderdate) last_order,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) total_value, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F'), 0) AS DOUBLE) filled_value,
    max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') max_filled, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) priorities
  FROM orders GROUP BY 1),
l AS (SELECT o_custkey k, count(*) n_lines, count(DISTINCT l_partkey) n_parts, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
e AS (SELECT user_id k, count(*) n_events, count(*) FILTER (WHERE event_type = 'purchase') purchases, max(ts) last_event FROM events GROUP BY 1)
SELECT c_custkey, c_mktsegment segment, n_name state, coalesce(n_orders, 0) n_orders, coalesce(orders_180d, 0) orders_180d, coalesce(active_months, 0) active_months, coalesce(has_open, false) has_open,
  first_order, last_order, coalesce(total_value, 0) total_value, coalesce(filled_value, 0) filled_value, max_filled, coalesce(priorities, '') priorities, coalesce(n_lines, 0) n_lines, coalesce(n_parts, 0) n_parts,
  coalesce(quantity, 0) quantity, coalesce(n_events, 0) n_events, coalesce(purchases, 0) purchases, last_event
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN o ON o.k = c_custkey LEFT JOIN l ON l.k = c_custkey LEFT JOIN e ON e.k = c_custkey""")
def usage_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per account; every side is aggregated to its key before it is joined, so the joins keep the grain."""
    t = tables(spark, sf_dir)
    as_of = F.expr(AS_OF)
    done = F.col("o_orderstatus") == "F"
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.count_if((F.col("o_orderdate") >= as_of - F.expr("interval 180 days")) & (F.col("o_orderdate") < as_of)).alias("orders_180d"),
        F.size(F.collect_set(F.trunc("o_orderdate", "month"))).cast("long").alias("active_months"), F.bool_or(F.col("o_orderstatus") == "P").alias("has_open"),
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"), A.money_sum(F.col("o_totalprice")).alias("total_value"),
        A.money_sum(F.col("o_totalprice"), done).alias("filled_value"), F.max(F.when(done, F.col("o_totalprice"))).alias("max_filled"), A.text_list(F.col("o_orderpriority")).alias("priorities"),
    )
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    parts = lines.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_lines"), F.count_distinct("l_partkey").alias("n_parts"), A.money_sum(F.col("l_quantity")).alias("quantity"))
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.max("ts").alias("last_event"))
    base = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("state"))
    out = base.join(orders, "c_custkey", "left").join(parts, "c_custkey", "left").join(events, "c_custkey", "left")
    return out.na.fill(0, ["n_orders", "orders_180d", "active_months", "total_value", "filled_value", "n_lines", "n_parts", "quantity", "n_events", "purchases"]).na.fill(False, ["has_open"]).na.fill("", ["priorities"])


LEVELS, LEAST = [["c_mktsegment", "c_nationkey"], ["c_mktsegment"], ["c_nationkey"], []], [12, 12, 12, 1]


@query("account_cohort_defaults", """
SELECT 0 AS level, c_mktsegment, c_nationkey, count(*) n, quantile_cont(c_acctbal, 0.4) AS value FROM customer GROUP BY c_mktsegment, c_nationkey
UNION ALL SELECT 1, c_mktsegment, NULL, count(*), quantile_cont(c_acctbal, 0.4) FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 2, NULL, c_nationkey, count(*), quantile_cont(c_acctbal, 0.4) FROM customer GROUP BY c_nationkey
UNION ALL SELECT 3, NULL, NULL, count(*), quantile_cont(c_acctbal, 0.4) FROM customer""")
def cohort_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.cohort_stats(tables(spark, sf_dir).customer, LEVELS, "c_acctbal", 0.4)


@query("cohort_fallback_assign", """
WITH a AS (SELECT c_mktsegment s, c_nationkey k, count(*) n, quantile_cont(c_acctbal, 0.4) v FROM customer GROUP BY ALL HAVING count(*) >= 12),
b AS (SELECT c_mktsegment s, count(*) n, quantile_cont(c_acctbal, 0.4) v FROM customer GROUP BY ALL HAVING count(*) >= 12),
c AS (SELECT c_nationkey k, count(*) n, quantile_cont(c_acctbal, 0.4) v FROM customer GROUP BY ALL HAVING count(*) >= 12), d AS (SELECT count(*) n, quantile_cont(c_acctbal, 0.4) v FROM customer)
SELECT c_custkey, CASE WHEN a.v IS NOT NULL THEN 0 WHEN b.v IS NOT NULL THEN 1 WHEN c.v IS NOT NULL THEN 2 ELSE 3 END cohort_level, coalesce(a.v, b.v, c.v, d.v) cohort_value, coalesce(a.n, b.n, c.n, d.n) cohort_n
FROM customer x LEFT JOIN a ON a.s = x.c_mktsegment AND a.k = x.c_nationkey LEFT JOIN b ON b.s = x.c_mktsegment LEFT JOIN c ON c.k = x.c_nationkey CROSS JOIN d""")
def cohort_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).customer
    stats = J.cohort_stats(c, LEVELS, "c_acctbal", 0.4)
    return J.cohort_fallback(c, stats, LEVELS, LEAST).select("c_custkey", "cohort_level", "cohort_value", "cohort_n")


@query("sparse_group_median", """
WITH g AS (SELECT c_mktsegment s, c_nationkey k, count(*) n, median(c_acctbal) m FROM customer GROUP BY ALL), s AS (SELECT c_mktsegment s, median(c_acctbal) m FROM customer GROUP BY ALL)
SELECT g.s c_mktsegment, g.k c_nationkey, g.n, CASE WHEN g.n >= 10 THEN g.m ELSE s.m END median_value FROM g JOIN s USING (s)""")
def sparse_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).customer
    middle = lambda keys, name: A.exact_quantiles(c, keys, F.col("c_acctbal"), [0.5]).select(*keys, "n", F.get("quantiles", F.lit(0)).alias(name))
    lane = middle(["c_mktsegment"], "lane").drop("n")
    return middle(["c_mktsegment", "c_nationkey"], "m").join(lane, "c_mktsegment").select("c_mktsegment", "c_nationkey", "n", F.when(F.col("n") >= 10, F.col("m")).otherwise(F.col("lane")).alias("median_value"))


@query("winsorized_quantiles", """
WITH q AS (SELECT c_mktsegment s, quantile_cont(c_acctbal, 0.01) lo, quantile_cont(c_acctbal, 0.99) hi FROM customer GROUP BY 1)
SELECT c_mktsegment, count(*) n, count(*) FILTER (WHERE c_acctbal < lo) clipped_low, count(*) FILTER (WHERE c_acctbal > hi) clipped_high,
  quantile_cont(least(greatest(c_acctbal, lo), hi), 0.5) p50, quantile_cont(least(greatest(c_acctbal, lo), hi), 0.75) p75, quantile_cont(least(greatest(c_acctbal, lo), hi), 0.9) p90 FROM customer JOIN q ON s = c_mktsegment GROUP BY 1""")
def winsorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).customer
    ends = A.exact_quantiles(c, ["c_mktsegment"], F.col("c_acctbal"), [0.01, 0.99]).select("c_mktsegment", F.get("quantiles", F.lit(0)).alias("lo"), F.get("quantiles", F.lit(1)).alias("hi"))
    both = c.join(ends, "c_mktsegment")
    clipped = A.exact_quantiles(both, ["c_mktsegment"], F.least(F.greatest("c_acctbal", "lo"), F.col("hi")), [0.5, 0.75, 0.9]).drop("n")
    counts = both.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") < F.col("lo")).alias("clipped_low"), F.count_if(F.col("c_acctbal") > F.col("hi")).alias("clipped_high"))
    return counts.join(clipped, "c_mktsegment").select("c_mktsegment", "n", "clipped_low", "clipped_high", *(F.get("quantiles", F.lit(k)).alias(n) for k, n in enumerate(("p50", "p75", "p90"))))


@query("band_ladder_lookup", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 250000 THEN 250000 + floor((o_totalprice - 250000) / 50000) * 50000 WHEN o_totalprice >= 150000 THEN 150000 WHEN o_totalprice >= 75000 THEN 75000 WHEN o_totalprice >= 25000 THEN 25000 WHEN o_totalprice >= 0 THEN 0.0 END::DOUBLE band_low,
  CASE WHEN o_totalprice >= 0 AND o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 50000 AND o_totalprice < 200000 THEN 1 ELSE 2 END bucket FROM orders""")
def band_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).orders.select("o_orderkey", N.band("o_totalprice", (0, 25000, 75000, 150000, 250000), 250000.0, 50000).alias("band_low"), N.bucket("o_totalprice", (0, 50000, 200000, 1e12)).alias("bucket"))


@query("numeric_bucket_counts", "SELECT CASE WHEN o_totalprice >= 0 AND o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 50000 AND o_totalprice < 200000 THEN 1 ELSE 2 END bucket, o_orderstatus, count(*) n FROM orders GROUP BY ALL")
def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).orders.groupBy(N.bucket("o_totalprice", (0, 50000, 200000, 1e12)).alias("bucket"), "o_orderstatus").agg(F.count("*").alias("n"))


@query("tiered_source_assignment", """
WITH w AS (SELECT o_custkey k, max(o_totalprice) won, max(o_orderdate) won_at FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), e AS (SELECT user_id k, count(*) n FROM events GROUP BY 1), d AS (SELECT c_mktsegment s, quantile_cont(c_acctbal, 0.25) v FROM customer GROUP BY 1)
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'excluded' WHEN won IS NOT NULL AND won_at >= timestamp '1996-01-01' THEN 'anchor' WHEN coalesce(n, 0) >= 5 THEN 'website' ELSE 'cohort_default' END tier,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN won IS NOT NULL AND won_at >= timestamp '1996-01-01' THEN least(won, 200000) WHEN coalesce(n, 0) >= 5 THEN c_acctbal ELSE d.v END AS value
FROM customer LEFT JOIN w ON w.k = c_custkey LEFT JOIN e ON e.k = c_custkey JOIN d ON d.s = c_mktsegment""")
def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first tier that applies: exclusion, a recent anchor (capped), evidence, the cohort's default."""
    t = tables(spark, sf_dir)
    won = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("won"), F.max("o_orderdate").alias("at"))
    seen = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("seen"))
    default = A.exact_quantiles(t.customer, ["c_mktsegment"], F.col("c_acctbal"), [0.25]).select("c_mktsegment", F.get("quantiles", F.lit(0)).alias("v"))
    tier = R.first_match([("excluded", F.col("c_acctbal") < 0), ("anchor", F.col("at") >= F.expr("timestamp'1996-01-01'")), ("website", F.col("seen") >= 5)], "cohort_default")
    out = t.customer.join(won, "c_custkey", "left").join(seen, "c_custkey", "left").join(default, "c_mktsegment").withColumn("tier", tier)
    value = F.when(F.col("tier") == "anchor", F.least("won", F.lit(200000.0))).when(F.col("tier") == "website", F.col("c_acctbal")).when(F.col("tier") == "cohort_default", F.col("v"))
    return out.select("c_custkey", "tier", value.alias("value"))


@query("latest_opportunity_per_account", """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    return J.latest(o, "o_custkey", "o_orderdate", "o_orderkey", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 0)).drop("o_orderstatus")


@query("recent_event_lookup", """
SELECT c_custkey, event_id, event_type, value FROM customer LEFT JOIN (SELECT * FROM events WHERE event_type IN ('purchase', 'signup') AND ts >= timestamp '2024-01-10' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) ON user_id = c_custkey""")
def recent_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    found = J.latest(t.events.select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "ts", "event_id", F.col("event_type").isin("purchase", "signup") & (F.col("ts") >= F.expr("timestamp'2024-01-10'")))
    return t.customer.select("c_custkey").join(found, F.col("c_custkey") == F.col("user_id"), "left").select("c_custkey", "event_id", "event_type", "value")


@query("point_in_time_prior", """
SELECT o_orderkey, lag(o_totalprice) OVER w AS prior, CASE WHEN lag(o_orderdate) OVER w IS NOT NULL AND o_orderdate > lag(o_orderdate) OVER w THEN true ELSE false END usable,
  CASE WHEN o_orderdate > lag(o_orderdate) OVER w THEN round(pow(2, -(epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER w)) / 86400000000.0 / 365), 9) END weight
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate", F.lag("o_totalprice").over(w).alias("prior"), F.lag("o_orderdate").over(w).alias("seen"))
    usable = J.usable_prior(F.col("prior"), F.col("seen"), F.col("o_orderdate"))
    return o.select("o_orderkey", "prior", usable.alias("usable"), F.when(usable, F.round(N.recency(N.age_days(F.col("seen"), F.col("o_orderdate"))), 9)).alias("weight"))


@query("recency_weighted_prior", """
SELECT o_custkey, count(*) n, round(sum(o_totalprice * pow(2, -(epoch_us(timestamp '2002-01-01') - epoch_us(o_orderdate)) / 86400000000.0 / 365)) / sum(pow(2, -(epoch_us(timestamp '2002-01-01') - epoch_us(o_orderdate)) / 86400000000.0 / 365)), 3) prior FROM orders GROUP BY 1""")
def recency_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = N.recency(N.age_days(F.col("o_orderdate"), F.expr("timestamp'2002-01-01'")))
    return tables(spark, sf_dir).orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum(F.col("o_totalprice") * w) / F.sum(w), 3).alias("prior"))


@query("ratio_range_comparables", """
SELECT a.c_custkey, count(*) n_comparables, min(b.c_custkey) first_comparable FROM customer a JOIN customer b ON a.c_mktsegment = b.c_mktsegment AND a.c_nationkey = b.c_nationkey AND a.c_acctbal > 0 AND b.c_acctbal > 0 AND b.c_acctbal >= 0.5 * a.c_acctbal AND b.c_acctbal <= 2 * a.c_acctbal GROUP BY 1""")
def ratio_comparables(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).customer.where("c_acctbal > 0")
    keys = ["c_mktsegment", "c_nationkey"]
    asked = c.select(F.col("c_custkey").alias("id"), *keys, (F.col("c_acctbal") * 0.5).alias("low"), (F.col("c_acctbal") * 2).alias("high"))
    pool = c.select(F.col("c_custkey").alias("rid"), *keys, F.col("c_acctbal").alias("v"))
    return B.over_range(asked, pool, keys, "low", "high").select(F.col("id").alias("c_custkey"), F.col("n").alias("n_comparables"), F.col("least").alias("first_comparable"))


@query("nearest_comparables_topk", """
SELECT a.s_suppkey, b.c_custkey, row_number() OVER w AS rank FROM supplier a JOIN customer b ON a.s_nationkey = b.c_nationkey WINDOW w AS (PARTITION BY a.s_suppkey ORDER BY abs(b.c_acctbal - a.s_acctbal), b.c_custkey) QUALIFY rank <= 3""")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    asked = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("lane"), F.col("s_acctbal").alias("t"))
    pool = t.customer.select(F.col("c_custkey").alias("rid"), F.col("c_nationkey").alias("lane"), F.col("c_acctbal").alias("v"))
    found = B.nearest(asked, pool, minimum=1, maximum=3, scale=lambda c: c, floor=None)
    return found.where("level = 'lane'").select(F.col("id").alias("s_suppkey"), F.col("rid").alias("c_custkey"), "rank")


@query("nearest_with_fallback", """
WITH p AS (SELECT c_custkey, c_nationkey, c_acctbal v FROM customer WHERE c_acctbal > 8500), n AS (SELECT c_nationkey k, count(*) n FROM p GROUP BY 1),
 a AS (SELECT s_suppkey, s_nationkey, s_acctbal t, coalesce(n, 0) n FROM supplier LEFT JOIN n ON k = s_nationkey WHERE s_acctbal >= 0),
 r AS (SELECT s_suppkey, n, c_custkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(ln(1 + v) - ln(1 + t)), c_custkey) AS rank, count(*) OVER (PARTITION BY s_suppkey) pool FROM a JOIN p ON n < 8 OR c_nationkey = s_nationkey)
SELECT s_suppkey, c_custkey, rank, CASE WHEN n >= 8 THEN 'lane' ELSE 'global' END AS level FROM r WHERE rank <= greatest(8, least(pool, 20))""")
def nearest_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparable customers of each supplier: of its nation if it has eight of a high balance, else of all."""
    t = tables(spark, sf_dir)
    asked = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("lane"), F.col("s_acctbal").alias("t"))
    pool = t.customer.where("c_acctbal > 8500").select(F.col("c_custkey").alias("rid"), F.col("c_nationkey").alias("lane"), F.col("c_acctbal").alias("v"))
    return B.nearest(asked, pool).select(F.col("id").alias("s_suppkey"), F.col("rid").alias("c_custkey"), "rank", "level")


@query("arr_comparable_estimate", """
WITH g AS (SELECT quantile_cont(c_acctbal, 0.5) p FROM customer), s AS (SELECT c_mktsegment s, c_nationkey k, count(*) n, quantile_cont(c_acctbal, 0.5) v FROM customer GROUP BY ALL)
SELECT s c_mktsegment, k c_nationkey, n, round((n / (n + 8.0)) * v + (1 - n / (n + 8.0)) * p, 6) estimate, n < 8 provisional FROM s CROSS JOIN g""")
def comparable_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).customer
    middle = lambda keys, name: A.exact_quantiles(c, keys, F.col("c_acctbal"), [0.5]).select(*keys, *(["n"] if keys else []), F.get("quantiles", F.lit(0)).alias(name))
    local = middle(["c_mktsegment", "c_nationkey"], "v")
    return local.join(middle([], "p")).select("c_mktsegment", "c_nationkey", "n", F.round(N.shrunk(F.col("v"), F.col("p"), F.col("n")), 6).alias("estimate"), (F.col("n") < 8).alias("provisional"))


@query("group_time_split", """
WITH g AS (SELECT o_custkey k, min(o_orderdate) lo, max(o_orderdate) hi FROM orders GROUP BY 1)
SELECT k o_custkey, CASE WHEN hi < timestamp '1998-01-01' THEN 'train' WHEN lo >= timestamp '1998-01-01' THEN 'holdout' ELSE 'purged' END split FROM g""")
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group is trained on or held out as a whole; groups on both sides of the cutoff are purged."""
    cut = F.expr("timestamp'1998-01-01'")
    g = tables(spark, sf_dir).orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return g.select("o_custkey", R.first_match([("train", F.col("hi") < cut), ("holdout", F.col("lo") >= cut)], "purged").alias("split"))
