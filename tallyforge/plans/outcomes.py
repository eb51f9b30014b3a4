"""Label joins, outcomes, rates, audits and rank tests over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.operators import joins as J
from tallyforge.operators import outcomes as O
from tallyforge.operators.estimators import QuantileBoost, SparseMedian
from tallyforge.plans.catalog import query
from tallyforge.sources.scratch import written
from tallyforge.sources.tables import tables


@query("case_insensitive_join", "SELECT n_nationkey, n_name, r_regionkey, upper(r_name) || ' ' AS region_name_loud FROM nation JOIN region ON r_regionkey = n_regionkey")
def case_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    loud = t.region.select("r_regionkey", F.concat(F.upper("r_name"), F.lit(" ")).alias("region_name"))
    named = t.nation.join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.lower("r_name").alias("region_name")), "n_regionkey")
    return O.same_key(named, loud, "region_name", "region_name", suffix="_loud").select("n_nationkey", "n_name", "r_regionkey", "region_name_loud")


@query("merge_with_suffixes", "SELECT c.c_custkey, c.c_acctbal, o.n c_acctbal_warehouse FROM customer c LEFT JOIN (SELECT o_custkey, CAST(max(o_totalprice) AS DOUBLE) n FROM orders GROUP BY 1) o ON o_custkey = c_custkey")
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    warehouse = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").cast("double").alias("c_acctbal"))
    return O.same_key(t.customer.select("c_custkey", "c_acctbal"), warehouse, "c_custkey", "c_custkey", "left", "_warehouse").select("c_custkey", "c_acctbal", "c_acctbal_warehouse")


@query("label_prediction_join", "SELECT d.doc_id, d.n_chars predicted, l.quality FROM (SELECT text, arg_max(doc_id, (n_chars, -doc_id)) doc_id, max(n_chars) n_chars FROM documents GROUP BY text) d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NOT NULL")
def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    best = O.best_duplicate(t.documents.select("text", "doc_id", "n_chars"), "text", "n_chars", "doc_id")
    return best.select("doc_id", F.col("n_chars").alias("predicted")).join(t.labels.where("quality IS NOT NULL").select("doc_id", "quality"), "doc_id")


@query("overlay_impact_join", """
WITH base AS (SELECT c_custkey id, c_mktsegment FROM customer), prior AS (SELECT o_custkey id, max(o_orderstatus) last FROM orders GROUP BY 1), r AS (SELECT DISTINCT o_custkey + 5 id FROM orders)
SELECT count(*) "rows", count(b.id) with_base, count(p.id) with_prior, count(*) - count(b.id) missing_base, count(*) - count(p.id) missing_prior, count(*) FILTER (WHERE b.c_mktsegment = 'BUILDING' AND p.last = 'P') building_open FROM r LEFT JOIN base b ON b.id = r.id LEFT JOIN prior p ON p.id = r.id""")
def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    r = t.orders.select((F.col("o_custkey") + 5).alias("id")).distinct()
    base = t.customer.select(F.col("c_custkey").alias("id"), "c_mktsegment", F.lit(True).alias("in_base"))
    prior = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderstatus").alias("last"))
    n, b, p = F.count("*"), F.count("in_base"), F.count("last")
    return r.join(base, "id", "left").join(prior, "id", "left").agg(n.alias("rows"), b.alias("with_base"), p.alias("with_prior"), (n - b).alias("missing_base"), (n - p).alias("missing_prior"), F.count_if((F.col("c_mktsegment") == "BUILDING") & (F.col("last") == "P")).alias("building_open"))


_REJECT = [("missing_unit", "o_custkey IS NULL"), ("invalid_value", "o_totalprice <= 1000"), ("missing_date", "o_orderdate IS NULL"), ("not_clean", "o_orderstatus = 'P'"), ("not_resolved", "o_shippriority <> 0"), ("expansion", "o_orderpriority LIKE '4%'"), ("invalid_motion", "o_orderpriority LIKE '5%'")]
_WHY = "CASE " + " ".join(f"WHEN {w} THEN '{n}'" for n, w in _REJECT) + " END"


def _outcomes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = tables(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority", F.lit(0).alias("o_shippriority"))
    return O.first_outcomes(o, [(n, F.expr(w)) for n, w in _REJECT], "o_custkey", "o_orderdate", "o_orderkey")


_SOURCE = f"(SELECT *, {_WHY} why FROM (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority, 0 o_shippriority FROM orders))"


@query("first_clean_outcome", f"SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) o_orderkey, min(o_orderdate) o_orderdate FROM {_SOURCE} WHERE why IS NULL GROUP BY 1")
def first_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir)[0].select("o_custkey", "o_orderkey", "o_orderdate")


@query("outcome_exclusions", f"SELECT why reason, count(*) \"rows\" FROM {_SOURCE} WHERE why IS NOT NULL GROUP BY 1 UNION ALL SELECT 'duplicate_unit', count(*) - count(DISTINCT o_custkey) FROM {_SOURCE} WHERE why IS NULL")
def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir)[1]


@query("rates_with_pending", """
SELECT lang, count(*) FILTER (WHERE quality = 1) good, count(quality) known, count(*) FILTER (WHERE quality IS NULL) pending, CASE WHEN count(quality) > 0 AND count(*) = count(quality) THEN count(*) FILTER (WHERE quality = 1) / count(quality) END rate,
 CASE WHEN count(quality) > 0 AND count(*) = count(quality) THEN greatest(count(*) FILTER (WHERE quality = 1) - 1, 0) / count(quality) END one_flip FROM (SELECT CASE WHEN d.doc_id % 3 = 0 THEN 'pending' ELSE 'known' END lang, CASE WHEN d.doc_id % 3 = 0 THEN quality ELSE coalesce(quality, 0) END quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY 1""")
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    third = F.col("doc_id") % 3 == 0
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left").select(F.when(third, "pending").otherwise("known").alias("lang"), F.when(third, F.col("quality")).otherwise(F.coalesce("quality", F.lit(0))).alias("quality"))
    return rows.groupBy("lang").agg(*O.rate(F.coalesce(F.col("quality") == 1, F.lit(False)), F.col("quality").isNotNull(), F.lit(True)))


@query("false_accepts_by_category", "SELECT source, count(*) n, count(*) FILTER (WHERE quality = 1) accepted, count(*) FILTER (WHERE quality = 1) / count(*) false_accept_rate FROM labels JOIN documents USING (doc_id) WHERE toxic = 1 GROUP BY 1")
def false_accepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    bad = t.labels.where("toxic = 1").select("doc_id", "quality").join(t.documents.select("doc_id", "source"), "doc_id")
    k, n = F.count_if(F.col("quality") == 1), F.count("*")
    return bad.groupBy("source").agg(n.alias("n"), k.alias("accepted"), (k / n).alias("false_accept_rate"))


@query("anchor_baseline", "SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' AND o_totalprice > 50000 THEN CAST(o_totalprice AS DOUBLE) END, median(CAST(o_totalprice AS DOUBLE)) OVER (PARTITION BY o_orderpriority)) baseline FROM orders")
def anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables(spark, sf_dir).orders.withColumn("value", F.col("o_totalprice").cast("double"))
    prior = F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 50000), F.col("value"))
    return O.anchored_or_median(o, prior, "o_orderpriority", "value").select("o_orderkey", "baseline")


@query("integer_quantiles", "SELECT l_returnflag, greatest(1, CAST(round(CAST(quantile_cont(CAST(l_quantity AS DOUBLE), 0.25) AS DECIMAL(38,10)), 0) AS INTEGER)) p25, greatest(1, CAST(round(CAST(quantile_cont(CAST(l_quantity AS DOUBLE), 0.4) AS DECIMAL(38,10)), 0) AS INTEGER)) p40 FROM lineitem GROUP BY 1")
def int_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities are few distinct values, so an exact percentile's buffer is small."""
    v = F.col("l_quantity").cast("double")
    return tables(spark, sf_dir).lineitem.groupBy("l_returnflag").agg(O.integer_quantile(v, 0.25).alias("p25"), O.integer_quantile(v, 0.4).alias("p40"))


_POLY = "0.17087277"
for _c in ("-0.82215223", "1.48851587", "-1.13520398", "0.27886807", "-0.18628806", "0.09678418", "0.37409196", "1.00002368", "-1.26551223"):
    _POLY = f"({_POLY}::DOUBLE * t + {_c}::DOUBLE)"


@query("rank_test", f"""
WITH v AS (SELECT value, event_type = 'click' a FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL), c AS (SELECT value, count(*) t, count(*) FILTER (WHERE a) a FROM v GROUP BY 1), r AS (SELECT t, a, 2 * (sum(t) OVER (ORDER BY value) - t) + t + 1 r2 FROM c),
 s AS (SELECT CAST(sum(a) AS BIGINT) n1, CAST(sum(t - a) AS BIGINT) n2, CAST(sum(a * r2) AS DOUBLE) r2, CAST(sum(CAST(t AS HUGEINT) * t * t - t) AS DOUBLE) ties FROM r), u AS (SELECT n1, n2, ties, r2 / 2 - n1 * (n1 + 1.0::DOUBLE) / 2 u, CAST(n1 AS DOUBLE) * n2 m, CAST(n1 + n2 AS DOUBLE) n FROM s),
 z AS (SELECT n1, n2, u, (greatest(u, m - u) - m / 2 - 0.5) / sqrt(m / 12 * ((n + 1) - ties / (n * (n - 1)))) z FROM u), e AS (SELECT *, abs(z) / sqrt(2.0::DOUBLE) x, 1 / (1 + 0.5 * abs(z) / sqrt(2.0::DOUBLE)) t FROM z)
SELECT n1, n2, u, round(z, 9) z, round(least(1.0::DOUBLE, t * exp(-x * x + {_POLY})), 9) p FROM e""")
def rank_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables(spark, sf_dir).events.where("event_type IS NOT NULL").select("value", (F.col("event_type") == "click").alias("a"))
    return O.mann_whitney(e, "a", "value").select("n1", "n2", "u", F.round("z", 9).alias("z"), F.round(O.two_sided(F.col("z")), 9).alias("p"))


_CHECKS = {"key_there": "o_orderkey IS NOT NULL", "status_known": "o_orderstatus IN ('O', 'F', 'P')", "value_in_band": "o_totalprice BETWEEN 1000 AND 400000", "date_there": "o_orderdate IS NOT NULL", "priority_shape": "o_orderpriority LIKE '_-%'", "open_has_value": "o_orderstatus <> 'O' OR o_totalprice > 0"}


@query("run_audit", " UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) FILTER (WHERE NOT coalesce({c}, false)) failed, count(*) FILTER (WHERE NOT coalesce({c}, false)) = 0 passed FROM orders" for n, c in _CHECKS.items()))
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.audit(tables(spark, sf_dir).orders, {n: F.expr(c) for n, c in _CHECKS.items()})


@query("gate_acceptance", """
SELECT o_orderpriority control, count(*) present, count(*) FILTER (WHERE o_orderstatus = 'F') accepted, count(*) FILTER (WHERE o_orderstatus <> 'F' AND o_totalprice > 300000) bypassed, count(*) FILTER (WHERE o_orderstatus = 'F' AND NOT (o_totalprice BETWEEN 1000 AND 350000)) band_violations,
 count(*) FILTER (WHERE o_orderstatus <> 'F' AND o_totalprice > 300000) = 0 AND count(*) FILTER (WHERE o_orderstatus = 'F' AND NOT (o_totalprice BETWEEN 1000 AND 350000)) = 0 AS passed FROM orders GROUP BY 1""")
def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, price = F.col("o_orderstatus") == "F", F.col("o_totalprice")
    bypass, outside = F.count_if(~kept & (price > 300000)), F.count_if(kept & ~price.between(1000, 350000))
    return tables(spark, sf_dir).orders.groupBy(F.col("o_orderpriority").alias("control")).agg(F.count("*").alias("present"), F.count_if(kept).alias("accepted"), bypass.alias("bypassed"), outside.alias("band_violations"), ((bypass == 0) & (outside == 0)).alias("passed"))


@query("input_order_and_priority", "SELECT c_custkey, coalesce(o.place, 999999) place, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 3 ELSE 4 END priority, list_distinct([c_mktsegment, 'BUILDING', c_mktsegment])[1] IS NOT NULL AS has_reason FROM customer LEFT JOIN (SELECT o_custkey, CAST(min(o_orderkey) AS BIGINT) place FROM orders GROUP BY 1) o ON o_custkey = c_custkey")
def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    place = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").cast("long").alias("place"))
    rank = F.create_map(*(F.lit(x) for pair in (("BUILDING", 1), ("MACHINERY", 2), ("FURNITURE", 3)) for x in pair))
    out = O.in_order(t.customer.select("c_custkey", "c_mktsegment"), place, "c_custkey", "place")
    reasons = F.array_distinct(F.array(F.col("c_mktsegment"), F.lit("BUILDING"), F.col("c_mktsegment")))  # keeps the order in which they came
    return out.select("c_custkey", "place", F.coalesce(F.element_at(rank, F.col("c_mktsegment")), F.lit(4)).alias("priority"), F.get(reasons, F.lit(0)).isNotNull().alias("has_reason")).orderBy("priority", "place", "c_custkey")


@query("resume_unfinished", "SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT')")
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority")
    done = tables(spark, sf_dir).orders.where("o_orderstatus = 'F'").select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "changed").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return O.unfinished(o, done, "o_orderkey", "o_orderpriority").select("o_orderkey")


@query("rounding_modes", "SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) / 100, 0) AS BIGINT) half_up, CAST(round_even(CAST(l_quantity AS DOUBLE) / 2, 0) AS BIGINT) half_even, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') stamp FROM lineitem")
def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyforge.functions.entity import utc_stamp

    up = F.round(F.col("l_extendedprice").cast("decimal(18,2)").cast("double") / 100, 0).cast("long")
    even = F.bround((F.col("l_quantity").cast("decimal(10,2)") / 2).cast("decimal(12,4)"), 0).cast("long")
    return tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", up.alias("half_up"), even.alias("half_even"), utc_stamp(F.col("l_shipdate").cast("timestamp")).alias("stamp"))


@query("cohort_estimator", """
WITH k AS (SELECT c_mktsegment s, c_nationkey % 2 = 0 AS train, CAST(c_acctbal AS DOUBLE) y, c_custkey FROM customer), m AS (SELECT s, median(y) md FROM k WHERE train GROUP BY 1 HAVING count(*) >= 8), w AS (SELECT median(y) md FROM k WHERE train)
SELECT c_custkey, 0.75 * coalesce(m.md, (SELECT md FROM w)) + 0.25 * 1000.0::DOUBLE prediction, 'flat-1' formula_version FROM k LEFT JOIN m USING (s) WHERE NOT train""")
def estimator(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", (F.col("c_nationkey") % 2 == 0).alias("train"), F.col("c_acctbal").cast("double").alias("y"))
    model = SparseMedian(cohortCol="c_mktsegment", labelCol="y", formula="1000.0D", formulaVersion="flat-1").fit(c.where("train"))
    return model.transform(c.where("NOT train")).select("c_custkey", "prediction", "formula_version")


@query("quantile_boost")
def quantile_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's price as its size and its customer's last order tell it, by priority; trees aren't SQL's, tests look at coverage and loss."""
    t = tables(spark, sf_dir)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("listed"))
    before = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = t.orders.select("*", F.lag("o_totalprice").over(before).alias("prior"), F.lag("o_orderdate").over(before).alias("prior_at")).join(lines, "o_orderkey", "left")
    o = written(o.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus", "prior", "prior_at", "lines", "quantity", "listed"))  # read by each step of the fit
    model = QuantileBoost(laneCol="o_orderpriority", labelCol="o_totalprice", featureCols=["lines", "quantity", "listed"], categoryCols=["o_orderstatus"], priorCol="prior", priorAtCol="prior_at", asOfCol="o_orderdate", trees=12, rate=0.3).fit(o.where("o_orderdate < timestamp'1999-01-01'"))
    return model.transform(o).select("o_orderkey", "o_totalprice", "estimate.*")


@query("ratio_pairs_with_zero", """
WITH v AS (SELECT DISTINCT c_nationkey k, floor(c_acctbal / 1000) v FROM customer WHERE c_acctbal >= 0)
SELECT a.k nation, count(*) pairs, count(*) FILTER (WHERE a.v = 0) zeros FROM v a JOIN v b ON a.k = b.k AND ((a.v = 0 AND b.v = 0) OR (a.v > 0 AND b.v >= 0.5 * a.v AND b.v <= 2 * a.v)) GROUP BY 1""")
def ratio_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of balance of each nation, a handful, that lie near each other; zero goes with zero."""
    v = tables(spark, sf_dir).customer.where("c_acctbal >= 0").select(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 1000).cast("double").alias("v")).distinct()
    return J.in_ratio(v, v.withColumnRenamed("v", "w"), ["nation"], "v", "w", 0.5, 2.0).groupBy("nation").agg(F.count("*").alias("pairs"), F.count_if(F.col("v") == 0).alias("zeros"))


@query("candidate_scoring")
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's best supplier of its nation by name, place and kind; the ratio isn't SQL's, so tests hold it against brute force."""
    t = tables(spark, sf_dir)
    left = t.customer.select(F.col("c_custkey").alias("id"), F.lower(F.regexp_replace("c_name", "[^A-Za-z0-9]+", " ")).alias("name"), F.lower("c_mktsegment").alias("city"), F.col("c_nationkey").alias("nation"))
    right = t.supplier.select(F.col("s_suppkey").alias("rid"), F.lower(F.regexp_replace("s_name", "[^A-Za-z0-9]+", " ")).alias("rname"), F.lit("building").alias("rcity"), (F.col("s_acctbal") > 0).alias("rstate"), (F.col("s_acctbal") > 5000).alias("rtype"), F.col("s_nationkey").alias("nation"))
    return O.candidate_scores(left, right, "nation")


@query("registry_first_match", """
SELECT l_orderkey, count(*) attempts, coalesce(arg_min(l_suppkey, (l_linenumber, l_suppkey)) FILTER (WHERE l_returnflag = 'R'), -1) matched, CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN 'matched_active_agency' ELSE 'no_active_agency_match' END status,
 string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag, ' | ' ORDER BY l_linenumber, l_returnflag) FILTER (WHERE l_returnflag <> 'A') evidence FROM lineitem GROUP BY 1""")
def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first accepted answer in the order of attempts, and all that was found; an account's attempts are few."""
    found = F.col("l_returnflag") == "R"
    line = F.when(F.col("l_returnflag") != "A", F.struct("l_linenumber", F.concat_ws(":", F.col("l_linenumber").cast("string"), "l_returnflag").alias("line")))
    out = tables(spark, sf_dir).lineitem.groupBy("l_orderkey").agg(F.count("*").alias("attempts"), F.min_by("l_suppkey", F.when(found, F.struct("l_linenumber", "l_suppkey"))).alias("matched"), F.count_if(found).alias("_n"), F.array_sort(F.collect_list(line)).alias("_e"))
    evidence = F.when(F.size("_e") > 0, F.array_join(F.col("_e.line"), " | "))
    return out.select("l_orderkey", "attempts", F.when(F.col("_n") > 0, F.col("matched")).otherwise(-1).alias("matched"), F.when(F.col("_n") > 0, "matched_active_agency").otherwise("no_active_agency_match").alias("status"), evidence.alias("evidence"))

