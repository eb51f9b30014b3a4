"""Metrics, drift, coverage, rules and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions import numbers as N
from tallyforge.functions import text as X
from tallyforge.operators import aggregates as A
from tallyforge.operators import joins as J
from tallyforge.operators import rules as R
from tallyforge.operators import sampling as S
from tallyforge.plans.catalog import query
from tallyforge.sources.tables import tables

_RULES = [("no_status", "o_orderstatus IS NULL"), ("open", "o_orderstatus = 'P'"), ("small", "o_totalprice < 20000"), ("old", "o_orderdate < timestamp'1996-01-01'"), ("low_priority", "o_orderpriority LIKE '5%'")]
_CASE = "CASE " + " ".join(f"WHEN {w} THEN '{n}'" for n, w in _RULES)


def _rules() -> R.Rules:
    return [(n, F.expr(w)) for n, w in _RULES]


@query("reason_collect_first_failure", f"SELECT o_orderkey, {_CASE} END first_reason, array_to_string(list_filter([{', '.join(f'''CASE WHEN {w} THEN '{n}' END''' for n, w in _RULES)}], lambda x: x IS NOT NULL), '; ') reasons FROM orders")
def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).orders.select("o_orderkey", R.first_match(_rules()).alias("first_reason"), F.array_join(R.all_matches(_rules()), "; ").alias("reasons"))


@query("priority_reason", f"SELECT o_orderkey, CASE WHEN o_orderdate < timestamp '1996-01-01' THEN 'old' WHEN o_totalprice < 20000 THEN 'small' ELSE {_CASE} END END reason FROM orders")
def priority_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).orders.select("o_orderkey", R.pick_by_priority(R.all_matches(_rules()), ("old", "small")).alias("reason"))


@query("exclusion_funnel", f"""
WITH f AS (SELECT {_CASE} END reason FROM orders), c AS (SELECT reason, count(*) n FROM f GROUP BY 1), k AS (SELECT * FROM (VALUES ('no_status', 0), ('open', 1), ('small', 2), ('old', 3), ('low_priority', 4)) v(reason, o))
SELECT reason, n excluded, (SELECT count(*) FROM f) - CAST(sum(n) OVER (ORDER BY o) AS BIGINT) remaining FROM c JOIN k USING (reason)""")
def exclusion_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.funnel(tables(spark, sf_dir).orders, _rules())


@query("hard_exclusion_partition", """
SELECT c_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'held' WHEN count(o_orderkey) = 0 THEN 'no_change' WHEN c_acctbal < 0 THEN 'excluded' ELSE 'accepted' END queue FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal""")
def hard_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderstatus") == "P").alias("open"), F.count("*").alias("n"))
    queue = R.first_match([("held", F.col("open")), ("no_change", F.col("n").isNull()), ("excluded", F.col("c_acctbal") < 0)], "accepted")
    return t.customer.join(o, "c_custkey", "left").select("c_custkey", queue.alias("queue"))


_PRED = "SELECT o_custkey, o_orderpriority seg, o_totalprice actual, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) pred FROM orders"


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return tables(spark, sf_dir).orders.select(F.col("o_orderpriority").alias("seg"), F.col("o_totalprice").alias("actual"), F.lag("o_totalprice").over(w).alias("pred")).where("pred is not null")


_ERR = "(CAST(pred AS DECIMAL(18,2)) - CAST(actual AS DECIMAL(18,2)))"
_METRICS = f"""count(*) n, CAST(sum(abs({_ERR})) AS DOUBLE) / count(*) mae, median(CAST(abs({_ERR}) AS DOUBLE)) median_ae, CAST(sum({_ERR}) AS DOUBLE) / count(*) bias, median(CAST({_ERR} AS DOUBLE)) median_bias,
  count(*) FILTER (WHERE {_ERR} > 0) / count(*) over_rate, count(*) FILTER (WHERE {_ERR} < 0) / count(*) under_rate, count(*) FILTER (WHERE actual >= pred * 0.5 AND actual <= pred * 2) / count(*) coverage, count(*) FILTER (WHERE pred * 0.5 > pred * 2) violations"""


@query("regression_metrics_all", f"SELECT {_METRICS} FROM ({_PRED}) WHERE pred IS NOT NULL")
def metrics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, p = F.col("actual"), F.col("pred")
    return A.regression_report(_predicted(spark, sf_dir), [], a, p, p * 0.5, p * 2)


@query("regression_metrics_by_segment", f"SELECT seg, {_METRICS} FROM ({_PRED}) WHERE pred IS NOT NULL GROUP BY seg")
def metrics_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, p = F.col("actual"), F.col("pred")
    return A.regression_report(_predicted(spark, sf_dir), ["seg"], a, p, p * 0.5, p * 2)


@query("quantile_calibration", f"""
WITH x AS (SELECT * FROM ({_PRED}) WHERE pred IS NOT NULL), q AS (SELECT q, actual, pred * (0.5 + q) p FROM x CROSS JOIN (VALUES (0.5::DOUBLE), (0.75), (0.9)) v(q))
SELECT q quantile, count(*) FILTER (WHERE actual <= p) / count(*) observed, round(abs(count(*) FILTER (WHERE actual <= p) / count(*) - q), 9) calibration_error,
 round(CAST(sum(CAST(greatest(q * (actual - p), (q - 1) * (actual - p)) AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) pinball FROM q GROUP BY q""")
def quantile_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _predicted(spark, sf_dir).withColumn("q", F.explode(F.array(*map(F.lit, (0.5, 0.75, 0.9))))).withColumn("p", F.col("pred") * (0.5 + F.col("q")))
    e, n = F.col("actual") - F.col("p"), F.count("*")
    seen = F.count_if(F.col("actual") <= F.col("p")) / n
    loss = F.greatest(F.col("q") * e, (F.col("q") - 1) * e).cast("decimal(18,2)")
    return x.groupBy(F.col("q").alias("quantile")).agg(seen.alias("observed"), F.round(F.abs(seen - F.first("q")), 9).alias("calibration_error"), F.round(F.sum(loss).cast("double") / n, 2).alias("pinball"))


@query("acceptance_precision_wilson", """
WITH x AS (SELECT lang, quality = 1 accepted, toxic = 0 good FROM labels JOIN documents USING (doc_id)), c AS (SELECT lang, count(*) FILTER (WHERE accepted) n, count(*) FILTER (WHERE accepted AND good) k FROM x GROUP BY 1)
SELECT lang, n, k correct, n - k wrong, k / n AS "precision", round((k / n + 1.959963984540054 * 1.959963984540054 / (2 * n) - 1.959963984540054 * sqrt(((k / n) * (1 - k / n) + 1.959963984540054 * 1.959963984540054 / (4 * n)) / n)) / (1 + 1.959963984540054 * 1.959963984540054 / n), 12) wilson_low FROM c WHERE n > 0""")
def precision_wilson(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    x = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    c = x.groupBy("lang").agg(F.count_if(F.col("quality") == 1).alias("n"), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("correct")).where("n > 0")
    return c.select("lang", "n", "correct", (F.col("n") - F.col("correct")).alias("wrong"), (F.col("correct") / F.col("n")).alias("precision"), F.round(A.wilson_low(F.col("correct"), F.col("n")), 12).alias("wilson_low"))


@query("psi_categorical", """
WITH c AS (SELECT event_type, count(*) FILTER (WHERE ts < timestamp '2024-01-15') a, count(*) FILTER (WHERE ts >= timestamp '2024-01-15') b FROM events GROUP BY 1), s AS (SELECT event_type, a / sum(a) OVER () p, b / sum(b) OVER () q FROM c)
SELECT round(sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6))), 9) psi, round(sum(abs(p - q)) / 2, 9) total_variation,
 CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'review' ELSE 'material' END state FROM s""")
def psi_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.col("ts") < F.expr("timestamp'2024-01-15'")
    s = A.shares(tables(spark, sf_dir).events, "event_type", (early, ~early))
    out = s.agg(F.round(F.sum(A.psi(F.col("p"), F.col("q"))), 9).alias("psi"), F.round(F.sum(F.abs(F.col("p") - F.col("q"))) / 2, 9).alias("total_variation"))
    return out.withColumn("state", A.stability(F.col("psi")))


@query("psi_numeric", """
WITH e AS (SELECT list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) q FROM events WHERE ts < timestamp '2024-01-15' AND value IS NOT NULL),
b AS (SELECT len(list_filter(q, lambda x: value >= x)) bin, ts < timestamp '2024-01-15' early FROM events CROSS JOIN e WHERE value IS NOT NULL),
c AS (SELECT bin, count(*) FILTER (WHERE early) a, count(*) FILTER (WHERE NOT early) b FROM b GROUP BY 1), s AS (SELECT a / sum(a) OVER () p, b / sum(b) OVER () q FROM c)
SELECT round(sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6))), 9) psi FROM s""")
def psi_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins are the deciles of the reference period; their edges are one row."""
    e = tables(spark, sf_dir).events.where("value is not null")
    early = F.col("ts") < F.expr("timestamp'2024-01-15'")
    edges = A.exact_quantiles(e.where(early), [], F.col("value"), [k / 10 for k in range(1, 10)]).select(F.array_distinct("quantiles").alias("edges"))
    binned = e.join(edges).withColumn("bin", F.size(F.filter("edges", lambda x: F.col("value") >= x)))
    return A.shares(binned, "bin", (early, ~early)).agg(F.round(F.sum(A.psi(F.col("p"), F.col("q"))), 9).alias("psi"))


@query("source_freshness", """
WITH m AS (SELECT max(ts) t FROM events), a AS (SELECT event_type, (epoch_us(t) - epoch_us(ts)) / 86400000000.0 age FROM events CROSS JOIN m)
SELECT event_type, count(*) n, count(*) FILTER (WHERE age >= 0 AND age <= 7) fresh, count(*) FILTER (WHERE NOT (age >= 0 AND age <= 7)) stale, round(median(age), 6) median_age, round(quantile_cont(age, 0.9), 6) p90_age FROM a GROUP BY 1""")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables(spark, sf_dir).events
    a = e.join(e.agg(F.max("ts").alias("t"))).withColumn("age", N.age_days(F.col("ts"), F.col("t")))
    ok = N.fresh(F.col("age"), 7)
    counts = a.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(ok).alias("fresh"), F.count_if(~ok).alias("stale"))
    middle = A.exact_quantiles(a, ["event_type"], F.col("age"), [0.5, 0.9]).drop("n")
    return counts.join(middle, "event_type").select("event_type", "n", "fresh", "stale", *(F.round(F.get("quantiles", F.lit(k)), 6).alias(n) for k, n in enumerate(("median_age", "p90_age"))))


@query("id_reconciliation", """
WITH a AS (SELECT CAST(c_custkey AS VARCHAR) id, count(*) n FROM customer GROUP BY 1), b AS (SELECT CAST(o_custkey AS VARCHAR) id, count(*) n FROM orders GROUP BY 1), j AS (SELECT coalesce(a.n, 0) x, coalesce(b.n, 0) y FROM a FULL JOIN b USING (id))
SELECT count(*) FILTER (WHERE x > 0 AND y > 0) "both", count(*) FILTER (WHERE y = 0) only_a, count(*) FILTER (WHERE x = 0) only_b, count(*) FILTER (WHERE x > 1) duplicate_a, count(*) FILTER (WHERE y > 1) duplicate_b, CAST(0 AS BIGINT) blank_a, CAST(0 AS BIGINT) blank_b FROM j""")
def id_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return J.reconcile(t.customer.select(F.col("c_custkey").alias("id")), t.orders.select(F.col("o_custkey").alias("id")), "id")


@query("leakage_overlap", """
SELECT 'text' field, count(DISTINCT lower(trim(d.text))) overlap FROM documents d SEMI JOIN benchmark b ON lower(trim(d.text)) = lower(trim(b.text))""")
def leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    norm = F.lower(F.trim("text")).alias("v")
    return t.documents.select(norm).join(t.benchmark.select(norm), "v", "left_semi").agg(F.count_distinct("v").alias("overlap")).select(F.lit("text").alias("field"), "overlap")


@query("column_coverage", " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) FILTER (WHERE {w}) present, count(*) FILTER (WHERE {w}) * 100.0::DOUBLE / count(*) percent FROM customer" for c, w in (("c_custkey", "c_custkey IS NOT NULL"), ("c_name", "trim(c_name) <> ''"), ("c_nationkey", "c_nationkey IS NOT NULL"), ("c_acctbal", "c_acctbal IS NOT NULL"), ("c_mktsegment", "trim(c_mktsegment) <> ''"))))
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.column_coverage(tables(spark, sf_dir).customer)


@query("frequency_tables", "SELECT coalesce(nullif(trim(o_orderpriority), ''), '(blank)') AS value, count(*) n FROM orders GROUP BY 1")
def frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.frequency(tables(spark, sf_dir).orders, "o_orderpriority")


@query("multi_dim_breakdown", "SELECT 'o_orderstatus' dimension, o_orderstatus AS value, count(*) n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2")
def breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.breakdown(tables(spark, sf_dir).orders, ["o_orderstatus", "o_orderpriority"])


@query("nested_counts", "SELECT o_orderstatus, o_orderpriority, count(*) n, grouping(o_orderpriority) total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping("o_orderpriority").cast("long").alias("total"))


@query("spearman_rank_table", """
WITH x AS (SELECT c_acctbal a, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) b FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal),
r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2 ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2 rb FROM x) SELECT count(*) n, round(corr(ra, rb), 9) rho FROM r""")
def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(A.money_sum(F.col("o_totalprice")).alias("spent"))
    return A.spearman(t.customer.join(spent, "c_custkey"), "c_acctbal", "spent").select("n", F.round("rho", 9).alias("rho"))


@query("membership_lift_with_total", """
WITH x AS (SELECT c_mktsegment = 'BUILDING' member, c_acctbal v FROM customer), g AS (SELECT CASE WHEN member THEN 'member' ELSE 'other' END grp, count(*) n, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / count(*) mean, median(v) med FROM x GROUP BY 1
UNION ALL SELECT 'all', count(*), CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / count(*), median(v) FROM x)
SELECT grp "group", n, mean, med "median", round(med / (SELECT med FROM g WHERE grp = 'other'), 9) median_ratio, n < 20 directional FROM g""")
def membership_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.when(F.col("c_mktsegment") == "BUILDING", "member").otherwise("other")
    x = tables(spark, sf_dir).customer.select(F.explode(F.array(group, F.lit("all"))).alias("group"), F.col("c_acctbal").alias("v"))
    middle = A.exact_quantiles(x, ["group"], F.col("v"), [0.5]).select("group", F.get("quantiles", F.lit(0)).alias("median"))
    g = x.groupBy("group").agg(F.count("*").alias("n"), (A.money_sum(F.col("v")) / F.count("*")).alias("mean")).join(middle, "group")
    base = F.max(F.when(F.col("group") == "other", F.col("median"))).over(Window.partitionBy())
    return g.withColumn("median_ratio", F.round(F.col("median") / base, 9)).withColumn("directional", F.col("n") < 20)


@query("rank_accepted", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN row_number() OVER (PARTITION BY c_mktsegment, c_acctbal > 0 ORDER BY c_acctbal DESC, c_name, c_custkey) END AS rank FROM customer""")
def rank_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_name")
    ranked = A.ranks(c.where("c_acctbal > 0"), ["c_mktsegment"], "c_acctbal", [F.col("c_name"), F.col("c_custkey")]).select("c_custkey", "rank")
    return ranked.unionByName(c.where("NOT coalesce(c_acctbal > 0, false)").select("c_custkey", F.lit(None).cast("int").alias("rank")))


@query("topn_total_order", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("hash_order_sample", "SELECT c_custkey, sha256('run-1:' || c_custkey) print FROM customer ORDER BY print, c_custkey LIMIT 200")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.hash_order(tables(spark, sf_dir).customer.select("c_custkey"), "c_custkey", "run-1", 200)


@query("stratified_round_robin", """
WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('run-1:' || c_custkey), c_custkey) AS turn FROM customer) SELECT c_custkey, c_mktsegment, turn FROM r ORDER BY turn, c_mktsegment LIMIT 150""")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.round_robin(tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment"), "c_custkey", ["c_mktsegment"], "run-1", 150)


_STRATA = """
WITH o AS (SELECT o_custkey k, max(o_totalprice) most, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) status FROM orders GROUP BY 1),
 c AS (SELECT c_custkey, c_mktsegment seg, CAST(n_regionkey AS VARCHAR) region, coalesce(status, '') status, CAST(CAST(floor(c_acctbal / 4000) AS BIGINT) AS VARCHAR) band, coalesce(most, 0) most FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN o ON k = c_custkey),
 t AS (SELECT c_custkey FROM c ORDER BY most DESC, c_custkey LIMIT 20), g AS (SELECT * FROM c WHERE c_custkey NOT IN (FROM t)), s AS (SELECT list({a: seg, b: region, c: status, d: band} ORDER BY n, seg, region, status, band) l FROM (SELECT seg, region, status, band, count(*) n FROM g GROUP BY ALL)),
 r(i, kept) AS (SELECT 1, list_transform(l, lambda x: true) FROM s UNION ALL SELECT i + 1, CASE WHEN len(list_filter(kept, lambda x: x)) > 30 AND {checks} THEN list_transform(range(1, len(l) + 1), lambda j: kept[j] AND j <> i) ELSE kept END FROM r, s WHERE i <= len(l)),
 k AS (SELECT unnest(list_filter(list_transform(range(1, len(l) + 1), lambda j: CASE WHEN kept[j] THEN l[j] END), lambda x: x IS NOT NULL)) x FROM r, s WHERE i = len(l) + 1),
 n AS (SELECT c_custkey, seg, region, status, band, row_number() OVER (PARTITION BY seg, region, status, band ORDER BY sha256('run-1:' || c_custkey), c_custkey) rn FROM g JOIN k ON seg = x.a AND region = x.b AND status = x.c AND band = x.d)
SELECT c_custkey, 'top' why FROM t UNION ALL SELECT c_custkey, 'stratum' FROM (FROM n ORDER BY rn, seg, region, status, band LIMIT 30)"""


@query("stratified_canary", "WITH RECURSIVE " + _STRATA.replace("{checks}", " AND ".join(f"len(list_filter(range(1, len(l) + 1), lambda j: j <> i AND kept[j] AND l[j].{d} = l[i].{d})) > 0" for d in "abcd")).replace("\nWITH ", "", 1))
def stratified_canary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty accounts of the largest orders, and thirty over strata of segment, region, last status and balance."""
    t = tables(spark, sf_dir)
    o = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("most"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"))
    c = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(o, F.col("o_custkey") == F.col("c_custkey"), "left")
    c = c.select("c_custkey", F.col("c_mktsegment").alias("seg"), F.col("n_regionkey").alias("region"), "status", F.floor(F.col("c_acctbal") / 4000).alias("band"), F.coalesce("most", F.lit(0.0)).alias("most"))
    return S.canary(c, "c_custkey", ["seg", "region", "status", "band"], [F.desc("most")], seed="run-1")


@query("shard_modulo", "SELECT c_custkey % 16 shard, count(*) n, min(c_custkey) first_key FROM customer GROUP BY 1")
def shard_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).customer.groupBy(F.pmod("c_custkey", F.lit(16)).cast("long").alias("shard")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key"))


@query("event_window_counts", "SELECT date_trunc('hour', ts) start, event_type, count(*) n, count(DISTINCT user_id) users FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form of streaming/windows.py: the same expressions over a bounded table."""
    return tables(spark, sf_dir).events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").start.cast("timestamp_ntz").alias("start"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("json_field_aggregate", "SELECT event_type, count(*) n, count(json_extract_string(props, '$.k')) with_k, count(DISTINCT json_extract_string(props, '$.k')) kinds FROM events GROUP BY 1")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return tables(spark, sf_dir).events.groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("with_k"), F.count_distinct(k).alias("kinds"))


@query("survivor_rollup", """
SELECT c_nationkey, min(c_custkey) survivor, count(*) members, count(*) FILTER (WHERE c_acctbal > 0) accepted, CAST(sum(('0x' || left(md5(CAST(c_custkey AS VARCHAR)), 12))::BIGINT) AS BIGINT) member_print FROM customer GROUP BY 1""")
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members' print is a sum of their hashes, so that no group's members are gathered or sorted."""
    one = F.conv(F.left(F.md5(F.col("c_custkey").cast("string").cast("binary")), F.lit(12)), 16, 10).cast("long")
    return tables(spark, sf_dir).customer.groupBy("c_nationkey").agg(F.min("c_custkey").alias("survivor"), F.count("*").alias("members"), F.count_if(F.col("c_acctbal") > 0).alias("accepted"), F.sum(one).alias("member_print"))


@query("variance_classification", """
WITH x AS (SELECT c_custkey, max(o_totalprice) / 1000 sales, abs(c_acctbal) / 20 model FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal), r AS (SELECT *, CASE WHEN model <> 0 THEN sales / model END r, sales - model d FROM x)
SELECT c_custkey, CASE WHEN r IS NULL THEN 'no_model' WHEN r >= 3 AND d >= 100 THEN 'severe_over' WHEN r >= 2 AND d >= 50 THEN 'over' WHEN r <= 1.0::DOUBLE / 3 AND d <= -100 THEN 'severe_under' WHEN r <= 0.5 AND d <= -50 THEN 'under' WHEN abs(d) <= greatest(5, abs(model) * 0.05) THEN 'echo' ELSE 'aligned' END class FROM r""")
def variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    top = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.max("o_totalprice") / 1000).alias("sales"))
    return t.customer.join(top, "c_custkey").select("c_custkey", N.ratio_class(F.col("sales"), F.abs("c_acctbal") / 20).alias("class"))


@query("group_vote", """
WITH v AS (SELECT c_nationkey g, c_mktsegment c, count(*) w FROM customer GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY w DESC, c DESC) k FROM v), t AS (SELECT g, max(c) FILTER (WHERE k = 1) c, max(w) FILTER (WHERE k = 1) w1, coalesce(max(w) FILTER (WHERE k = 2), 0) w2 FROM r GROUP BY 1)
SELECT g c_nationkey, CASE WHEN w1 >= 10 AND w1 - w2 >= 2 THEN c END winner, w1 top_weight, w2 second_weight FROM t""")
def group_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.unique_top(tables(spark, sf_dir).customer, "c_nationkey", "c_mktsegment", F.count("*"), 10, 2)


@query("record_fingerprint", "SELECT c_custkey, sha256('c_custkey=' || c_custkey || chr(10) || 'c_mktsegment=' || trim(c_mktsegment) || chr(10) || 'c_name=' || trim(c_name)) print FROM customer")
def record_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).customer.select("c_custkey", X.fingerprint("c_custkey", "c_name", "c_mktsegment").alias("print"))
