"""A whole run over one snapshot, publishing lots with a ledger, a backtest, controls and office evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import pages as P
from tallyforge.operators import aggregates as A
from tallyforge.operators import ladders as L
from tallyforge.operators import publish
from tallyforge.operators.estimators import SparseMedian
from tallyforge.plans.catalog import query
from tallyforge.plans.fixtures import listed, twin
from tallyforge.sources.tables import tables

#: The snapshot's facts from customers: every stage's columns.
_FACTS = (
    ("id", "CAST(c_custkey AS VARCHAR(20))"), ("has_site", "c_custkey % 17 <> 0"), ("registrable", "c_custkey % 19 <> 0"), ("directory", "c_custkey % 23 = 0"), ("generic", "c_custkey % 29 = 0"), ("hygiene_bad", "c_custkey % 31 = 0"), ("country_conflict", "c_custkey % 37 = 0"), ("state_conflict", "c_custkey % 41 = 0"), ("geo_conflict", "c_custkey % 7 = 0"), ("phone_conflict", "c_custkey % 5 = 0"),
    ("entity_class", "CASE c_nationkey % 5 WHEN 0 THEN 'title_escrow' WHEN 1 THEN 'legal' WHEN 2 THEN 'organization' WHEN 3 THEN 'mortgage_lender' ELSE 'title_escrow' END"), ("crm_class", "CASE c_nationkey % 3 WHEN 0 THEN 'title_escrow' WHEN 1 THEN 'legal' ELSE '' END"),
    ("name_score", "CAST(c_custkey % 10 AS DOUBLE) / 9"), ("domain_score", "CAST(c_custkey % 4 AS DOUBLE) / 3"), ("phone_match", "c_custkey % 2 = 0"), ("address_match", "c_custkey % 3 = 0"), ("geo_match", "c_custkey % 4 = 1"), ("registry_match", "c_custkey % 6 = 1"), ("has_names", "c_custkey % 11 <> 0"), ("has_addresses", "c_custkey % 3 = 0"), ("has_phones", "c_custkey % 2 = 0"), ("member_confirmed", "c_custkey % 13 = 0"),
    ("active_flag", "c_custkey % 43 = 0"), ("inactive_flag", "c_custkey % 2 = 1"), ("revenue", "CASE WHEN c_custkey % 47 = 0 THEN 1.5 ELSE 0.0 END"), ("status_text", "CASE WHEN c_custkey % 53 = 0 THEN 'former customer' ELSE '' END"), ("account_type", "'prospect'"), ("company_type", "'title'"),
    ("survivor", "CASE WHEN c_custkey % 59 = 0 THEN 's1' ELSE '' END"), ("loser", "c_custkey % 2 = 1"), ("duplicate_high", "c_custkey % 4 = 0"), ("owned_direct", "c_custkey % 61 = 0"), ("owned_parent", "''"), ("dba_parent", "''"), ("branch_parent", "''"), ("parent", "CASE WHEN c_custkey % 16 = 3 THEN 'p1' ELSE '' END"), ("hint", "''"), ("independent", "c_custkey % 32 = 3"), ("central", "c_custkey % 64 = 19"),
    ("domain_customers", "c_custkey % 67 = 0"), ("shared_domain", "c_custkey % 71 = 0"), ("cluster_size", "CAST(c_custkey % 3 AS INT)"), ("has_members", "c_custkey % 73 = 0"),
    ("is_law", "c_nationkey % 5 = 1"), ("affiliated", "c_custkey % 8 = 0"), ("closing", "CAST(c_custkey % 3 AS INT)"), ("weak", "CAST(c_custkey % 2 AS INT)"), ("general", "CAST(c_custkey % 4 AS INT)"), ("attorney_state", "c_nationkey % 2 = 0"), ("underwriter", "c_custkey % 79 = 0"), ("brokerage_affiliation", "c_custkey % 83 = 0"), ("operator", "CAST(c_custkey % 4 AS INT)"), ("adjacent", "CASE WHEN c_custkey % 9 = 0 THEN 'bank' ELSE '' END"), ("adjacent_site", "c_custkey % 2 = 0"), ("abstract", "c_custkey % 10 = 0"), ("title_wording", "c_custkey % 2 = 0"),
    ("evidence_confidence", "CASE c_custkey % 3 WHEN 0 THEN 'High' ELSE 'Medium' END"), ("pages", "CAST(c_custkey % 5 AS INT)"), ("evidence_hash", "'x'"), ("age_days", "CAST(c_custkey % 120 AS DOUBLE)"), ("point", "CAST(c_acctbal AS DOUBLE)"), ("low", "CAST(c_acctbal AS DOUBLE)"), ("high", "CAST(c_acctbal AS DOUBLE)"), ("value_confidence", "'High'"), ("arr_point", "CAST(c_acctbal AS DOUBLE)"), ("comparables", "CAST(c_custkey % 20 AS INT)"), ("provisional", "c_custkey % 50 = 0"),
)
_LAYERS = (L.BINDING_FACTS, L.BINDING, (("binding_status", "status"), ("binding_confidence", "confidence")), L.LIFECYCLE, L.RELATION, L.UNIT, (("unit_eligible", "eligible"),), L.LANE, L.LANE_ELIGIBLE, L.ACCEPTANCE, L.DISPOSITION)


@query("shadow_run", f"SELECT status, relationship, lane, subtype, disposition, operation, count(*) accounts, count(*) FILTER (WHERE eligible_for_value) eligible, count(*) FILTER (WHERE lacking = '') accepted FROM {twin('(SELECT ' + ', '.join(f'{e} AS {n}' for n, e in _FACTS) + ' FROM customer)', *_LAYERS)} r GROUP BY ALL")
def shadow_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding, unit, lane and acceptance of one snapshot in one projection; only the summary is shuffled."""
    df = tables(spark, sf_dir).customer.selectExpr(*(f"{e} AS {n}" for n, e in _FACTS))
    for layer in _LAYERS:
        df = layer.apply(df) if isinstance(layer, (L.Ladder, L.Ledger)) else L.derive(df, layer)
    return df.groupBy("status", "relationship", "lane", "subtype", "disposition", "operation").agg(F.count("*").alias("accounts"), F.count_if("eligible_for_value").alias("eligible"), F.count_if(F.col("lacking") == "").alias("accepted"))


def _lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables(spark, sf_dir).orders
    live = o.where("o_orderkey % 11 <> 0").selectExpr("o_orderkey", "o_orderstatus", "o_orderpriority", "CAST(o_orderdate AS STRING) AS stamp")
    wanted = o.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus", "o_orderpriority", "CASE WHEN o_orderkey % 13 = 0 THEN 'old' ELSE CAST(o_orderdate AS STRING) END AS stamp")
    return publish.staged(wanted, live, "o_orderkey", ["o_orderstatus", "o_orderpriority"], "stamp", canary=0.5)


@query("publish_lots", """
WITH s AS (SELECT CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'conflict' WHEN o_orderkey % 3 <> 1 OR o_orderstatus = 'X' THEN 'unchanged' ELSE 'sent' END lot FROM orders)
SELECT lot, count(*) "rows" FROM s GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM s""")
def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the sent rows are the canary is a hash of the key that only Spark has; tests look at it."""
    return publish.reconciled(_lots(spark, sf_dir).withColumn("lot", F.when(F.col("lot").isin("canary", "remaining"), "sent").otherwise(F.col("lot"))))


@query("publish_ledger", """
SELECT o_orderkey, o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS success, CASE WHEN o_orderkey % 5 = 0 THEN 'missing' WHEN o_orderkey % 7 = 0 THEN 'mismatch:o_orderpriority' ELSE '' END error FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 3 = 1 AND o_orderstatus <> 'X'""")
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _lots(spark, sf_dir).where("lot IN ('canary', 'remaining')")
    seen = sent.where("o_orderkey % 5 <> 0").withColumn("o_orderpriority", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'other' ELSE o_orderpriority END"))
    return publish.ledger(sent, seen, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("cohort_backtest", """
WITH t AS (SELECT o_orderpriority seg, CAST(o_totalprice AS DOUBLE) y, o_orderdate < timestamp '1996-06-01' AS train FROM orders), m AS (SELECT seg, median(y) p FROM t WHERE train GROUP BY 1 HAVING count(*) >= 8), w AS (SELECT median(y) p FROM t WHERE train), f AS (SELECT y actual, coalesce(m.p, (SELECT p FROM w)) pred FROM t LEFT JOIN m USING (seg) WHERE NOT train),
 e AS (SELECT actual, pred, CAST(pred AS DECIMAL(18,2)) - CAST(actual AS DECIMAL(18,2)) d FROM f)
SELECT count(*) n, CAST(sum(abs(d)) AS DOUBLE) / count(*) mae, median(CAST(abs(d) AS DOUBLE)) median_ae, CAST(sum(d) AS DOUBLE) / count(*) bias, median(CAST(d AS DOUBLE)) median_bias, count(*) FILTER (WHERE d > 0) / count(*) over_rate, count(*) FILTER (WHERE d < 0) / count(*) under_rate,
 count(*) FILTER (WHERE actual >= pred * 0.5 AND actual <= pred * 2) / count(*) coverage, count(*) FILTER (WHERE pred * 0.5 > pred * 2) violations FROM e""")
def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted before a date, judged after it."""
    rows = tables(spark, sf_dir).orders.select(F.col("o_orderpriority").alias("seg"), F.col("o_totalprice").cast("double").alias("y"), (F.col("o_orderdate") < F.expr("timestamp'1996-06-01'")).alias("train"))
    model = SparseMedian(cohortCol="seg", labelCol="y").fit(rows.where("train"))
    p, a = F.col("prediction"), F.col("y")
    return A.regression_report(model.transform(rows.where("NOT train")), [], a, p, p * 0.5, p * 2)


_CONTROLS = listed([
    {"control": c, "closing": n, "weak": w, "general": g, "affiliated": a, "is_law": law, "operator": o, "adjacent": k, "expected": e}
    for c, n, w, g, a, law, o, k, e in (
        ("focused firm", 2, 0, 0, False, True, 0, "", "real_estate_closing_focused"), ("broad firm", 1, 0, 3, False, True, 0, "", "general_practice_meaningful_re_closing_arm"), ("weak firm", 0, 1, 0, False, True, 0, "", "unclear_broad_practice"),
        ("affiliated firm", 0, 1, 0, True, True, 0, "", "affiliated_title_entity"), ("other firm", 0, 0, 2, False, True, 0, "", "non_closing_legal"), ("operator", 0, 0, 0, False, False, 2, "", "title_escrow_settlement_operator"), ("bank", 0, 0, 0, False, False, 0, "bank", "adjacent_bank"), ("unknown", 0, 0, 0, False, False, 0, "", "ambiguous"),
    )
], together=True)
_REST = tuple((n, "false") for n in ("attorney_state", "owned_direct", "underwriter", "brokerage_affiliation", "adjacent_site", "abstract", "title_wording"))


@query("external_controls", f"SELECT control, expected, subtype actual, expected = subtype AS passed FROM {twin(_CONTROLS.sql, _REST, L.LANE)} r")
def controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.LANE.apply(L.derive(_CONTROLS.frame(spark, sf_dir), _REST))
    return found.select("control", "expected", F.col("subtype").alias("actual"), (F.col("expected") == F.col("subtype")).alias("passed"))


_OFFICES = listed([
    {"page": p, "text": t}
    for p, t in (
        ("a", "Main office\n 12 Oak St \nReno,  Nevada 89501-1234\n\nPhone: (775) 555-0100\nElko NV 89801"), ("b", "no place here"), ("c", "See https://oak.com/locations/reno-north/ and https://oak.com/offices/contact/ and https://oak.com/locations/reno-north"), ("d", "NY 10001"), ("e", "* Suite 4 #\n- Phone 775-555-0100 Boise ID 83701\nhttp://x.y Boise Idaho 83702"),
    )
], together=True, key="page")


@query("office_evidence", rf"""
WITH l AS (SELECT page, text, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '^[ \-*#\t]+|[ \-*#\t]+$', '', 'g')) a FROM {_OFFICES.sql}),
 c AS (SELECT page, text, list_transform(list_filter(range(1, CAST(len(a) + 1 AS BIGINT)), lambda i: regexp_matches(a[i], '{P.ZIP_LINE}')), lambda i: trim(regexp_replace(regexp_replace(regexp_replace(array_to_string(list_filter(a[greatest(1, i - 2):i], lambda x: x <> ''), ' '), 'https?://\S+', '', 'g'), '(?i)\bPhone:?\s*[\d().\-\s]+', '', 'g'), '\s+', ' ', 'g'))) p FROM l),
 s AS (SELECT page, p, list_filter(list_transform(regexp_extract_all(text, '{P.LOCATION_URL}', 1), lambda x: regexp_replace(lower(x), '^-+|-+$', '', 'g')), lambda x: x <> '' AND x NOT IN ({", ".join(f"'{x}'" for x in P.PLAIN_SLUGS)})) g FROM c),
 f AS (SELECT page, list_sort(list_distinct(list_concat(list_transform(list_filter(p, lambda x: length(x) >= 12), lambda x: left(x, 140)), list_transform(g, lambda x: 'location page: ' || array_to_string(list_transform(string_split(x, '-'), lambda w: upper(left(w, 1)) || substr(w, 2)), ' '))))) o FROM s)
SELECT page, len(o) offices, array_to_string(o[:12], ' | ') evidence FROM f""")
def office_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.offices(F.col("text"))
    return _OFFICES.frame(spark, sf_dir).select("page", F.size(found).cast("long").alias("offices"), F.array_join(F.slice(found, 1, 12), " | ").alias("evidence"))
