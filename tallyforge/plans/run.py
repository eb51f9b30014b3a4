"""A whole run over customers, orders, events, suppliers and pages: facts derived from the tables, decisions, queues, rollups and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import entity as E
from tallyforge.functions import text as X
from tallyforge.operators import ladders as L
from tallyforge.operators.runs import Gate, Run, Stage
from tallyforge.plans.catalog import query
from tallyforge.plans.entities import DOMAIN_SCORE, SIMILARITY, core_sql, identity_sql
from tallyforge.plans.fixtures import twin
from tallyforge.plans.text_queries import HOST_SQL
from tallyforge.sources.scratch import scratch
from tallyforge.sources.tables import tables

#: What orders and events say of an account, one row each.
_HISTORY = """SELECT o_custkey AS k, count(*) AS n_orders, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS filled, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS partial, count(DISTINCT o_orderpriority) AS kinds, max(o_orderdate) AS last_order,
 min(o_orderpriority) AS first_kind, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS most, min(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS least FROM orders GROUP BY o_custkey"""
_SEEN = "SELECT user_id AS k, count(CASE WHEN event_type = 'signup' THEN 1 END) AS signups, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases, count(CASE WHEN event_type = 'error' THEN 1 END) AS errors, max(ts) AS last_seen FROM events GROUP BY user_id"
_REGISTRY = "SELECT s_nationkey AS nation, floor(s_acctbal / 1000) AS band, count(*) AS n FROM supplier GROUP BY s_nationkey, floor(s_acctbal / 1000)"

#: The columns that the decision ladders ask for, from an account's own row, its history, its site and its registry entry.
_FACTS = (
    ("id", "CAST(c_custkey AS VARCHAR(20))"), ("has_site", "host IS NOT NULL"), ("registrable", "coalesce(domain, '') <> ''"), ("directory", "false"), ("generic", "coalesce(host_size, 0) > 8"), ("hygiene_bad", "coalesce(title, '') = ''"),
    ("country_conflict", "site_lang = 'es' AND n_regionkey = 4"), ("state_conflict", "site_lang = 'fr' AND n_regionkey = 1"), ("geo_match", "site_lang = CASE n_regionkey WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' WHEN 3 THEN 'es' ELSE 'en' END"), ("geo_conflict", "site_lang IS NOT NULL AND NOT geo_match"),
    ("phone_match", "coalesce(signups, 0) > 0"), ("phone_conflict", "coalesce(errors, 0) > coalesce(purchases, 0) + 2"), ("address_match", "registered > 0"), ("registry_match", "registered > 1"),
    ("entity_class", "CASE c_mktsegment WHEN 'BUILDING' THEN 'title_escrow' WHEN 'FURNITURE' THEN 'legal' WHEN 'MACHINERY' THEN 'organization' WHEN 'HOUSEHOLD' THEN 'mortgage_lender' ELSE 'title_escrow' END"), ("crm_class", "CASE WHEN first_kind = '1-URGENT' THEN 'title_escrow' WHEN first_kind = '2-HIGH' THEN 'legal' WHEN first_kind = '3-MEDIUM' THEN 'bank_credit_union' ELSE '' END"),
    ("has_names", "coalesce(name, '') <> ''"), ("has_addresses", "registered > 0"), ("has_phones", "coalesce(signups, 0) > 0"), ("member_confirmed", "coalesce(purchases, 0) >= 3"),
    ("active_flag", "partial > 4 AND c_acctbal > 5000"), ("inactive_flag", "coalesce(partial, 0) < 5"), ("revenue", "CASE WHEN filled > 9 THEN 1.5 ELSE 0.0 END"), ("status_text", "CASE WHEN last_order < timestamp '1997-06-01' THEN 'former customer' ELSE '' END"), ("account_type", "CASE WHEN c_acctbal > 9500 THEN 'partner' ELSE 'prospect' END"), ("company_type", "CASE WHEN c_acctbal < -900 THEN 'government' ELSE 'title' END"),
    ("survivor", "CASE WHEN same_name > 1 THEN CAST(name_first AS VARCHAR(20)) ELSE '' END"), ("loser", "true"), ("duplicate_high", "false"), ("owned_direct", "false"), ("owned_parent", "''"), ("dba_parent", "''"), ("branch_parent", "''"), ("parent", "''"), ("hint", "CASE WHEN c_acctbal < 0 THEN 'branch' ELSE '' END"), ("independent", "c_acctbal < -400"), ("central", "false"),
    ("domain_customers", "false"), ("shared_domain", "false"), ("cluster_size", "CAST(CASE WHEN n_regionkey = 0 THEN coalesce(domain_size, 0) WHEN coalesce(host_size, 0) > 4 THEN 2 ELSE 1 END AS INT)"), ("has_members", "false"),
    ("is_law", "c_mktsegment = 'FURNITURE'"), ("affiliated", "coalesce(partial, 0) > 1"), ("closing", "CAST(least(3, coalesce(filled, 0)) AS INT)"), ("weak", "CAST(least(1, coalesce(partial, 0)) AS INT)"), ("general", "CAST(coalesce(kinds, 0) AS INT)"), ("attorney_state", "n_regionkey < 2"), ("underwriter", "c_acctbal > 9800"), ("brokerage_affiliation", "false"), ("operator", "CAST(least(4, coalesce(filled, 0)) AS INT)"), ("adjacent", "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'lender' ELSE '' END"), ("adjacent_site", "host IS NOT NULL"), ("abstract", "coalesce(kinds, 0) = 1"), ("title_wording", "coalesce(filled, 0) > 0"),
    ("evidence_confidence", "CASE WHEN coalesce(n_html, 0) > 1000 THEN 'High' ELSE 'Medium' END"), ("pages", "CAST(CASE WHEN host IS NULL THEN 0 ELSE 1 END AS INT)"), ("evidence_hash", "coalesce(html_hash, '')"), ("point", "CAST((most + least) / 2 AS DOUBLE)"), ("low", "CAST(least AS DOUBLE)"), ("high", "CAST(most AS DOUBLE)"), ("value_confidence", "CASE WHEN filled >= 3 THEN 'High' ELSE 'Low' END"), ("arr_point", "CAST(c_acctbal AS DOUBLE)"), ("comparables", "CAST(coalesce(n_orders, 0) AS INT)"), ("provisional", "coalesce(n_orders, 0) < 2"),
)
_LAYERS = (L.BINDING_FACTS, L.BINDING, (("binding_status", "status"), ("binding_confidence", "confidence")), L.LIFECYCLE, L.RELATION, L.UNIT, (("unit_eligible", "eligible"),), L.LANE, L.LANE_ELIGIBLE, L.ACCEPTANCE, L.DISPOSITION)
_GATES = [
    Gate("id_reconciliation", "accounts = decided AND accounts = distinct_ids"), Gate("no_active_customer_accepted", "active_accepted = 0"), Gate("no_loser_accepted", "loser_accepted = 0"), Gate("accepted_value_inside_interval", "interval_violations = 0"), Gate("no_law_firm_outside_its_lane", "law_outside = 0"),
    Gate("some_accepted", "accepted > 0"), Gate("canary_25_to_50", "accepted BETWEEN 25 AND 50"), Gate("membership_never_sole_proof", "sole_member = 0"), Gate("review_below_half", "2 * review < accounts"), Gate("audited_precision", "audited_good >= 0.9 * audited", "audited >= 30"),
]
_FIGURES = (
    "count(*) AS decided", "count(DISTINCT id) AS distinct_ids", "count(CASE WHEN lacking = '' THEN 1 END) AS accepted", "count(CASE WHEN lacking = '' AND lifecycle = 'active_customer' THEN 1 END) AS active_accepted", "count(CASE WHEN lacking = '' AND surviving_id <> id THEN 1 END) AS loser_accepted",
    "count(CASE WHEN lacking = '' AND NOT (low <= point AND point <= high) THEN 1 END) AS interval_violations", "count(CASE WHEN is_law AND lane NOT IN ('legal', 'review') THEN 1 END) AS law_outside", "count(CASE WHEN status = 'bound' AND member_confirmed AND proofs = 0 THEN 1 END) AS sole_member", "count(CASE WHEN disposition = 'review' THEN 1 END) AS review",
    "count(CASE WHEN lacking = '' THEN quality END) AS audited", "count(CASE WHEN lacking = '' AND quality = 1 THEN 1 END) AS audited_good",
)


def _snapshot(t: tables) -> DataFrame:
    """One row for each account with its history, its site and its registry entry: each side is one row for a key before it is joined."""
    for name in ("orders", "events", "supplier"):
        getattr(t, name).createOrReplaceTempView(name)
    sql = t.spark.sql
    p = t.pages.select(F.col("page_id").alias("k"), X.host("url").alias("host"), X.html_title("html").alias("title"), F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("site_lang"), F.length("html").alias("n_html"), F.sha2("html", 256).alias("html_hash"))
    p = p.withColumn("domain", X.registered_domain("host")).withColumn("label", F.substring_index("domain", ".", 1))
    words = F.slice(F.split("title", " "), 1, 3)
    named = p.select(F.col("k"), F.array_join(words, " ").alias("name"))
    own = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey", "n_regionkey")
    h = sql(_HISTORY)
    df = own.join(h, F.col("c_custkey") == F.col("k"), "left").drop("k").join(sql(_SEEN), F.col("c_custkey") == F.col("k"), "left").drop("k").join(p, F.col("c_custkey") == F.col("k"), "left").drop("k")
    # an account of many orders is known by its neighbour's name: its site has changed hands
    source = F.when(F.coalesce("n_orders", F.lit(0)) > 12, F.col("c_custkey") + 1).otherwise(F.col("c_custkey"))
    df = df.withColumn("_named", source).join(named, F.col("_named") == F.col("k"), "left").drop("k", "_named")
    registry = sql(_REGISTRY).withColumnRenamed("n", "registered")
    df = df.join(registry, (F.col("c_nationkey") == F.col("nation")) & (F.floor(F.col("c_acctbal") / 1000) == F.col("band")), "left").drop("nation", "band")
    df = df.withColumn("registered", F.coalesce("registered", F.lit(0)))
    for key, size, first in (("host", "host_size", None), ("domain", "domain_size", None), ("name", "same_name", "name_first")):
        own = df.where(F.coalesce(key, F.lit("")) != "").groupBy(key).agg(F.count("*").alias(size), *([F.min("c_custkey").alias(first)] if first else []))
        df = df.join(own, key, "left")
    return df.withColumns({"name_score": E.name_similarity(F.coalesce("name", F.lit("")), F.coalesce("title", F.lit(""))), "domain_score": E.domain_similarity(F.array(F.coalesce("name", F.lit(""))), F.coalesce("label", F.lit(""))), "age_days": F.datediff(F.lit("2024-02-10"), F.to_date("last_seen")).cast("double")})


def _decided(snapshot: DataFrame) -> DataFrame:
    kept = ("name", "title", "host", "html_hash", "last_order", "name_score", "domain_score", "age_days")
    df = L.derive(snapshot, _FACTS).select(*kept, *(n for n, _ in _FACTS))
    for layer in _LAYERS:
        df = layer.apply(df) if isinstance(layer, (L.Ladder, L.Ledger)) else L.derive(df, layer)
    return df


def _rollups(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("surviving_id").agg(F.count("*").alias("members"), F.count_if(F.col("lacking") == "").alias("accepted"))


def _queue(name: str, when: str) -> Stage:
    return Stage(name, ("decisions",), lambda d: d.where(when).select("id", "name", "host", "status", "lane", "lacking", "disposition", "operation", "point", "low", "high"))


_QUEUES = {"accepted": "lacking = ''", "review_queue": "disposition = 'review'", "no_change_queue": "disposition NOT IN ('accepted', 'review')"}


def whole(spark: SparkSession, sf_dir: str, folder: str) -> Run:
    t = tables(spark, sf_dir)
    t.spark = spark

    def figures(snapshot: DataFrame, decisions: DataFrame) -> DataFrame:
        judged = decisions.join(t.labels.select(F.col("doc_id").cast("string").alias("id"), "quality"), "id", "left").selectExpr(*_FIGURES)
        return judged.join(snapshot.agg(F.count("*").alias("accounts")))  # a row each

    stages = [Stage("snapshot", (), lambda: _snapshot(t), artifact=False), Stage("decisions", ("snapshot",), _decided), Stage("rollups", ("decisions",), _rollups), *(_queue(n, w) for n, w in _QUEUES.items())]
    return Run(spark, folder, stages, _GATES, figures, ("snapshot", "decisions"))


_TITLE = r"""trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))"""
_PAGES = f"""SELECT k, host, title, site_lang, n_html, html_hash, CASE WHEN len(l) < 2 THEN '' WHEN len(l) >= 3 AND array_to_string(l[-2:], '.') IN ('co.uk','org.uk','ac.uk','gov.uk','com.au','net.au','org.au','co.nz','org.nz') THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain
 FROM (SELECT *, string_split(host, '.') l FROM (SELECT page_id k, {HOST_SQL} host, {_TITLE} title, regexp_extract(html, '<html lang="([a-z]+)"', 1) site_lang, length(html) n_html, sha256(html) html_hash FROM pages))"""
_JOINED = f"""SELECT c_custkey, c_acctbal, c_mktsegment, n_regionkey, h.* EXCLUDE (k), e.* EXCLUDE (k), p.* EXCLUDE (k), coalesce(r.n, 0) registered, array_to_string(string_split(w.title, ' ')[:3], ' ') AS name, string_split(p.domain, '.')[1] AS label, CAST(date_diff('day', CAST(last_seen AS DATE), DATE '2024-02-10') AS DOUBLE) age_days
 FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN ({_HISTORY}) h ON h.k = c_custkey LEFT JOIN ({_SEEN}) e ON e.k = c_custkey LEFT JOIN ({_PAGES}) p ON p.k = c_custkey LEFT JOIN ({_PAGES}) w ON w.k = c_custkey + CASE WHEN coalesce(n_orders, 0) > 12 THEN 1 ELSE 0 END
 LEFT JOIN ({_REGISTRY}) r ON nation = c_nationkey AND band = floor(c_acctbal / 1000)"""
_SIZED = f"""(SELECT *, count(*) OVER (PARTITION BY host) host_size, count(*) OVER (PARTITION BY domain) domain_size, count(*) OVER (PARTITION BY name) same_name, min(c_custkey) OVER (PARTITION BY name) name_first, {SIMILARITY} name_score, coalesce({DOMAIN_SCORE}, 0.0) domain_score
 FROM (SELECT *, len(list_intersect(p, q)) h FROM (SELECT * REPLACE (coalesce(name, '') AS name, coalesce(label, '') AS label, host AS host), {identity_sql("coalesce(name, '')")} x, {identity_sql("coalesce(title, '')")} y, {core_sql("coalesce(name, '')")} p, {core_sql("coalesce(title, '')")} q FROM ({_JOINED}))))"""
_CLEARED = f"(SELECT * REPLACE (CASE WHEN coalesce(host, '') = '' THEN NULL ELSE host_size END AS host_size, CASE WHEN coalesce(domain, '') = '' THEN NULL ELSE domain_size END AS domain_size, CASE WHEN name = '' THEN NULL ELSE same_name END AS same_name) FROM {_SIZED})"
_DECISIONS = twin(_CLEARED, _FACTS, *_LAYERS)
_COUNTS = " UNION ALL ".join([f"SELECT '{n}' AS name, (SELECT count(*) FROM d WHERE {w}) AS n" for n, w in {"snapshot": "true", "decisions": "true", **_QUEUES}.items()] + ["SELECT 'rollups', (SELECT count(DISTINCT surviving_id) FROM d)"])
_GATE_ROWS = " UNION ALL ".join(f"SELECT '{g.name}' AS name, CASE WHEN NOT coalesce({g.known}, false) THEN 'PENDING' WHEN {g.passes} THEN 'PASS' ELSE 'FAIL' END AS state FROM f" for g in _GATES)


@query("whole_run", f"""
WITH d AS MATERIALIZED {_DECISIONS[:-1]}), f AS (SELECT {", ".join(_FIGURES)}, (SELECT count(*) FROM customer) AS accounts FROM d LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) k, quality FROM labels) ON k = id)
SELECT 'stage' AS kind, name, n AS rows_made, '' AS state FROM ({_COUNTS}) UNION ALL SELECT 'gate', name, CAST(NULL AS BIGINT), state FROM ({_GATE_ROWS})""")
def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each stage, and the gates, read back from a run's folder."""
    run = whole(spark, sf_dir, scratch(spark))
    run.go()
    out = run.table("gates").select(F.lit("gate").alias("kind"), F.col("gate").alias("name"), F.lit(None).cast("long").alias("rows_made"), "state")
    for name in run.stages:
        if name != "gates":
            out = out.unionByName(run.table(name).agg(F.lit("stage").alias("kind"), F.lit(name).alias("name"), F.count("*").alias("rows_made"), F.lit("").alias("state")))
    return out


@query("whole_run_decisions", f"SELECT id, status, confidence, relation, lifecycle, lane, subtype, lacking, disposition, operation, surviving_id FROM {_DECISIONS} d")
def whole_run_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = whole(spark, sf_dir, scratch(spark))
    run.go()
    return run.table("decisions").select("id", "status", "confidence", "relation", "lifecycle", "lane", "subtype", "lacking", "disposition", "operation", "surviving_id")
