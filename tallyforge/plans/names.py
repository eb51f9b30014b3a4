"""Searches for accounts, survivors of shared domains, and records held against their contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import searches as S
from tallyforge.operators import contracts as C
from tallyforge.operators import votes as V
from tallyforge.plans.catalog import query
from tallyforge.sources.tables import tables

#: A name, a state and a site of each customer, from what it is and orders; both engines read this text.
_ACCOUNTS = """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'A & B Title, L.L.C. ' WHEN 'FURNITURE' THEN 'Oak Law Firm PLLC dba Elm ' WHEN 'MACHINERY' THEN 'River  Bend Settlement Services Inc' WHEN 'HOUSEHOLD' THEN 'The Title Company' ELSE 'Smith and Sons ' || c_name END AS name,
 CASE WHEN c_acctbal < 0 THEN '' ELSE n_name END AS state, CASE WHEN c_acctbal > 6000 THEN 'https://www.abtitle.com/x' WHEN c_acctbal > 3000 THEN 'riverbend-' || c_nationkey || '.net' WHEN c_acctbal > 1000 THEN 'Longertitle.org' ELSE '' END AS site FROM customer JOIN nation ON n_nationkey = c_nationkey"""


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    t.customer.createOrReplaceTempView("customer")
    t.nation.createOrReplaceTempView("nation")
    return spark.sql(_ACCOUNTS)


_SP = lambda x: rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
_HOST = r"regexp_replace(regexp_extract(regexp_replace(lower(trim(site)), '^https?://', ''), '^([^/?#]*)', 1), '^www\.', '')"
_BY_HOST = "CASE WHEN h <> '' THEN '\"' || n || '\" \"' || h || '\" title settlement' END"
_SUFFIX = S.LEGAL_SUFFIX.replace("'", "''")
_PLAIN = rf"""left({_SP(rf"regexp_replace(replace(regexp_replace(regexp_replace(n, '(?i)\bd/?b/?a\b.*', '', 'g'), '{_SUFFIX}', ' ', 'g'), '&', ' and '), '[^A-Za-z0-9 ]+', ' ', 'g')")}, 50)"""
_WORDS = f"list_filter(regexp_extract_all(lower(p), '[a-z0-9]+'), lambda t: length(t) > 1 AND t NOT IN ({', '.join(map(repr, S.COMMON))}))"


@query("search_variants", rf"""
WITH a AS (SELECT c_custkey, {_SP('name')} n, {_SP('state')} s, {_HOST} h FROM ({_ACCOUNTS})), b AS (SELECT *, {_PLAIN} p, regexp_replace(string_split(h, '.')[1], '[^a-z0-9]+', '', 'g') l, regexp_extract(n, '\b([A-Za-z])\s*(?:and|&)\s*([A-Za-z])\b', 1) i, regexp_extract(n, '\b([A-Za-z])\s*(?:and|&)\s*([A-Za-z])\b', 2) j FROM a),
 c AS (SELECT *, {_WORDS} w, upper(regexp_extract(l, '^(.{{2,4}})title$', 1)) t, i <> '' AND contains(lower(n), 'title') AS ini FROM b),
 d AS (SELECT *, [p, CASE WHEN ini THEN upper(i || j) || ' Title' END, CASE WHEN ini THEN upper(i) || ' ' || upper(j) || ' Title' END, l, CASE WHEN t <> '' THEN t || ' Title' END, CASE WHEN t <> '' THEN array_to_string(string_split(t, ''), ' ') || ' Title' END,
  CASE WHEN len(w) > 0 AND contains(lower(p), 'title') THEN w[1] || ' Title' END, CASE WHEN len(w) >= 2 THEN w[1] || ' ' || w[2] WHEN length(w[1]) >= 3 THEN w[1] END, CASE WHEN len(w) > 0 AND contains(lower(p), 'law') THEN w[1] || ' Law' END] v FROM c),
 e AS (SELECT *, list_filter(list_transform(list_filter(v, lambda x: x IS NOT NULL), lambda x: {_SP("regexp_replace(x, '[^A-Za-z0-9 ]+', ' ', 'g')")}), lambda x: length(x) >= 3) k FROM d)
SELECT c_custkey, array_to_string(list_transform(list_filter(range(1, len(k) + 1), lambda q: NOT list_contains(list_transform(k[1:q - 1], lambda y: lower(y)), lower(k[q]))), lambda q: left(k[q], 50)), ' | ') names,
 array_to_string(list_filter([{", ".join(f"'\"' || n || '\" \"' || CASE WHEN s = '' THEN 'Virginia' ELSE s END || '\" {t}'" for t in S.SITE_TEMPLATES)}, {_BY_HOST}], lambda x: x IS NOT NULL), ' | ') searches,
 array_to_string(list_filter([CASE WHEN s <> '' THEN '"' || n || '" ' || s || ' official website' END, CASE WHEN s <> '' THEN '"' || n || '" ' || s || ' title escrow law website' END, '"' || n || '" official website', '"' || n || '" title escrow law firm website', CASE WHEN h <> '' THEN '"' || string_split(h, '.')[1] || '" "' || n || '"' END], lambda x: x IS NOT NULL), ' | ') sites FROM e""")
def search_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda c, n: F.array_join(c, " | ").alias(n)
    return _accounts(spark, sf_dir).select("c_custkey", joined(S.registry_names("name", "site"), "names"), joined(S.site_searches("name", "state", "site"), "searches"), joined(S.website_searches("name", "state", "site"), "sites"))


#: Customers of a nation and segment share a domain; a parent is the one with half the key, a suggestion the one before.
_SHARED = """SELECT 'd' || c_nationkey || substr(c_mktsegment, 1, 2) AS domain, CAST(c_custkey AS VARCHAR(20)) AS id, CASE WHEN c_acctbal > 7000 THEN CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS VARCHAR(20)) WHEN c_acctbal < -500 THEN CAST(CAST(floor(c_custkey / 100) AS BIGINT) * 100 + c_nationkey AS VARCHAR(20)) ELSE '' END AS parent,
 CASE WHEN c_acctbal < 3000 THEN CAST(c_custkey - 1 AS VARCHAR(20)) ELSE '' END AS suggested, CASE WHEN c_acctbal < 1500 THEN 'Medium' ELSE 'low' END AS confidence, c_acctbal > 4000 AS member, c_acctbal > 5000 AS bound, c_acctbal > 6000 AS named, c_acctbal > 8800 AS placed FROM customer"""


@query("shared_domain_votes", f"""
WITH r AS ({_SHARED}), v AS (SELECT domain, c, 2 * count(*) score FROM (SELECT domain, parent c FROM r UNION ALL SELECT domain, suggested FROM r WHERE confidence = 'Medium' AND suggested <> id) a WHERE c <> '' AND EXISTS (SELECT 1 FROM r WHERE r.domain = a.domain AND r.id = a.c) GROUP BY 1, 2),
 x AS (SELECT domain, c, score, coalesce(lead(score) OVER w, 0) AS runner FROM v WINDOW w AS (PARTITION BY domain ORDER BY score DESC) QUALIFY row_number() OVER w = 1),
 e AS (SELECT domain, id c, CASE WHEN member THEN 10 ELSE 0 END + CASE WHEN bound THEN 10 ELSE 0 END + CASE WHEN named THEN 10 ELSE 0 END + CASE WHEN placed THEN 20 ELSE 0 END score FROM r), y AS (SELECT domain, c, score, coalesce(lead(score) OVER w, 0) AS runner FROM e WHERE score > 0 WINDOW w AS (PARTITION BY domain ORDER BY score DESC) QUALIFY row_number() OVER w = 1)
SELECT d.domain, CASE WHEN x.score > x.runner THEN x.c WHEN y.score >= 30 AND y.score - y.runner >= 20 THEN y.c ELSE '' END survivor, CASE WHEN x.score > x.runner THEN 'resolved_parent_child_or_suggested_survivor' WHEN y.score >= 30 AND y.score - y.runner >= 20 THEN 'resolved_unique_entity_location_identity' ELSE 'unresolved_shared_domain' END how
FROM (SELECT DISTINCT domain FROM r) d LEFT JOIN x USING (domain) LEFT JOIN y USING (domain)""")
def shared_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables(spark, sf_dir).customer.createOrReplaceTempView("customer")
    return V.shared_survivors(spark.sql(_SHARED))


_RECORDS = """SELECT CAST(o_orderkey AS VARCHAR(20)) AS account_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'bound' WHEN '2-HIGH' THEN 'mismatch' WHEN '3-MEDIUM' THEN 'no_website' WHEN '5-LOW' THEN 'lost' ELSE 'ambiguous' END AS binding_status, CASE o_orderstatus WHEN 'F' THEN 'net_new' WHEN 'O' THEN 'winback' END AS lifecycle, 'legal' AS lane,
 CASE WHEN o_orderstatus = 'F' THEN 'publish_value' ELSE 'no_change' END AS operation, CASE WHEN o_totalprice > 60000 THEN CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END WHEN o_totalprice > 50000 THEN 'maybe' ELSE 'true' END AS accepted,
 CASE WHEN o_totalprice > 90000 THEN o_totalprice END AS point, o_totalprice / 2 AS low, CASE WHEN o_totalprice > 300000 THEN o_totalprice / 4 ELSE o_totalprice * 2 END AS high, 'High' AS confidence FROM orders"""


@query("contract_violations", f"""
WITH r AS ({_RECORDS}), t AS (SELECT * REPLACE (TRY_CAST(accepted AS BOOLEAN) AS accepted), accepted raw FROM r)
SELECT account_id, array_to_string(list_sort(list_filter([CASE WHEN accepted IS NULL THEN 'type:accepted' END, CASE WHEN lifecycle IS NULL THEN 'missing:lifecycle' END, CASE WHEN binding_status = 'lost' THEN 'value:binding_status' END, CASE WHEN accepted AND point IS NULL THEN 'rule:accepted_has_value' END,
 CASE WHEN NOT (low <= point AND point <= high) THEN 'rule:interval' END, CASE WHEN accepted <> (operation = 'publish_value') THEN 'rule:accepted_publishes' END], lambda x: x IS NOT NULL)), '; ') violations FROM t""")
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as decisions, some with values and types that the contract doesn't have."""
    tables(spark, sf_dir).orders.createOrReplaceTempView("orders")
    return C.DECISIONS.conform(spark.sql(_RECORDS)).select("account_id", F.array_join("violations", "; ").alias("violations"))
