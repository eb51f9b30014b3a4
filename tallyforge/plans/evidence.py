"""Offices, staff and features that pages say of accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import pages as P
from tallyforge.operators import features as X
from tallyforge.plans.catalog import query
from tallyforge.sources.tables import tables

_WORD = lambda n: f"CASE {n} WHEN 0 THEN 'Zeroe' WHEN 1 THEN 'Onera' WHEN 2 THEN 'Twain' WHEN 3 THEN 'Thresa' WHEN 4 THEN 'Forrest' WHEN 5 THEN 'Fiver' ELSE 'Sixtus' END"
_NL = "chr(10)"
#: An account's pages from the pages table and what customers with their numbers are: contact lines, people and services by segment, nation and balance.  Both engines read this text.
PAGES = f"""SELECT 'a' || CAST(CAST(floor(page_id / 6) AS INT) AS VARCHAR(20)) AS account, page_id, url || CASE WHEN c_acctbal > 7000 THEN '/contact/' WHEN c_acctbal > 5500 THEN '/team/' WHEN c_acctbal > 4500 THEN '/offices' ELSE '/' || CAST(page_id AS VARCHAR(20)) END AS url,
 CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 3000 THEN 'Testimonials' ELSE 'Welcome' END AS title, '2024-01-0' || CAST(c_nationkey % 9 + 1 AS VARCHAR(20)) AS observed,
 '# Welcome to our firm' || {_NL} || CASE WHEN c_mktsegment = 'BUILDING' THEN '**Visit us** at our main office' WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 2000 THEN 'near the county courthouse' WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 1000 THEN 'We list counties served and service areas' WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0 THEN 'open house, property listing' ELSE 'Thank you' END
  || {_NL} || CAST(100 + CAST(floor(page_id / 12) AS INT) AS VARCHAR(20)) || ' North ' || {_WORD("c_nationkey % 3")} || CASE WHEN c_acctbal > 2500 THEN ' Street' ELSE ' St.' END || CASE WHEN c_nationkey % 5 = 0 THEN ', Suite ' || CAST(c_nationkey AS VARCHAR(20)) ELSE '' END || ','
  || {_NL} || {_WORD("c_nationkey % 3")} || ' Falls, TX ' || CAST(75000 + c_nationkey % 3 AS VARCHAR(20)) || CASE WHEN c_nationkey % 2 = 0 THEN '-1234' ELSE '' END || {_NL} || {_NL} || 'Our people' || {_NL}
  || {_WORD("c_nationkey % 7")} || ' ' || {_WORD("CAST(floor(page_id / 6) AS INT) % 4")} || CASE WHEN c_acctbal > 8000 THEN ' | Escrow Officer' WHEN c_acctbal > 6500 THEN ' - Attorney at Law' WHEN c_acctbal > 5000 THEN CASE WHEN c_nationkey % 2 = 0 THEN ', President of the firm' ELSE ', Founder and President' END WHEN c_acctbal > 3500 THEN ': Cook' ELSE '' END
  || {_NL} || CASE WHEN c_acctbal < 2000 THEN 'led by the owner' ELSE 'and' END || {_NL} || 'Title {{x}}' || {_NL} || CASE WHEN c_acctbal > 6000 THEN 'We offer title insurance and escrow services with a client portal' WHEN c_acctbal > 2000 THEN 'Real Estate Closings, refinance closing, rate calculator' WHEN c_acctbal > 0 THEN 'abstract search' ELSE '' END AS text,
 c_acctbal, c_nationkey FROM pages JOIN customer ON c_custkey = page_id"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    t.pages.select("page_id", "url").createOrReplaceTempView("pages")
    t.customer.createOrReplaceTempView("customer")
    return spark.sql(PAGES)


_BARE = lambda x: rf"trim(regexp_replace(regexp_replace({x}, '^[\s>*#_`~-]+|[\s*_`~-]+$', '', 'g'), '\s+', ' ', 'g'))"
_Q = lambda p: "'" + p.replace("'", "''") + "'"
_KEY = "lower(display)"
for _long, _short in (("street", "st"), ("avenue", "ave"), ("road", "rd"), ("boulevard", "blvd"), ("drive", "dr"), ("lane", "ln"), ("court", "ct"), ("parkway", "pkwy"), ("highway", "hwy")):
    _KEY = rf"regexp_replace({_KEY}, '\b{_long}\b', '{_short}', 'g')"
_KEY = rf"trim(regexp_replace(regexp_replace(regexp_replace({_KEY}, '\b(suite|ste\.?|unit)\b', 'suite', 'g'), '(\d{{5}})-\d{{4}}\b', '\1', 'g'), '[^a-z0-9]+', ' ', 'g'))"
_LINES = f"s AS (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_BARE('x')}), lambda x: x <> '') l, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM ({PAGES}))"
_REASON = "CASE " + " ".join(f"WHEN regexp_matches(w, {_Q(p)}) THEN '{n}'" for n, p in X.NOT_OFFICE) + f" WHEN regexp_matches(path, {_Q(X.BIO_PATH)}) THEN 'attorney_bio' ELSE '' END"
_FOUND = rf"""{_LINES}, i AS (SELECT *, unnest(range(1, CAST(len(l) + 1 AS BIGINT))) k FROM s), a AS (SELECT *, array_to_string(l[greatest(1, k - 2):k + 2], ' ') near, unnest(regexp_extract_all(replace(array_to_string(l[k:k + 2], ' '), '.', ''), {_Q(X.ADDRESS)})) raw FROM i),
 b AS (SELECT *, regexp_replace(trim(regexp_replace(raw, '\s+', ' ', 'g')), '^[ ,]+|[ ,]+$', '', 'g') display, concat_ws(' ', title, url, near) w FROM a), o AS (SELECT account, lower(url) page, {_KEY} address, display, url, observed, {_BARE('near')}[:280] excerpt, {_REASON} reason, regexp_matches(path, {_Q(X.OFFICE_PATH)}) OR regexp_matches(near, {_Q(X.OFFICE_WORDS)}) supportive, title, k FROM b QUALIFY row_number() OVER (PARTITION BY account, lower(url), {_KEY} ORDER BY observed, title, k) = 1),
 c AS (SELECT account, address, arg_min(display, (page, observed, title, k)) display, count(DISTINCT page) pages, count(*) FILTER (WHERE reason = '') f, count(DISTINCT page) FILTER (WHERE reason = '' AND supportive) g, coalesce(string_agg(DISTINCT reason, '; ' ORDER BY reason) FILTER (WHERE reason <> ''), '') why FROM o GROUP BY 1, 2),
 e AS (SELECT account, address, display, pages, CASE WHEN g > 0 THEN 'verified' WHEN f > 0 AND pages < 3 THEN 'uncertain' ELSE 'excluded' END status, CASE WHEN g >= 2 THEN 0.97 WHEN g = 1 THEN 0.9 WHEN f > 0 AND pages >= 3 THEN 0.92 WHEN f > 0 THEN 0.55 ELSE 0.96 END::DOUBLE confidence,
  CASE WHEN g >= 2 THEN 'operating_office_corroborated' WHEN g = 1 THEN 'operating_office_page' WHEN f > 0 AND pages >= 3 THEN 'repeated_footer_without_office_context' WHEN f > 0 THEN 'address_without_operating_office_context' ELSE why END reasons FROM c)"""
_ROLE = lambda p: f"role <> '' AND regexp_matches(role, {_Q(p)})"
_PEOPLE = rf"""pi AS (SELECT *, unnest(range(1, CAST(len(l) + 1 AS BIGINT))) k FROM s), pa AS (SELECT *, array_to_string(l[greatest(1, k - 1):k + 1], ' ') near, trim(regexp_extract(l[k], {_Q(X.PERSON)}, 1)) display, trim(regexp_extract(l[k], {_Q(X.PERSON)}, 2)) AS role FROM pi WHERE length(l[k]) <= 120 AND regexp_matches(l[k], {_Q(X.PERSON)})),
 pb AS (SELECT account, trim(regexp_replace(lower(display), '[^a-z]+', ' ', 'g')) person, display, role, lower(url) page, url, observed, {_BARE('near')}[:280] excerpt, title, k, CASE WHEN regexp_matches(concat_ws(' ', title, url, near), {_Q(X.NOT_STAFF)}) THEN 4 WHEN {_ROLE(X.OPERATIONAL)} THEN 0 WHEN {_ROLE(X.LEGAL)} THEN 1 WHEN {_ROLE(X.GENERIC)} THEN 2 ELSE 3 END kind FROM pa WHERE len(list_intersect(string_split_regex(lower(display), '\s+'), [{", ".join(map(_Q, X.NO_NAME))}])) = 0),
 pc AS (SELECT *, count(DISTINCT page) OVER (PARTITION BY account, person) pages, row_number() OVER (PARTITION BY account, person ORDER BY kind, role DESC, page, observed, title, k) r FROM pb), pd AS (SELECT account, person, display, role, CASE kind {" ".join(f"WHEN {k} THEN '{n}'" for k, (n, _) in enumerate(X.KINDS))} END category, CASE kind {" ".join(f"WHEN {k} THEN {c}" for k, (_, c) in enumerate(X.KINDS))} END::DOUBLE confidence, (SELECT count(DISTINCT page) FROM pb y WHERE y.account = pc.account AND y.person = pc.person) pages FROM pc WHERE r = 1)"""
_PEOPLE = _PEOPLE.replace("count(DISTINCT page) OVER (PARTITION BY account, person) pages, ", "")


def _said(words: dict[str, str]) -> str:
    one = lambda n, p: f"SELECT account, '{n}' signal, url, observed, {_BARE('substr(text, greatest(1, instr(text, m) - 90), instr(text, m) - 1 + length(m) + 120 - greatest(1, instr(text, m) - 90) + 1)')}[:280] excerpt FROM (SELECT *, regexp_extract(text, {_Q('(?i)' + p)}) m FROM s) WHERE m <> ''"
    return " UNION ALL ".join(one(n, p) for n, p in words.items())


@query("office_candidates", f"WITH {_FOUND} SELECT account, address, display, status, confidence, reasons, pages FROM e")
def office_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with the pages that support them: an address on every page is no office unless some page says so."""
    return X.offices(X.office_occurrences(_pages(spark, sf_dir)))


@query("staff_candidates", f"WITH {_LINES}, {_PEOPLE} SELECT account, person, display, role, category, confidence, pages FROM pd")
def staff_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.staff(X.staff_occurrences(_pages(spark, sf_dir)))


_NONE = "CAST([] AS VARCHAR[])"


@query("entity_safe_features", f"""
WITH {_FOUND}, {_PEOPLE}, sv AS ({_said(X.SERVICES)}), tl AS ({_said(X.TOOLS)}), ci AS (SELECT account, count(*) n FROM (SELECT account, url, observed, excerpt FROM o UNION SELECT account, url, observed, excerpt FROM pb UNION SELECT account, url, observed, excerpt FROM sv UNION SELECT account, url, observed, excerpt FROM tl) GROUP BY 1),
 ac AS (SELECT account, max(c_acctbal) > 7500 strong, CAST(count(*) AS INT) * 2 links, count(DISTINCT lower(regexp_replace(path, '/+$', ''))) paths FROM s GROUP BY 1),
 oc AS (SELECT account, count(*) FILTER (WHERE status = 'verified') v, count(*) FILTER (WHERE status = 'uncertain') u, count(*) FILTER (WHERE status = 'verified' AND pages >= 2) c, list_distinct(flatten(list(string_split(reasons, '; ')) FILTER (WHERE status <> 'verified'))) why FROM e GROUP BY 1),
 sc AS (SELECT account, count(*) FILTER (WHERE category = 'relevant_operational') r, count(*) FILTER (WHERE category = 'unverified_name') u, count(*) FILTER (WHERE category LIKE 'legal%') g, count(*) FILTER (WHERE category LIKE 'generic%') n, count(*) FILTER (WHERE category = 'excluded_context') x FROM pd GROUP BY 1),
 j AS (SELECT ac.account, strong, CASE WHEN links >= 20 OR paths >= 6 THEN 'high' WHEN links >= 6 OR paths >= 3 THEN 'medium' ELSE 'low' END sophistication, coalesce(oc.v, 0) v, coalesce(oc.u, 0) u, coalesce(oc.c, 0) c, coalesce(why, {_NONE}) why, coalesce(sc.r, 0) r, coalesce(sc.u, 0) su, coalesce(g, 0) g, coalesce(sc.n, 0) gn, coalesce(x, 0) x, coalesce(ci.n, 0) cited,
  coalesce((SELECT list_sort(list(DISTINCT signal)) FROM sv WHERE sv.account = ac.account), {_NONE}) services, coalesce((SELECT list_sort(list(DISTINCT signal)) FROM tl WHERE tl.account = ac.account), {_NONE}) tools FROM ac LEFT JOIN oc USING (account) LEFT JOIN sc USING (account) LEFT JOIN ci USING (account))
SELECT account, CASE WHEN strong THEN v ELSE 0 END offices, CASE WHEN strong THEN v ELSE 0 END offices_low, CASE WHEN strong THEN v + u ELSE 0 END offices_high, CASE WHEN strong THEN r ELSE 0 END staff, CASE WHEN strong THEN r + su ELSE 0 END staff_high, CASE WHEN strong THEN array_to_string(services, '; ') ELSE '' END services, CASE WHEN strong THEN array_to_string(tools, '; ') ELSE '' END tools, sophistication,
 CASE WHEN NOT strong THEN 'Low' WHEN v + r + len(services) + c + CASE sophistication WHEN 'high' THEN 1 ELSE 0 END >= 5 AND cited >= 3 THEN 'High' WHEN v + r + len(services) + c + CASE sophistication WHEN 'high' THEN 1 ELSE 0 END >= 2 THEN 'Medium' ELSE 'Low' END confidence,
 array_to_string(list_sort(list_distinct(list_concat(why, list_filter([CASE WHEN g > 0 THEN 'attorneys_not_counted_as_operational_staff' END, CASE WHEN gn > 0 THEN 'generic_roles_not_counted_as_operational_staff' END, CASE WHEN x > 0 THEN 'testimonial_or_listing_names_excluded' END, CASE WHEN NOT strong THEN 'upstream_identity_or_sellable_gate_not_strong' END], lambda y: y IS NOT NULL)))), '; ') codes FROM j""")
def entity_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pages(spark, sf_dir)
    accounts = p.groupBy("account").agg((F.max("c_acctbal") > 7500).alias("strong"), (F.count("*").cast("int") * 2).alias("links"))
    return X.entity_safe(p, accounts)


_ROLES = P.STAFF_ROLES


@query("visible_staff", rf"""
WITH s AS (SELECT page_id, string_split(text, chr(10)) l FROM ({PAGES})), i AS (SELECT page_id, l, unnest(range(1, CAST(len(l) + 1 AS BIGINT))) k FROM s),
 c AS (SELECT *, regexp_replace(regexp_replace(l[k], '\s+', ' ', 'g'), '^[ \-*#\t]+|[ \-*#\t]+$', '', 'g') line FROM i), w AS (SELECT *, trim(regexp_replace(lower(line), '[^a-z ]', '', 'g')) low FROM c WHERE line <> '' AND length(line) <= 80),
 n AS (SELECT page_id, trim(regexp_replace(line, ',.*$', '')) AS name FROM w WHERE len(list_filter(string_split_regex(low, ' +'), lambda x: x <> '')) BETWEEN 2 AND 4 AND len(list_intersect(string_split_regex(low, ' +'), [{", ".join(map(_Q, P.NO_STAFF))}])) = 0 AND NOT regexp_matches(low, 'street|suite|phone|fax|email|copyright') AND regexp_matches(array_to_string(l[greatest(1, k - 2):k + 2], ' '), {_Q(P.STAFF_ROLES)}) AND regexp_matches(line, {_Q(P.STAFF_NAME)}))
SELECT page_id, count(DISTINCT name) AS staff, coalesce(array_to_string(list_sort(list(DISTINCT name))[:25], ' | '), '') evidence FROM s LEFT JOIN n USING (page_id) GROUP BY page_id""")
def visible_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a page's lines near a role, in higher-order functions: no line leaves its page."""
    found = P.visible_staff(F.col("text"))
    return _pages(spark, sf_dir).select("page_id", F.size(found).cast("long").alias("staff"), F.array_join(F.slice(found, 1, 25), " | ").alias("evidence"))
