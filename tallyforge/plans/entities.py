"""Entity functions over texts that orders choose and over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import entity as E
from tallyforge.functions import text as X
from tallyforge.plans.catalog import query
from tallyforge.plans.fixtures import listed
from tallyforge.sources.tables import tables

_LIST = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _tok(x: str) -> str:
    return f"list_filter(string_split_regex(replace(lower(strip_accents({x})), '&', ' and '), '[^a-z0-9]+'), lambda t: t <> '')"


def _ident(x: str) -> str:
    return f"array_to_string(list_filter({_tok(x)}, lambda t: t NOT IN {_LIST(E.WEAK_WORDS)}), ' ')"


def _core(x: str) -> str:
    return f"list_distinct(list_filter({_tok(x)}, lambda t: length(t) >= 3 AND t NOT IN {_LIST(E.WEAK_WORDS + E.INDUSTRY_WORDS)}))"


def _union(p: str, q: str) -> str:
    return f"len(list_distinct(list_concat({p}, {q})))"


_PAIRS = listed([
    {"a": a, "b": b}
    for a, b in (
        ("Oak Title LLC", "Oak Title"), ("Harbor Light", "Harbor Light Escrow of Texas"), ("Harbor Light Escrow of Texas", "Harbor Light"), ("North Star Title", "North Pole Title"), ("The Title Co", "Title Company"), ("Title Agency", "Title Group"),
        ("", "Oak"), ("Café Río Title", "Cafe Rio Title Inc"), ("Smith & Sons Law", "Smith and Sons"), ("Blue River Settlement Services", "River Blue Closing"), ("Law Group", "Legal Firm"), ("Oakland Title", "Oak Title"), ("A B C", "A B C Inc"), ("Maple Grove Abstract", "Grove Maple Street Abstract"),
    )
])
_SIM = f"""CASE WHEN x = '' OR y = '' THEN 0.0::DOUBLE WHEN x = y THEN 1.0 WHEN length(x) >= 8 AND contains(' ' || y || ' ', ' ' || x || ' ') THEN 0.97 WHEN length(y) >= 8 AND contains(' ' || x || ' ', ' ' || y || ' ') THEN 0.94
 WHEN len(p) > 0 AND len(q) > 0 THEN CASE WHEN h = 0 THEN 0.0 ELSE least(0.93::DOUBLE, 0.55::DOUBLE * (h / least(len(p), len(q))) + 0.45::DOUBLE * (h / {_union('p', 'q')})) END
 ELSE len(list_intersect(list_distinct(string_split(x, ' ')), list_distinct(string_split(y, ' ')))) / {_union("string_split(x, ' ')", "string_split(y, ' ')")} END"""


@query("name_similarity_ladder", f"SELECT a, b, {_SIM} AS similarity FROM (SELECT *, len(list_intersect(p, q)) h FROM (SELECT a, b, {_ident('a')} x, {_ident('b')} y, {_core('a')} p, {_core('b')} q FROM {_PAIRS.sql}))")
def name_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _PAIRS.frame(spark, sf_dir).select("a", "b", E.name_similarity("a", "b").alias("similarity"))


_SITES = listed([
    {"name": n, "alias": m, "label": d, "text": t, "host": h}
    for n, m, d, t, h in (
        ("Oak Harbor Title LLC", "Oak Escrow", "oak-harbor", "Welcome to Oak Harbor Title, LLC of Ohio", "oakharbor.com"), ("Maple Title", "", "mapletitleco", "maple trees", "maple.wixsite.com"), ("North Star Law Firm", "NS Legal", "northstar", "We are North Star law firm.", "linkedin.com"),
        ("Title Company", "", "title", "title company", "gmail.com"), ("River & Sons Inc.", "Riverside", "", "river and sons", ""), ("Blue Co", "Blue Lake Escrow", "lakeblue", "call Blue Lake Escrow", "sites.google.com"), ("Elm", "", "elm", "elm elm", "m.facebook.com"), ("Great Oaks Abstract", "", "greatoaks", "GREAT OAKS ABSTRACT serves", "greatoaks.co.uk"),
    )
])
_ONE = lambda n: f"CASE WHEN len({_core(n)}) = 0 THEN 0.0 ELSE greatest(len(list_intersect({_core(n)}, list_filter(string_split_regex(label, '[^a-z0-9]+'), lambda t: t <> ''))), len(list_filter({_core(n)}, lambda w: length(w) >= 4 AND contains(regexp_replace(label, '[^a-z0-9]', '', 'g'), w)))) / len({_core(n)}) END"
_WORDS = f"list_distinct(list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda t: length(t) > 1 AND t NOT IN {_LIST(E.WEAK_WORDS)}))"
_BARE = r"trim(regexp_replace(regexp_replace(lower(name), '\b(llc|incorporated|inc|corp(oration)?|company|co|limited|ltd|pllc|pc|llp)\b\.?', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


#: For other plans: the similarity of names x and y with core words p and q of which h agree, and of a name with a domain's label.
SIMILARITY, DOMAIN_SCORE, identity_sql, core_sql = _SIM, f"CASE WHEN label = '' THEN 0.0::DOUBLE ELSE CAST({_ONE('name')} AS DOUBLE) END", _ident, _core


def _under(hosts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in hosts) + ")"


@query("site_identity", f"""SELECT name, label, CASE WHEN label = '' THEN 0.0::DOUBLE ELSE CAST(greatest({_ONE('name')}, {_ONE('alias')}) AS DOUBLE) END domain_score, CASE WHEN len({_WORDS}) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({_WORDS}, string_split_regex(lower(text), '[^a-z0-9]+'))) / len({_WORDS}) END hit_share,
 CASE WHEN length({_BARE}) >= 6 AND contains({_BARE}, ' ') AND contains(' ' || regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || {_BARE} || ' ') THEN name ELSE '' END asserted,
 CASE WHEN host = '' THEN '' WHEN {_under(E.DIRECTORY_HOSTS)} THEN 'directory' WHEN {_under(E.GENERIC_HOSTS)} THEN 'generic' WHEN {_under(E.MAIL_HOSTS)} THEN 'mail' ELSE 'own' END host_class FROM {_SITES.sql}""")
def site_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _SITES.frame(spark, sf_dir).select(
        "name", "label", E.domain_similarity(F.array("name", "alias"), F.col("label")).alias("domain_score"), E.hit_share(F.col("name"), F.col("text")).alias("hit_share"), E.self_asserted(F.col("name"), F.col("text")).alias("asserted"), E.host_class(F.col("host")).alias("host_class"),
    )


_OWN = lambda c: f"list_distinct(list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda t: length(t) > 1 AND t NOT IN {_LIST(E.WEAK_WORDS + E.INDUSTRY_WORDS)}))"
_LOOK = lambda c: f"array_to_string(list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda t: t <> '' AND t NOT IN {_LIST(E.LOOKUP_SUFFIXES)}), ' ')"


@query("strong_entity_overlap", f"""SELECT a, b, len(p) > 0 AND len(q) > 0 AND (({_LOOK('a')} <> '' AND {_LOOK('a')} = {_LOOK('b')}) OR len(h) >= 2 OR coalesce(len(h) = 1 AND length(h[1]) >= 4 AND list_contains(['oakland', 'north', 'maple'], h[1]), false)) AS strong
 FROM (SELECT *, list_intersect(p, q) h FROM (SELECT a, b, {_OWN('a')} p, {_OWN('b')} q FROM {_PAIRS.sql}))""")
def strong_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _PAIRS.frame(spark, sf_dir).select("a", "b", E.strong_overlap(F.col("a"), F.col("b"), F.array(*map(F.lit, ("oakland", "north", "maple")))).alias("strong"))


_PLACES = listed([
    {"account": a, "site": s, "state": c, "country": n}
    for a, s, c, n in (
        ("12 Main Street, Suite 4, Austin TX 78701-1234", "12 Main St #4 Austin TX 78701", "Texas", "USA"), ("12 Main Street Austin TX", "14 Main Street Austin TX", "tx", "United States"), ("Oak Avenue Reno", "Oak Avenue Reno Nevada", " New  York ", "Canada"), ("9 Elm", "9 Elm", "Puerto Rico", "U.S.A."),
        ("100 Park Boulevard Miami Florida", "100 Park Boulevard Miami", "FL", ""), ("5 Hill Road Boise Idaho", "PO Box 5 Boise", "", "us"), ("77 Lake Parkway unit 9", "77 Lake Parkway Unit 9", "District of Columbia", "Mexico"),
    )
])


def _addr(c: str) -> str:
    out = f"replace(lower(trim({c})), '#', ' suite ')"
    for word, short in E.STREET_WORDS.items():
        out = rf"regexp_replace({out}, '\b{word}\b', '{short}', 'g')"
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({out}, '\b(suite|ste\.?|unit)\b', 'suite', 'g'), '(\d{{5}})-\d{{4}}\b', '\1', 'g'), '[^a-z0-9]+', ' ', 'g'))"


_ST, _CO, _AT, _NUM = f"array_to_string({_tok('state')}, ' ')", f"array_to_string({_tok('country')}, ' ')", f"list_distinct({_tok('account')})", lambda c: rf"regexp_extract_all({c}, '\d+')"


@query("address_and_place", f"""SELECT account, {_addr('account')} street, len({_AT}) >= 3 AND NOT (len({_NUM('account')}) > 0 AND len({_NUM('site')}) > 0 AND NOT list_has_any({_NUM('account')}, {_NUM('site')})) AND len(list_intersect({_AT}, {_tok('site')})) / len({_AT}) >= 0.72 AS overlaps,
 CASE WHEN length({_ST}) = 2 THEN {_ST} {' '.join(f"WHEN {_ST} = '{k}' THEN '{v}'" for k, v in E.STATES.items())} ELSE {_ST} END code, CASE WHEN {_CO} IN {_LIST(E.HOME_COUNTRY)} THEN 'us' ELSE {_CO} END nation FROM {_PLACES.sql}""")
def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _PLACES.frame(spark, sf_dir).select("account", E.street_address("account").alias("street"), E.address_overlap(F.col("account"), F.array("site")).alias("overlaps"), E.state_code("state").alias("code"), E.country("country").alias("nation"))


_URLS = listed([{"url": u, "lane": k} for u, k in (("oak.com", "Title"), ("www.oak.com/a", "law-firm"), ("https://oak.com/x", "Title/ Escrow"), ("http://www.oak.com", "Escrow"), (" <https://www.elm.org> ", "law firm"), ("(elm.org)", "legal"), ("N/A", "other lane"), ("", ""), ("HTTP://Elm.org", "LAW"))])
_TXT = r"trim(regexp_replace(trim(url), '\s+', ' ', 'g'))"
_U = rf"CASE WHEN {_TXT} = '' OR lower({_TXT}) IN {_LIST(E.NO_URL)} THEN '' ELSE regexp_replace(regexp_replace({_TXT}, '^[<>\"'']+|[<>\"'']+$', '', 'g'), '^\((.*)\)$', '\1') END"
_LN = "translate(lower(trim(lane)), '-/ ', '___')"


@query("url_and_lane", rf"""WITH a AS (SELECT url, lane, {_U} u FROM {_URLS.sql}), b AS (SELECT *, regexp_extract(u, '^[A-Za-z]+://(.*)$', 1) r, lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) s, starts_with(lower(u), 'www.') w FROM a)
SELECT url, CASE WHEN trim(url) = '' OR regexp_matches(trim(url), '(?i)^https?://') THEN trim(url) ELSE 'https://' || trim(url) END full_url,
 array_to_string(CASE WHEN u = '' THEN [] WHEN contains(u, '://') THEN list_filter([CASE WHEN s = 'http' THEN 'https://' || r END, u, CASE WHEN NOT starts_with(lower(r), 'www.') THEN s || '://www.' || r END, CASE WHEN s = 'https' THEN 'http://' || r END], lambda x: x IS NOT NULL)
  ELSE list_filter(['https://' || u, CASE WHEN NOT w THEN 'https://www.' || u END, 'http://' || u, CASE WHEN NOT w THEN 'http://www.' || u END], lambda x: x IS NOT NULL) END, ' ') variants,
 CASE {' '.join(f"WHEN {_LN} = '{k}' THEN '{v}'" for k, v in E.LANE_NAMES.items())} ELSE {_LN} END lane_name FROM b""")
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _URLS.frame(spark, sf_dir).select("url", E.with_scheme("url").alias("full_url"), F.array_join(E.url_variants("url"), " ").alias("variants"), E.lane_name("lane").alias("lane_name"))


@query("citations_by_order", """
WITH c AS (SELECT o_custkey, 'crm' source, o_orderpriority reference, strftime(o_orderdate, '%Y-%m-%d') observed, left(replace(trim(o_orderstatus || ' of ' || o_orderpriority), chr(10), ' '), 240) excerpt FROM orders), d AS (SELECT DISTINCT * FROM c)
SELECT o_custkey, count(*) citations, max(observed) source_as_of, sha256(string_agg(sha256(source || chr(10) || reference || chr(10) || observed || chr(10) || excerpt), ',' ORDER BY source, reference, observed, excerpt)) digest FROM d GROUP BY 1""")
def cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables(spark, sf_dir).orders
    one = E.citation(F.lit("crm"), F.col("o_orderpriority"), F.concat_ws(" of ", "o_orderstatus", "o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    sets = o.select("o_custkey", one.alias("c")).distinct().groupBy("o_custkey").agg(E.citations(F.collect_list("c")).alias("c"))  # an account's citations are few
    return sets.select("o_custkey", F.size("c").cast("long").alias("citations"), E.latest_text(F.array_max("c.observed")).alias("source_as_of"), F.sha2(F.array_join("c.hash", ","), 256).alias("digest"))


_JSON = listed([{"cell": c} for c in ('["a", " b ", ""]', '"one"', "plain words", "", "[1, 2]", '{"z": "1", "a": "x"}', '{"fields": {"name": "Id", "deep": [{"name": "Owner"}]}}')])


@query("json_cells", f"""SELECT j.cell, listed, updated, names FROM {_JSON.sql} j JOIN (VALUES ('["a", " b ", ""]', 'a|b', '{{"a":"new"}}', ''), ('"one"', 'one', '{{"a":"new"}}', ''), ('plain words', 'plain words', '{{"a":"new"}}', ''), ('', '', '{{"a":"new"}}', ''), ('[1, 2]', '1|2', '{{"a":"new"}}', ''), ('{{"z": "1", "a": "x"}}', '{{"z": "1", "a": "x"}}', '{{"a":"new","z":"1"}}', ''),
 ('{{"fields": {{"name": "Id", "deep": [{{"name": "Owner"}}]}}}}', '{{"fields": {{"name": "Id", "deep": [{{"name": "Owner"}}]}}}}', '{{"a":"new","fields":"{{\\"name\\":\\"Id\\",\\"deep\\":[{{\\"name\\":\\"Owner\\"}}]}}"}}', 'Id|Owner')) t(cell, listed, updated, names) USING (cell)""")
def json_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _JSON.frame(spark, sf_dir).select("cell", F.array_join(E.json_list("cell"), "|").alias("listed"), E.json_update("cell", {"a": F.lit("new")}).alias("updated"), F.array_join(E.json_find("cell", "name"), "|").alias("names"))


@query("text_haystack", "SELECT doc_id, left(concat_ws(' ', trim(coalesce(source, '')), trim(coalesce(lang, '')), trim(coalesce(text, ''))), 2000) haystack, replace(text, 'the and then', '[REDACTED]') redacted FROM documents")
def haystack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).documents.select("doc_id", E.haystack(2000, "source", "lang", "text").alias("haystack"), E.redacted("text", "the and then").alias("redacted"))


@query("name_similarity_pairs", f"""
WITH c AS (SELECT p_partkey k, p_name n, p_brand b, {_core('p_name')} w FROM part), e AS (SELECT k, n, b, unnest(w) x FROM c), m AS (SELECT DISTINCT l.k k1, r.k k2, l.n a, r.n b FROM e l JOIN e r ON l.b = r.b AND l.x = r.x AND l.k < r.k),
 f AS (SELECT *, len(list_intersect(p, q)) h FROM (SELECT k1, k2, {_ident('a')} x, {_ident('b')} y, {_core('a')} p, {_core('b')} q FROM m))
SELECT k1, k2, {_SIM} similarity FROM f WHERE {_SIM} >= 0.9""")
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one brand by similar name.

    Names are compared once, however many parts have them.  At 0.9 two names share more than four in five distinctive words of
    the one that has fewer, so one of its rarest is in the other: only these are asked for.
    """
    p = tables(spark, sf_dir).part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("n"), F.col("p_brand").alias("brand"))
    names = p.groupBy("brand", "n").agg(F.array_distinct(E.core_words(F.first("n"))).alias("w")).where("size(w) > 0")
    words = names.select("brand", "n", "w", F.explode("w").alias("x"))
    often = words.groupBy("brand", "x").agg(F.count("*").alias("c"))
    needed = F.size("w") - F.ceil(0.9 * F.size("w") - 0.1 * F.size("w")) + 1  # of those with fewer words, 0.8 and more must agree
    rare = words.join(often, ["brand", "x"]).groupBy("brand", "n", "w").agg(F.sort_array(F.collect_list(F.struct("c", "x"))).alias("s"))
    asked = rare.select("brand", "n", F.size("w").alias("size"), F.explode(F.slice("s", F.lit(1), needed.cast("int"))).alias("s")).select("brand", "n", "size", F.col("s.x").alias("x"))
    other = words.select("brand", F.col("n").alias("m"), F.size("w").alias("more"), "x")
    met = asked.join(other, ["brand", "x"]).where("size <= more").select("brand", "n", "m").distinct()
    both = met.unionAll(met.select("brand", F.col("m").alias("n"), F.col("n").alias("m"))).distinct()
    alike = both.withColumn("similarity", E.name_similarity("n", "m")).where("similarity >= 0.9")
    pairs = alike.join(p.withColumnRenamed("k", "k1"), ["brand", "n"]).join(p.select("brand", F.col("n").alias("m"), F.col("k").alias("k2")), ["brand", "m"])
    return pairs.where("k1 < k2").select("k1", "k2", "similarity")


_LINES = listed([{"page": p, "text": t} for p, t in (("a", "Oak\nCopyright 2024 Oak\nAll rights"), ("b", "copyright"), ("c", "no such line"), ("d", "x\ny copyright z"))], together=True, key="page")


@query("line_context_rows", r"""
WITH l AS (SELECT page, generate_subscripts(string_split(text, chr(10)), 1) i, unnest(string_split(text, chr(10))) line FROM """ + _LINES.sql + r"""), c AS (SELECT page, i, line, lag(line) OVER w before, lead(line) OVER w after FROM l WINDOW w AS (PARTITION BY page ORDER BY i))
SELECT page, i - 1 AS line_no, coalesce(before, '') before, coalesce(after, '') after FROM c WHERE contains(lower(line), 'copyright')""")
def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _LINES.frame(spark, sf_dir).select("page", F.split("text", "\n").alias("a"))
    hit = d.select("page", "a", F.posexplode("a").alias("line_no", "line")).where(F.contains(F.lower("line"), F.lit("copyright")))
    at = lambda k: F.coalesce(F.get("a", F.col("line_no") + k), F.lit(""))
    return hit.select("page", F.col("line_no").cast("long").alias("line_no"), F.when(F.col("line_no") > 0, at(-1)).otherwise("").alias("before"), at(1).alias("after"))


_LINKS = listed([{"page": p, "html": h} for p, h in (("a", '<a href="https://oak.com/a">x</a> and https://OAK.com/a'), ("b", "none"), ("c", "http://elm.org http://elm.org/x_y"))], together=True, key="page")


@query("link_candidates_rows", "SELECT page, lower(u) link, count(*) n FROM (SELECT page, unnest(regexp_extract_all(html, 'https?://[A-Za-z0-9._/-]+')) u FROM " + _LINKS.sql + ") GROUP BY ALL")
def link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _LINKS.frame(spark, sf_dir).select("page", F.explode(F.regexp_extract_all("html", F.lit("(https?://[A-Za-z0-9._/-]+)"), F.lit(1))).alias("u"))
    return found.groupBy("page", F.lower("u").alias("link")).agg(F.count("*").alias("n"))


_HOSTS = listed([{"host": h, "flag": f} for h, f in (("oak.de", "Yes"), ("oak.co.uk", "no"), ("oak.us", " TRUE "), ("oak.com", "1"), ("x.y.com.au", "accepted"), ("", "t"))])


@query("foreign_host_rows", "SELECT host, length(string_split(host, '.')[-1]) = 2 AND string_split(host, '.')[-1] <> 'us' AS foreign_host, lower(trim(flag)) IN ('1', 'true', 't', 'yes', 'y') AS wide, lower(trim(flag)) IN ('1', 'true', 'yes', 'y') AS release, lower(trim(flag)) = 'true' AS strict FROM " + _HOSTS.sql)
def host_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _HOSTS.frame(spark, sf_dir).select("host", X.foreign_country_domain("host").alias("foreign_host"), X.truthy("flag").alias("wide"), X.truthy("flag", "release").alias("release"), X.truthy("flag", "strict").alias("strict"))
