"""Hosts, pages, names and signals in text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as X
from tallyforge.operators import joins as J
from tallyforge.operators import matching as M
from tallyforge.plans.catalog import query
from tallyforge.sources.tables import tables

HOST_SQL = _HOST = r"regexp_replace(regexp_replace(regexp_extract(regexp_replace(lower(trim(url)), '^[a-z][a-z0-9+.-]*://', ''), '^([^/?#]*)', 1), '^[^@]*@|:[0-9]*$', '', 'g'), '^www\.', '')"


@query("host_normalize", f"SELECT page_id, {_HOST} host FROM pages")
def host_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).pages.select("page_id", X.host("url").alias("host"))


@query("registered_domain_dialects", f"""
WITH h AS (SELECT page_id, {_HOST} host FROM pages), s AS (SELECT page_id, host, string_split(host, '.') l FROM h)
SELECT page_id, CASE WHEN len(l) < 2 THEN '' WHEN len(l) >= 3 AND array_to_string(l[-2:], '.') IN ('co.uk','org.uk','ac.uk','gov.uk','com.au','net.au','org.au','co.nz','org.nz') THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END suffix_aware,
 CASE WHEN len(l) < 2 THEN '' ELSE array_to_string(l[-2:], '.') END last_two, len(l[-1]) = 2 AND l[-1] <> 'us' AS foreign_country FROM s""")
def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = tables(spark, sf_dir).pages.select("page_id", X.host("url").alias("host"))
    return h.select("page_id", X.registered_domain("host").alias("suffix_aware"), F.when(F.size(F.split("host", "\\.")) < 2, "").otherwise(F.substring_index("host", ".", -2)).alias("last_two"), X.foreign_country_domain("host").alias("foreign_country"))


@query("domain_cluster_context", f"WITH h AS (SELECT page_id, {_HOST} host FROM pages) SELECT page_id, host, count(*) OVER (PARTITION BY host) cluster_size FROM h")
def cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.cluster_size(tables(spark, sf_dir).pages.select("page_id", X.host("url").alias("host")), "host")


@query("shared_domain_survivor", f"WITH h AS (SELECT page_id, {_HOST} host, length(html) n FROM pages) SELECT host, count(*) members, arg_max(page_id, (n, -page_id)) survivor FROM h GROUP BY 1 HAVING count(*) > 1")
def survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = tables(spark, sf_dir).pages.select("page_id", X.host("url").alias("host"), F.length("html").alias("n"))
    return h.groupBy("host").agg(F.count("*").alias("members"), F.max_by("page_id", F.struct("n", -F.col("page_id"))).alias("survivor")).where("members > 1")


@query("html_title", r"""
SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) title FROM pages""")
def title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).pages.select("page_id", X.html_title("html").alias("title"))


@query("link_candidates", r"""SELECT page_id, lower(u) link, count(*) n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'https?://[A-Za-z0-9._/-]+')) u FROM pages) GROUP BY ALL""")
def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables(spark, sf_dir).pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit("(https?://[A-Za-z0-9._/-]+)"), F.lit(1))).alias("u"))
    return found.groupBy("page_id", F.lower("u").alias("link")).agg(F.count("*").alias("n"))


@query("page_score_topk", f"""
WITH p AS (SELECT page_id, {_HOST} host, CASE WHEN regexp_matches(lower(url), 'contact|about') THEN 100 WHEN regexp_matches(lower(url), 'team|office') THEN 70 ELSE 0 END + CASE WHEN regexp_matches(lower(url), 'login|cart') THEN -80 ELSE 0 END score FROM pages)
SELECT host, page_id, score FROM p QUALIFY row_number() OVER (PARTITION BY host ORDER BY score DESC, page_id) <= 5""")
def page_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.lower("url")
    score = F.when(F.rlike(u, F.lit("contact|about")), 100).when(F.rlike(u, F.lit("team|office")), 70).otherwise(0) + F.when(F.rlike(u, F.lit("login|cart")), -80).otherwise(0)
    w = Window.partitionBy("host").orderBy(F.desc("score"), "page_id")
    p = tables(spark, sf_dir).pages.select("page_id", X.host("url").alias("host"), score.alias("score"))
    return p.withColumn("_r", F.row_number().over(w)).where("_r <= 5").drop("_r")


SIGNALS = {"english": ("the", "and"), "french": ("les", "une"), "german": ("der", "und"), "spanish": ("los", "una")}


@query("keyword_signals", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '(^|[^a-z0-9])({'|'.join(w)})([^a-z0-9]|$)') THEN '{n}' END" for n, w in sorted(SIGNALS.items())) + "], lambda x: x IS NOT NULL), '; ') signals FROM documents")
def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).documents.select("doc_id", F.array_join(X.keyword_hits("text", SIGNALS), "; ").alias("signals"))


@query("signal_excerpts", r"SELECT doc_id, CASE WHEN instr(lower(text), 'licensed') > 0 THEN left(trim(regexp_replace(substr(text, greatest(1, instr(lower(text), 'licensed') - 90), instr(lower(text), 'licensed') + 8 + 120 - greatest(1, instr(lower(text), 'licensed') - 90)), '\s+', ' ', 'g')), 280) END excerpt FROM documents")
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).documents.select("doc_id", X.excerpt("text", "licensed", 90, 120).alias("excerpt"))


@query("line_context", r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) i, unnest(string_split(text, chr(10))) line FROM documents), c AS (SELECT doc_id, i, line, lag(line) OVER w before, lead(line) OVER w after FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, i - 1 AS line_no, coalesce(before, '') before, coalesce(after, '') after FROM c WHERE contains(lower(line), 'copyright')""")
def line_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a word, and their neighbours: places in the document's own array, no window and no shuffle."""
    d = tables(spark, sf_dir).documents.select("doc_id", F.split("text", "\n").alias("a"))
    hit = d.select("doc_id", "a", F.posexplode("a").alias("line_no", "line")).where(F.contains(F.lower("line"), F.lit("copyright")))
    at = lambda k: F.coalesce(F.get("a", F.col("line_no") + k), F.lit(""))
    return hit.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.when(F.col("line_no") > 0, at(-1)).otherwise("").alias("before"), at(1).alias("after"))


_TOK = r"list_filter(regexp_split_to_array(replace(lower({c}), '&', ' and '), '[^a-z0-9]+'), lambda x: x <> '' AND x NOT IN ('co','company','corp','corporation','inc','incorporated','llc','llp','lp','ltd','limited','pa','pc','pllc'))"


@query("entity_name_normalize", f"SELECT p_partkey, array_to_string({_TOK.format(c='p_name')}, ' ') entity FROM part")
def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).part.select("p_partkey", X.entity_name("p_name").alias("entity"))


@query("token_overlap_match", f"""
WITH t AS (SELECT p_partkey k, list_distinct(list_filter({_TOK.format(c='p_name')}, lambda x: length(x) >= 3)) w, p_brand b FROM part), e AS (SELECT DISTINCT k, b, unnest(w) x, len(w) n FROM t)
SELECT a.b brand, count(*) pairs FROM (SELECT l.k, r.k k2, l.b, count(*) hits, any_value(l.n) n FROM e l JOIN e r ON l.b = r.b AND l.x = r.x AND l.k < r.k GROUP BY ALL HAVING count(*) >= 2 AND count(*) / any_value(l.n) >= 0.5) a GROUP BY 1""")
def token_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of one brand whose names share two words and half of the first's."""
    t = tables(spark, sf_dir).part.select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("brand"), X.distinctive("p_name").alias("w"))
    return M.overlap_counts(t, "brand", "k", "w")


@query("text_fields", r"""
SELECT doc_id, CASE WHEN length(text) > 240 THEN left(text, 237) || '...' ELSE text END short, regexp_replace(regexp_replace(lower(trim(source)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') slug, lower(trim(lang)) IN ('1', 'true', 't', 'yes', 'y') truth,
 coalesce(nullif(trim(lang), ''), nullif(trim(source), ''), '') first_filled FROM documents""")
def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).documents.select("doc_id", X.shortened("text", 240).alias("short"), X.slug("source").alias("slug"), X.truthy("lang").alias("truth"), X.first_filled("lang", "source").alias("first_filled"))
