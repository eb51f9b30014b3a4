"""Names of customers and suppliers: the match cascade, and clusters of brands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import text as X
from tallyforge.operators import graph as G
from tallyforge.operators import matching as M
from tallyforge.plans.catalog import query
from tallyforge.sources import evidence as V
from tallyforge.sources.tables import tables

_DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


def _spelled(digits: Column) -> Column:
    words = F.array(*map(F.lit, _DIGITS))
    return F.array_join(F.transform(F.split(digits, ""), lambda d: F.get(words, d.cast("int"))), " ")


def _firms(df: DataFrame, key: str, name: str, nation: str, balance: str) -> DataFrame:
    """The number in a name, without its last digit, is the firm, spelled; a firm has branches, in the nation, and in a city by balance."""
    firm = F.substring(F.regexp_extract(name, "([0-9]+)", 1), 5, 4)
    out = df.select(F.col(key).alias("id"), firm.alias("firm"), _spelled(firm).alias("name"), nation, balance)
    return out.select("id", F.concat("firm", F.lit("-"), (F.col("id") % 4).cast("string")).alias("raw"), "name", F.concat(F.lit("n"), F.col(nation).cast("string")).alias("state"), F.concat(F.lit("c"), F.floor(F.abs(balance) / 2000).cast("string")).alias("city"), F.col(balance).alias("balance"))


_D = "CASE d " + " ".join(f"WHEN '{k}' THEN '{w}'" for k, w in enumerate(_DIGITS)) + " END"
_FIRM = "substr(regexp_extract({n}, '([0-9]+)', 1), 5, 4)"
_SPELL = f"array_to_string(list_transform(string_split({_FIRM}, ''), lambda d: {_D}), ' ')"
#: Length of the longest common subsequence of two lists of codes: rows of its table, one for each letter of the first.
_LCS = "list_reduce(list_prepend(list_transform(ys, lambda y: 0), list_transform(xs, lambda x: [x])), lambda p, c: list_transform(range(1, len(ys) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN ys[k] = c[1] THEN coalesce(p[k - 1], 0) + 1 ELSE p[k] END))))[len(ys)]"
_CODES = "list_transform(string_split({}, ''), lambda c: ascii(c))"


def _scores(pairs: str) -> str:
    return f"SELECT * EXCLUDE (xs, ys), 200.0 * {_LCS} / (len(xs) + len(ys)) score FROM (SELECT *, {_CODES.format('x')} xs, {_CODES.format('y')} ys FROM {pairs})"


CASCADE = f"""
WITH c0 AS (SELECT c_custkey id, {_FIRM.format(n='c_name')} || '-' || c_custkey % 4 raw, {_SPELL.format(n='c_name')} w, CASE WHEN c_acctbal < 0 THEN '' ELSE 'n' || c_nationkey END state, 'c' || CAST(floor(abs(c_acctbal) / 2000) AS INTEGER) city FROM customer),
 c AS (SELECT id, raw, CASE WHEN id % 2 = 1 THEN left(w, id % 11) || substr(w, id % 11 + 2) ELSE w END x, state, city FROM c0),
 s AS (SELECT s_suppkey rid, {_FIRM.format(n='s_name')} || '-' || s_suppkey % 4 raw, {_SPELL.format(n='s_name')} y, 'n' || s_nationkey state, 'c' || CAST(floor(abs(s_acctbal) / 2000) AS INTEGER) city FROM supplier),
 n AS (SELECT y, state, min(rid) first FROM s GROUP BY ALL), e AS (SELECT DISTINCT x, state, x y, 100.0 score, 'high' confidence FROM c JOIN n USING (state) WHERE x = y),
 m AS (SELECT x, state, y, score, 'medium' confidence FROM ({_scores("(SELECT DISTINCT x, state, y, first FROM c JOIN n USING (state) WHERE (x, state) NOT IN (SELECT (x, state) FROM e))")}) WHERE score >= 90 QUALIFY row_number() OVER (PARTITION BY x, state ORDER BY score DESC, first) = 1),
 f AS (SELECT x, '' state, y, score, 'low' confidence FROM ({_scores("(SELECT DISTINCT x, y, first FROM c, (SELECT y, min(first) first FROM n GROUP BY 1) WHERE c.state = '')")}) WHERE score >= 95 QUALIFY row_number() OVER (PARTITION BY x ORDER BY score DESC, first) = 1),
 g AS (SELECT c.id, c.city, c.raw, x, y, score, confidence, s.rid, s.city = c.city same, s.raw = c.raw written FROM c JOIN (FROM e UNION ALL FROM m UNION ALL FROM f) USING (x, state) JOIN s USING (y) WHERE c.state = '' OR s.state = c.state),
 h AS (SELECT *, bool_or(same) OVER w any_city, count(*) OVER w candidates FROM g WINDOW w AS (PARTITION BY id)), i AS (SELECT *, bool_or(written) OVER (PARTITION BY id) any_raw FROM h WHERE same OR NOT any_city),
 j AS (SELECT id, any_value(x) x, any_value(score) score, any_value(confidence) confidence, min(rid) rid, any_value(candidates) candidates, bool_or(any_city) any_city FROM i WHERE written OR NOT any_raw GROUP BY id)
SELECT id, rid, confidence, CASE confidence WHEN 'high' THEN 'exact_name_state' WHEN 'medium' THEN 'fuzzy_name_state' ELSE 'fuzzy_name_only' END AS method, CAST(floor(score + 1e-9) AS INTEGER) score, candidates, confidence = 'low' OR candidates > 1 AS needs_review FROM j
WHERE confidence <> 'low' OR any_city OR (candidates = 1 AND len(string_split_regex(x, ' +')) >= 3)"""


@query("fuzzy_cascade_match", CASCADE)
def fuzzy_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, whose names are heard with a letter missing now and then, among suppliers; those in debt have no state."""
    t = tables(spark, sf_dir)
    c = _firms(t.customer, "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    at = (F.col("id") % 11).cast("int")
    heard = F.when(F.col("id") % 2 == 1, F.concat(F.substring(F.col("name"), F.lit(1), at), F.substring(F.col("name"), at + 2, F.length("name")))).otherwise(F.col("name"))
    accounts = c.select("id", "raw", heard.alias("name"), F.when(F.col("balance") < 0, "").otherwise(F.col("state")).alias("state"), "city")
    return M.cascade(accounts, _firms(t.supplier, "s_suppkey", "s_name", "s_nationkey", "s_acctbal").withColumnRenamed("id", "rid"))


_PART_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower(p_name), '[^a-z0-9]+'), lambda x: length(x) >= 3))"


@query("brand_clusters", f"""
WITH RECURSIVE p AS (SELECT p_brand b, p_name n, count(*) c, {_PART_WORDS} w FROM part GROUP BY ALL), h AS (SELECT b, n, unnest(w) t FROM p), k AS (SELECT b, t FROM h GROUP BY 1, 2 HAVING count(*) BETWEEN 2 AND 3),
 l AS (SELECT DISTINCT x.b, x.n x, y.n y FROM k JOIN h x USING (b, t) JOIN h y USING (b, t)), r(b, x, y) AS (SELECT b, n, n FROM p UNION SELECT r.b, r.x, l.y FROM r JOIN l ON l.b = r.b AND l.x = r.y), m AS (SELECT b, x, min(y) cluster FROM r GROUP BY 1, 2)
SELECT b AS p_brand, cluster, sum(c)::BIGINT members, count(*) AS names, arg_min(n, lower(n)) shown FROM p JOIN m USING (b) WHERE m.x = p.n GROUP BY 1, 2 HAVING sum(c) >= 5""")
def brand_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a brand that hang together by words which few of its names have."""
    parts = tables(spark, sf_dir).part.select("p_brand", F.col("p_name").alias("name"), X.distinctive("p_name").alias("words"))
    return G.name_clusters(parts, "words", "p_brand")


@query("directory_members", """
SELECT s_nationkey nation, CAST(s_suppkey AS VARCHAR) number, s_name AS name, CASE WHEN s_acctbal < 0 THEN 'Nowhere' ELSE 'North ' || CAST(s_nationkey AS VARCHAR) END city, CASE WHEN s_acctbal < 0 THEN '' WHEN s_nationkey % 2 = 0 THEN 'TX' ELSE 'NV' END state, CASE WHEN s_acctbal > 9000 THEN 'elite' ELSE 'member' END kind FROM supplier""")
def directory_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory page for each nation, written as HTML from its suppliers, and read back row by row."""
    s = tables(spark, sf_dir).supplier
    where = F.when(F.col("s_acctbal") < 0, "Nowhere").otherwise(F.concat(F.lit("North "), F.col("s_nationkey").cast("string"), F.when(F.col("s_nationkey") % 2 == 0, ", Texas").otherwise(" , nv")))
    first = F.when(F.col("s_acctbal") > 9000, "Elite Profile").otherwise(F.col("s_suppkey").cast("string"))
    row = F.concat(F.lit("<tr class='r'><td>"), first, F.lit("</td><td><a href='/"), F.col("s_suppkey").cast("string"), F.lit("'>"), F.col("s_name"), F.lit("</a></td>\n<td> "), where, F.lit("</td></tr>"))
    head = F.lit("<html><table><tr><td>ALTA ID</td><td>Company</td><td>Location</td></tr>")
    page = s.groupBy("s_nationkey").agg(F.concat(head, F.array_join(F.sort_array(F.collect_list(row)), "\n"), F.lit("</table></html>")).alias("html"))
    found = V.directory_rows(page.withColumnRenamed("s_nationkey", "nation"), "nation", "html").where("kind IN ('member', 'elite')")
    # an elite row has no number; its supplier's is in its name
    number = F.when(F.col("kind") == "elite", F.regexp_extract("name", "#0*([0-9]+)$", 1)).otherwise(F.col("number"))
    return found.select("nation", number.alias("number"), "name", "city", "state", "kind")
