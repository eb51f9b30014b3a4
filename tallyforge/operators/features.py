"""What an account's cached pages say of its offices, its staff and its services.

Pages become occurrences (an address in three lines, a line that is a person), occurrences become candidates with the
pages that support them, and candidates become counts.  A page is taken apart where it lies; only occurrences, a few for
each page, are shuffled, and nothing of a page's text but their excerpts goes along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.entity import street_address

#: States, words that end a street, and an address on one line.
STATE_CODES = "AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY|DC"
STREET_ENDS = r"street|st\.?|avenue|ave\.?|road|rd\.?|boulevard|blvd\.?|drive|dr\.?|lane|ln\.?|court|ct\.?|circle|cir\.?|parkway|pkwy\.?|highway|hwy\.?|way|place|pl\.?|terrace|ter\.?|trail|trl\.?|plaza|square|sq\.?"
ADDRESS = rf"(?i)\b\d{{1,6}}\s+[A-Za-z0-9.'&#/-]+(?:\s+[A-Za-z0-9.'&#/-]+){{0,8}}\s+(?:{STREET_ENDS})\b(?:[\s,]+(?:suite|ste\.?|unit|#)\s*[A-Za-z0-9-]+)?[\s,]+[A-Za-z][A-Za-z .'-]{{1,40}}[\s,]+(?:{STATE_CODES})[\s,]+\d{{5}}(?:-\d{{4}})?\b"
#: What makes a page or a line one of an office, and what says that an address isn't an office, in order.
OFFICE_PATH = r"(?i)/(?:contact|locations?|offices?|find-us|directions)(?:/|$)"
OFFICE_WORDS = r"(?i)\b(our (?:main |branch |local )?office|office location|visit us|headquarters|corporate office|branch office|closing office|escrow office|contact us)\b"
NOT_OFFICE = (
    ("court_or_government", r"(?i)\b(courthouse|county court|court (?:address|resources?|services?)|county clerk|recorder(?:'s)? office|register of deeds|government office)\b"),
    ("customer_or_testimonial", r"(?i)\b(testimonial|what (?:our )?clients say|customer story|client spotlight|case study)\b"),
    ("service_area", r"(?i)\b(service areas?|areas? (?:we )?serve|counties served|serving (?:all|the)|coverage area)\b"),
    ("partner_office", r"(?i)\b(partner (?:office|location)|affiliate(?:d)? (?:office|location)|network location|referral partner)\b"),
    ("property_or_listing", r"(?i)\b(property (?:address|listing)|subject property|mls|for sale|open house|listing address)\b"),
)
BIO_PATH = r"(?i)/(?:attorneys?|lawyers?|people|team|bio|professionals?)(?:/|$)"
#: A line that is a person, the words no name has, and what a role or its surroundings mean.
PERSON = r"^([A-Z][A-Za-z'.-]+(?:\s+[A-Z][A-Za-z'.-]+){1,3})(?:\s*(?:\||—|–|-|,|:)\s*([^|]{2,90}))?$"
NO_NAME = ("about", "abstract", "contact", "copyright", "escrow", "insurance", "national", "office", "privacy", "realty", "resources", "services", "settlement", "testimonials", "title")
NOT_STAFF = r"(?i)\b(testimonials?|customer story|what (?:our )?clients say|client says|directory listing|member directory|speaker|guest|property agent|listing agent|opposing counsel)\b"
OPERATIONAL = r"(?i)\b(escrow officer|escrow manager|closing attorney|settlement attorney|settlement agent|closing coordinator|closing specialist|closer|processor|title examiner|title agent|post[- ]closing|pre[- ]closing|branch manager|operations? manager|production manager|transaction coordinator|disbursement|funding specialist|recording specialist)\b"
LEGAL = r"(?i)\b(attorney|lawyer|counsel|partner|associate|esq\.?)\b"
GENERIC = r"(?i)\b(president|owner|founder|chief|ceo|cfo|vice president|director|manager|sales|marketing|receptionist|assistant|administrator)\b"
#: Kinds of staff by precedence, with their confidence.
KINDS = (("relevant_operational", 0.94), ("legal_professional_non_operational", 0.92), ("generic_employee_non_operational", 0.85), ("unverified_name", 0.45), ("excluded_context", 0.96))
#: Services and tools by what a page says.
SERVICES = {
    "abstracting": r"\babstract(?:ing| services?| search)?\b", "commercial_closing": r"\bcommercial (?:real estate )?closings?\b", "escrow": r"\bescrow (?:services?|closings?|officer)\b", "lender_services": r"\blender services?\b",
    "real_estate_closing": r"\breal estate closings?\b", "refinance_closing": r"\brefinanc(?:e|ing) closings?\b", "settlement": r"\bsettlement (?:services?|agent|closings?)\b", "title_insurance": r"\btitle insurance\b",
}
TOOLS = {"client_portal": r"\b(client|customer|closing) portal\b", "online_ordering": r"\b(order (?:title|services?) online|online ordering)\b", "rate_calculator": r"\b(rate|fee|closing cost) calculator\b", "secure_upload": r"\bsecure (?:document )?(?:upload|exchange)\b"}
EXCERPT = 280
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def bare(c: Column) -> Column:
    """A line without marks at its ends, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"^[\s>*#_`~-]+|[\s*_`~-]+$", ""), r"\s+", " "))


def _taken(pages: DataFrame) -> DataFrame:
    """pages (account, url, title, text, observed) with lines and path."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), LINE_END), bare), lambda x: x != "")
    blank = {c: F.coalesce(c, F.lit("")) for c in ("url", "title", "observed")}
    return pages.withColumns(blank).withColumns({"lines": lines, "path": F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)})


def _around(k: Column, before: int, behind: int) -> Column:
    """Line k (from 0) and its neighbours, as one text."""
    first = F.greatest(F.lit(0), k - before)
    return F.array_join(F.slice("lines", first + 1, k + behind + 1 - first), " ")


def office_occurrences(pages: DataFrame) -> DataFrame:
    """account, page, address, display, reference, observed, reason, supportive, excerpt and place of each address, once a page."""
    held = _taken(pages)
    marks = F.flatten(F.transform("lines", lambda x, k: F.transform(F.regexp_extract_all(F.replace(_around(k, 0, 2), F.lit("."), F.lit("")), F.lit(ADDRESS), F.lit(0)), lambda m, n: F.struct(k.alias("line"), n.alias("nth"), m.alias("found")))))
    found = held.withColumn("_m", F.explode(marks)).withColumns({"display": F.trim(F.regexp_replace("_m.found", r"\s+", " ")), "near": _around(F.col("_m.line"), 2, 2)})
    found = found.withColumn("display", F.regexp_replace("display", "^[ ,]+|[ ,]+$", "")).withColumn("address", street_address(F.col("display")))
    whole = F.concat_ws(" ", "title", "url", "near")
    reason = F.lit("")
    reason = F.when(F.rlike("path", F.lit(BIO_PATH)), "attorney_bio").otherwise(reason)
    for code, pattern in reversed(NOT_OFFICE):
        reason = F.when(F.rlike(whole, F.lit(pattern)), code).otherwise(reason)
    supportive = F.rlike("path", F.lit(OFFICE_PATH)) | F.rlike("near", F.lit(OFFICE_WORDS))
    one = F.struct("display", F.col("url").alias("reference"), reason.alias("reason"), supportive.alias("supportive"), F.left(bare(F.col("near")), F.lit(EXCERPT)).alias("excerpt"), F.col("observed"), F.struct(F.lower("url").alias("u"), "observed", "title", "_m.line", "_m.nth").alias("place"))
    return found.where("address <> ''").groupBy("account", F.lower("url").alias("page"), "address").agg(F.min_by(one, F.struct("observed", "title", "_m.line", "_m.nth")).alias("o")).select("account", "page", "address", "o.*")


def offices(occurrences: DataFrame) -> DataFrame:
    """account, address, display, status, confidence, reasons and pages of each address."""
    free, good = F.col("reason") == "", (F.col("reason") == "") & F.col("supportive")
    by = occurrences.groupBy("account", "address").agg(
        F.min_by("display", "place").alias("display"), F.count_distinct("page").alias("pages"), F.count_if(free).alias("_free"), F.count_distinct(F.when(good, F.col("page"))).alias("_good"), F.array_sort(F.collect_set(F.when(~free, F.col("reason")))).alias("_why"),
    )
    step = F.when(F.col("_good") >= 2, 0).when(F.col("_good") == 1, 1).when((F.col("_free") > 0) & (F.col("pages") >= 3), 2).when(F.col("_free") > 0, 3).otherwise(4)
    #: Status, confidence and reason of each step.
    steps = (("verified", 0.97, "operating_office_corroborated"), ("verified", 0.9, "operating_office_page"), ("excluded", 0.92, "repeated_footer_without_office_context"), ("uncertain", 0.55, "address_without_operating_office_context"), ("excluded", 0.96, None))
    table = F.array(*(F.struct(F.lit(s).alias("status"), F.lit(c).alias("confidence"), F.lit(r).cast("string").alias("reason")) for s, c, r in steps))
    by = by.withColumn("_s", F.get(table, step))
    return by.select("account", "address", "display", "_s.status", "_s.confidence", F.coalesce("_s.reason", F.array_join("_why", "; ")).alias("reasons"), "pages")


def staff_occurrences(pages: DataFrame) -> DataFrame:
    """account, person, display, role, kind (its place in KINDS), page, reference, observed, excerpt and place of each line that is a person."""
    held = _taken(pages)
    lines = F.filter(F.transform("lines", lambda x, k: F.struct(x.alias("line"), k.alias("k"))), lambda s: (F.length(s["line"]) <= 120) & F.rlike(s["line"], F.lit(PERSON)))
    found = held.withColumn("_m", F.explode(lines)).withColumns({"display": F.trim(F.regexp_extract("_m.line", PERSON, 1)), "role": F.trim(F.regexp_extract("_m.line", PERSON, 2)), "near": _around(F.col("_m.k"), 1, 1)})
    found = found.where(F.size(F.array_intersect(F.split(F.lower("display"), r"\s+"), F.array(*map(F.lit, NO_NAME)))) == 0)
    role = lambda pattern: (F.col("role") != "") & F.rlike("role", F.lit(pattern))
    aside = F.rlike(F.concat_ws(" ", "title", "url", "near"), F.lit(NOT_STAFF))
    kind = F.when(aside, 4).when(role(OPERATIONAL), 0).when(role(LEGAL), 1).when(role(GENERIC), 2).otherwise(3)
    person = F.trim(F.regexp_replace(F.lower("display"), "[^a-z]+", " "))
    place = F.struct(F.lower("url"), "observed", "title", "_m.k")
    return found.select("account", person.alias("person"), "display", "role", kind.alias("kind"), F.lower("url").alias("page"), F.col("url").alias("reference"), "observed", F.left(bare(F.col("near")), F.lit(EXCERPT)).alias("excerpt"), place.alias("place"))


def staff(occurrences: DataFrame) -> DataFrame:
    """account, person, display, role, category, confidence and pages of each name: its strongest kind, then the greatest role; of equal ones the first is shown."""
    strongest = occurrences.groupBy("account", "person").agg(F.max_by(F.struct("role", "kind"), F.struct(-F.col("kind"), "role")).alias("b"), F.count_distinct("page").alias("pages"))
    same = (F.col("role") == F.col("_role")) & (F.col("kind") == F.col("_kind"))
    shown = occurrences.join(strongest.select("account", "person", F.col("b.role").alias("_role"), F.col("b.kind").alias("_kind")), ["account", "person"]).where(same).groupBy("account", "person").agg(F.min_by("display", "place").alias("display"))
    table = F.array(*(F.struct(F.lit(n).alias("category"), F.lit(c).alias("confidence")) for n, c in KINDS))
    return strongest.join(shown, ["account", "person"]).withColumn("_k", F.get(table, F.col("b.kind"))).select("account", "person", "display", F.col("b.role").alias("role"), "_k.category", "_k.confidence", "pages")


def signals(pages: DataFrame, words: dict[str, str]) -> DataFrame:
    """account, signal, page, reference, observed and excerpt: the first place on each page that says a label."""
    text = F.coalesce("text", F.lit(""))

    def cited(pattern: str) -> Column:
        at = F.regexp_instr(text, F.lit(f"(?i){pattern}"))
        end = at - 1 + F.length(F.regexp_extract(text, f"(?i){pattern}", 0))
        first = F.greatest(F.lit(1), at - 90)
        return F.when(at > 0, F.left(bare(F.substring(text, first, end + 120 - first + 1)), F.lit(EXCERPT)))

    hits = F.array(*(F.struct(F.lit(n).alias("signal"), cited(p).alias("excerpt")) for n, p in words.items()))
    found = pages.withColumn("_h", F.explode(F.filter(hits, lambda h: h["excerpt"].isNotNull())))
    return found.select("account", "_h.signal", F.lower(F.coalesce("url", F.lit(""))).alias("page"), F.coalesce("url", F.lit("")).alias("reference"), F.coalesce("observed", F.lit("")).alias("observed"), "_h.excerpt")


def sophistication(links: Column, paths: Column) -> Column:
    return F.when((links >= 20) | (paths >= 6), "high").when((links >= 6) | (paths >= 3), "medium").otherwise("low")


def evidence_confidence(strong: Column, found: Column, corroborated: Column, sophisticated: Column, citations: Column) -> Column:
    """Low without a strong identity; sophistication adds one point and never a count."""
    points = found + corroborated + F.when(sophisticated, 1).otherwise(0)
    return F.when(~strong, "Low").when((points >= 5) & (citations >= 3), "High").when(points >= 2, "Medium").otherwise("Low")


def entity_safe(pages: DataFrame, accounts: DataFrame) -> DataFrame:
    """accounts (account, strong, links) with counts and ranges of offices and staff, services, tools, confidence and codes of doubt.

    Without a strong identity all counts are zero; the candidates stay for review.
    """
    places, people = office_occurrences(pages), staff_occurrences(pages)
    services, tools = signals(pages, SERVICES), signals(pages, TOOLS)
    o, s = offices(places), staff(people)
    per = lambda df, *aggs: df.groupBy("account").agg(*aggs)
    kind = lambda c: F.count_if(F.col("category") == c)
    left = per(
        o, F.count_if(F.col("status") == "verified").alias("_ov"), F.count_if(F.col("status") == "uncertain").alias("_ou"), F.count_if((F.col("status") == "verified") & (F.col("pages") >= 2)).alias("_oc"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("status") != "verified", F.split("reasons", "; "))))).alias("_why"),
    )
    named = per(s, kind("relevant_operational").alias("_sr"), kind("unverified_name").alias("_su"), kind("legal_professional_non_operational").alias("_sl"), kind("generic_employee_non_operational").alias("_sg"), kind("excluded_context").alias("_sx"))
    cited = None
    for side in (places, people, services, tools):
        one = side.select("account", "reference", "observed", "excerpt")
        cited = one if cited is None else cited.unionByName(one)
    cited = per(cited.distinct(), F.count("*").alias("_cited"))
    said = lambda df, name: per(df, F.array_sort(F.collect_set("signal")).alias(name))
    paths = per(_taken(pages).select("account", F.lower(F.regexp_replace("path", "/+$", "")).alias("p")), F.count_distinct("p").alias("_paths"))
    out = accounts
    for side in (left, named, said(services, "_services"), said(tools, "_tools"), cited, paths):
        out = out.join(side, "account", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    none = F.array().cast("array<string>")
    strong = F.coalesce("strong", F.lit(False))
    shown = lambda c: F.when(strong, zero(c)).otherwise(0)
    services, tools = F.coalesce("_services", none), F.coalesce("_tools", none)
    codes = F.array_compact(F.array(
        F.when(zero("_sl") > 0, "attorneys_not_counted_as_operational_staff"), F.when(zero("_sg") > 0, "generic_roles_not_counted_as_operational_staff"), F.when(zero("_sx") > 0, "testimonial_or_listing_names_excluded"), F.when(~strong, "upstream_identity_or_sellable_gate_not_strong"),
    ))
    grade = sophistication(zero("links"), zero("_paths"))
    return out.select(
        "account", shown("_ov").alias("offices"), shown("_ov").alias("offices_low"), F.when(strong, zero("_ov") + zero("_ou")).otherwise(0).alias("offices_high"), shown("_sr").alias("staff"), F.when(strong, zero("_sr") + zero("_su")).otherwise(0).alias("staff_high"),
        F.array_join(F.when(strong, services).otherwise(none), "; ").alias("services"), F.array_join(F.when(strong, tools).otherwise(none), "; ").alias("tools"), grade.alias("sophistication"),
        evidence_confidence(strong, zero("_ov") + zero("_sr") + F.size(services), zero("_oc"), grade == "high", zero("_cited")).alias("confidence"), F.array_join(F.array_sort(F.array_union(F.coalesce("_why", none), codes)), "; ").alias("codes"),
    )
