"""Names, domains, addresses, states, URLs, citations and JSON cells of business entities, as columns."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import bound, clean, col, tokens

#: Words of a name that carry no identity, and words of the industry.
WEAK_WORDS = ("a", "and", "at", "co", "company", "corp", "corporation", "dba", "for", "inc", "incorporated", "limited", "llc", "llp", "lp", "ltd", "of", "pc", "plc", "pllc", "the")
INDUSTRY_WORDS = ("abstract", "agency", "attorney", "closing", "escrow", "firm", "group", "insurance", "law", "legal", "realty", "settlement", "title")
#: Suffix words of a name that is looked up.
LOOKUP_SUFFIXES = ("co", "company", "corp", "corporation", "inc", "llc", "llp", "ltd")
#: Hosts anyone can have a page on, free mail hosts, and directories.
GENERIC_HOSTS = ("business.site", "carrd.co", "godaddysites.com", "google.com", "hub.biz", "notion.site", "sites.google.com", "squarespace.com", "webflow.io", "weebly.com", "wix.com", "wixsite.com", "wordpress.com")
MAIL_HOSTS = ("aol.com", "gmail.com", "hotmail.com", "icloud.com", "outlook.com", "yahoo.com")
DIRECTORY_HOSTS = ("alignable.com", "avvo.com", "bbb.org", "chamberofcommerce.com", "facebook.com", "findlaw.com", "instagram.com", "justia.com", "lawyers.com", "linkedin.com", "manta.com", "mapquest.com", "martindale.com", "realtor.com", "yellowpages.com", "yelp.com", "zoominfo.com")
#: Street words and how they are written.
STREET_WORDS = {"street": "st", "avenue": "ave", "road": "rd", "boulevard": "blvd", "drive": "dr", "lane": "ln", "court": "ct", "parkway": "pkwy", "highway": "hwy"}
#: States by name.
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de", "district of columbia": "dc", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id",
    "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt",
    "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri",
    "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}
#: Other names of the home country, and of lanes.
HOME_COUNTRY = ("us", "usa", "u s", "u s a", "united states", "united states of america")
LANE_NAMES = {"title": "title_escrow", "escrow": "title_escrow", "title__escrow": "title_escrow", "law": "legal", "law_firm": "legal"}
#: What stands for no URL.
NO_URL = ("(no url)", "no url", "n/a", "na", "none", "-")


def _without(words: Column, drop: tuple[str, ...]) -> Column:
    return F.filter(words, lambda x: ~x.isin(*drop))


def identity_name(c: str | Column) -> Column:
    """A name's words without those that carry no identity."""
    return F.array_join(_without(tokens(c), WEAK_WORDS), " ")


def core_words(c: str | Column) -> Column:
    """A name's distinctive words, each once."""
    return F.array_distinct(F.filter(_without(tokens(c), WEAK_WORDS + INDUSTRY_WORDS), lambda x: F.length(x) >= 3))


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


#: What containment of either name is worth, the most of a blend and its weights, and the least length of a name that counts as contained.
WITHIN, AROUND, MOST, OF_FEWER, OF_ALL, LONG_NAME = 0.97, 0.94, 0.93, 0.55, 0.45, 8


def name_similarity(a: str | Column, b: str | Column) -> Column:
    """1 for equal names; WITHIN if the second holds the first, AROUND the other way round; else a blend over distinctive words, or the overlap of all words."""
    within = lambda s, t: (F.length(s) >= LONG_NAME) & F.contains(F.concat(F.lit(" "), t, F.lit(" ")), F.concat(F.lit(" "), s, F.lit(" ")))

    def worded(n: Column) -> Column:
        x, y, p, q, u, v = (n[k] for k in "xypquv")
        both = F.size(F.array_intersect(p, q))
        blend = F.least(F.lit(MOST), F.lit(OF_FEWER) * share(both, F.least(F.size(p), F.size(q))) + F.lit(OF_ALL) * share(both, F.size(F.array_union(p, q))))
        out = F.when((x == "") | (y == ""), F.lit(0.0)).when(x == y, F.lit(1.0)).when(within(x, y), F.lit(WITHIN)).when(within(y, x), F.lit(AROUND))
        out = out.when((F.size(p) > 0) & (F.size(q) > 0), F.when(both == 0, F.lit(0.0)).otherwise(blend))
        return out.otherwise(share(F.size(F.array_intersect(u, v)), F.size(F.array_union(u, v))))

    words = lambda s: {"x": s["x"], "y": s["y"], "p": core_words(s["x"]), "q": core_words(s["y"]), "u": F.array_distinct(F.split(s["x"], " ")), "v": F.array_distinct(F.split(s["y"], " "))}
    return bound({"x": identity_name(a), "y": identity_name(b)}, lambda s: bound(words(s), worded))


def domain_similarity(names: Column, label: Column) -> Column:
    """The best share of a name's distinctive words in a domain's label: as words, or within it from four letters on."""
    parts, compact = F.filter(F.split(F.lower(label), "[^a-z0-9]+"), lambda x: x != ""), F.regexp_replace(F.lower(label), "[^a-z0-9]", "")

    def one(name):
        core = core_words(name)
        inside = F.size(F.filter(core, lambda w: (F.length(w) >= 4) & F.contains(compact, w)))
        return F.greatest(share(F.size(F.array_intersect(core, parts)), F.size(core)), share(inside, F.size(core)))

    return F.when(F.length(label) > 0, F.coalesce(F.array_max(F.transform(names, one)), F.lit(0.0))).otherwise(F.lit(0.0))


def hit_share(name: Column, text: Column, stop: tuple[str, ...] = WEAK_WORDS) -> Column:
    """The share of a name's words of two letters or more that stand in a text by themselves."""
    words = F.array_distinct(F.filter(F.split(F.lower(name), "[^a-z0-9]+"), lambda x: (F.length(x) > 1) & ~x.isin(*stop)))
    return share(F.size(F.array_intersect(words, F.split(F.lower(text), "[^a-z0-9]+"))), F.size(words))


def strong_overlap(a: Column, b: Column, domain_words: Column, stop: tuple[str, ...] = WEAK_WORDS + INDUSTRY_WORDS) -> Column:
    """Equal names for lookup, two shared words, or one of four letters that is the domain's too."""
    words = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: x != "")
    own = lambda c: F.array_distinct(F.filter(words(c), lambda x: (F.length(x) > 1) & ~x.isin(*stop)))
    look = lambda c: F.array_join(_without(words(c), LOOKUP_SUFFIXES), " ")
    p, q = own(a), own(b)
    both = F.array_intersect(p, q)
    lone = F.get(both, F.lit(0))
    equal = (look(a) != "") & (look(a) == look(b))
    some = (F.size(p) > 0) & (F.size(q) > 0)
    return some & (equal | (F.size(both) >= 2) | F.coalesce((F.size(both) == 1) & (F.length(lone) >= 4) & F.array_contains(domain_words, lone), F.lit(False)))


def _below(host: Column, hosts: tuple[str, ...]) -> Column:
    out = host.isin(*hosts)
    for h in hosts:
        out = out | F.endswith(host, F.lit("." + h))
    return out


def host_class(host: Column) -> Column:
    """`generic`, `mail`, `directory` or `own`; blank without a host."""
    return F.when(host == "", "").when(_below(host, DIRECTORY_HOSTS), "directory").when(_below(host, GENERIC_HOSTS), "generic").when(_below(host, MAIL_HOSTS), "mail").otherwise("own")


def street_address(c: str | Column) -> Column:
    """An address with street words shortened, suites alike and five-digit codes."""
    out = F.replace(F.lower(clean(c)), F.lit("#"), F.lit(" suite "))
    for word, short in STREET_WORDS.items():
        out = F.regexp_replace(out, rf"\b{word}\b", short)
    out = F.regexp_replace(F.regexp_replace(out, r"\b(suite|ste\.?|unit)\b", "suite"), r"(\d{5})-\d{4}\b", "$1")
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def address_overlap(account: Column, sites: Column, least: float = 0.72) -> Column:
    """Whether some address has this share of the account's words and no other house number."""
    own, numbers = F.array_distinct(tokens(account)), F.regexp_extract_all(account, F.lit(r"(\d+)"), F.lit(1))

    def fits(site):
        other = F.regexp_extract_all(site, F.lit(r"(\d+)"), F.lit(1))
        clash = (F.size(numbers) > 0) & (F.size(other) > 0) & ~F.arrays_overlap(numbers, other)
        return ~clash & (F.size(F.array_intersect(own, tokens(site))) / F.size(own) >= least)

    return (F.size(own) >= 3) & F.exists(sites, fits)


def state_code(c: str | Column) -> Column:
    text = F.array_join(tokens(c), " ")
    known = F.create_map(*(F.lit(x) for pair in STATES.items() for x in pair))
    return F.when(F.length(text) == 2, text).otherwise(F.coalesce(F.element_at(known, text), text))


def country(c: str | Column) -> Column:
    text = F.array_join(tokens(c), " ")
    return F.when(text.isin(*HOME_COUNTRY), "us").otherwise(text)


def with_scheme(c: str | Column) -> Column:
    text = clean(c)
    return F.when((text == "") | F.rlike(text, F.lit("(?i)^https?://")), text).otherwise(F.concat(F.lit("https://"), text))


def url_variants(c: str | Column) -> Column:
    """The addresses under which a site is tried, in order."""
    text = F.trim(F.regexp_replace(clean(c), r"\s+", " "))
    bare = F.regexp_replace(F.regexp_replace(text, "^[<>\"']+|[<>\"']+$", ""), r"^\((.*)\)$", "$1")
    url = F.when((text == "") | F.lower(text).isin(*NO_URL), "").otherwise(bare)
    path = F.ltrim(url, F.lit("/"))
    plain = ~F.rlike(F.lower(path), F.lit("^www\\."))
    short = F.array_compact(F.array(F.concat(F.lit("https://"), path), F.when(plain, F.concat(F.lit("https://www."), path)), F.concat(F.lit("http://"), path), F.when(plain, F.concat(F.lit("http://www."), path))))
    rest, scheme = F.regexp_extract(url, "^[A-Za-z]+://(.*)$", 1), F.lower(F.regexp_extract(url, "^([A-Za-z]+)://", 1))
    www = F.when(~F.rlike(F.lower(rest), F.lit("^www\\.")), F.concat(scheme, F.lit("://www."), rest))
    long = F.array_compact(F.array(F.when(scheme == "http", F.concat(F.lit("https://"), rest)), url, www, F.when(scheme == "https", F.concat(F.lit("http://"), rest))))
    return F.when(url == "", F.array().cast("array<string>")).when(F.contains(url, F.lit("://")), F.array_distinct(long)).otherwise(short)


def self_asserted(name: Column, text: Column) -> Column:
    """The name if a page says it: its words without legal form, two at least and six letters, in a row; blank else."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"\b(llc|incorporated|inc|corp(oration)?|company|co|limited|ltd|pllc|pc|llp)\b\.?", " "), "[^a-z0-9]+", " "))
    said = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), F.lit(" "))
    return F.when((F.length(bare) >= 6) & F.contains(bare, F.lit(" ")) & F.contains(said, F.concat(F.lit(" "), bare, F.lit(" "))), name).otherwise("")


def lane_name(c: str | Column) -> Column:
    text = F.translate(F.lower(clean(c)), "-/ ", "___")
    known = F.create_map(*(F.lit(x) for pair in LANE_NAMES.items() for x in pair))
    return F.coalesce(F.element_at(known, text), text)


def redacted(c: str | Column, secret: str) -> Column:
    """A configured secret of eight characters or more is taken out."""
    return F.replace(col(c), F.lit(secret), F.lit("[REDACTED]")) if len(secret) >= 8 else col(c)


def haystack(cap: int, *columns: str | Column) -> Column:
    """Several fields as one text of bounded length."""
    return F.left(F.concat_ws(" ", *map(clean, columns)), F.lit(cap))


def citation(source: Column, reference: Column, value: Column, observed: Column) -> Column:
    """source, reference, observed, excerpt, and the hash of the four as lines."""
    excerpt = F.left(F.replace(clean(value), F.lit("\n"), F.lit(" ")), F.lit(240))
    return F.struct(source.alias("source"), reference.alias("reference"), observed.alias("observed"), excerpt.alias("excerpt"), F.sha2(F.concat_ws("\n", source, reference, observed, excerpt), 256).alias("hash"))


def citations(c: Column) -> Column:
    """Each once, in the order of their keys."""
    return F.array_sort(F.array_distinct(c))


def json_list(c: str | Column) -> Column:
    """A cell as texts: a JSON list's filled values, one for a scalar, the text itself where it isn't JSON."""
    text = clean(c)
    parsed = F.from_json(text, "array<string>", {"mode": "PERMISSIVE"})
    filled = lambda a: F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: x != "")
    scalar = F.array(F.regexp_replace(text, '^"|"$', ""))
    return F.when(text == "", F.array().cast("array<string>")).when(F.startswith(text, F.lit("[")) & parsed.isNotNull(), filled(parsed)).otherwise(filled(scalar))


def json_update(c: str | Column, new: dict[str, Column]) -> Column:
    """A flat JSON object with some keys set, as compact JSON in the order of keys."""
    old = F.coalesce(F.from_json(clean(c), "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    kept = F.map_filter(old, lambda k, _: ~k.isin(*new))
    every = F.map_concat(kept, F.create_map(*(x for k, v in new.items() for x in (F.lit(k), v.cast("string")))))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(every))))


#: A JSON text's tokens: strings with their escapes, marks, and what else stands between them.
_TOKEN = r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+'


def json_find(c: str | Column, key: str) -> Column:
    """All values of a key but objects, arrays and null, at any depth, in order of their places; nothing from what isn't JSON.

    The text is walked token by token, so that a key inside a string is no key and an escaped quote ends no string.
    """
    text = clean(c)
    marks = F.regexp_extract_all(F.when(F.try_parse_json(text).isNotNull(), text).otherwise(""), F.lit(_TOKEN), F.lit(0))
    at = lambda k: F.coalesce(F.get(marks, k), F.lit(""))
    value = lambda x: F.when(F.startswith(x, F.lit('"')), F.get(F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>"), 0)).otherwise(x)
    found = F.transform(marks, lambda x, k: F.when((x == json.dumps(key, ensure_ascii=False)) & (at(k + 1) == ":") & ~at(k + 2).isin("{", "[", "null", ""), value(at(k + 2))))
    return F.array_compact(found)


def latest_text(*columns: str | Column) -> Column:
    """The last of several timestamps as texts; blank if none is filled."""
    return F.coalesce(F.array_max(F.filter(F.array(*map(clean, columns)), lambda x: x != "")), F.lit(""))


def utc_stamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
