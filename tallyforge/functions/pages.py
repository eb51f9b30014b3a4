"""Evidence in page texts: lines, offices and location pages, as columns over arrays of lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.entity import STATES

#: What a location URL may be called without naming a place.
PLAIN_SLUGS = ("location", "locations", "office", "offices", "contact", "about", "team")
ZIP_LINE = r"(?i)\b(" + "|".join([*(v for v in STATES.values()), *sorted(STATES, key=lambda s: (-len(s), s))]) + r")\s+(\d{5}(-\d{4})?)\b"
LOCATION_URL = r"(?i)https?://[^\s)]+/(?:locations?|offices?)/([a-z0-9][a-z0-9-]{1,80})/?"


def lines(text: Column) -> Column:
    """A text's lines, white space collapsed, without list marks."""
    return F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r"^[ \-*#\t]+|[ \-*#\t]+$", ""))


def offices(text: Column) -> Column:
    """Distinct evidence of offices, sorted: lines with a state and ZIP code behind up to two lines before, and named location pages."""
    every = lines(text)
    near = lambda k: F.array_join(F.filter(F.slice(every, F.greatest(F.lit(1), k - 1), F.least(k + 1, F.lit(3))), lambda x: x != ""), " ")
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"https?://\S+", ""), r"(?i)\bPhone:?\s*[\d().\-\s]+", ""), r"\s+", " "))
    places = F.filter(F.transform(every, lambda x, k: F.when(F.rlike(x, F.lit(ZIP_LINE)), bare(near(k)))), lambda x: F.length(x) >= 12)
    slugs = F.filter(F.transform(F.regexp_extract_all(text, F.lit(LOCATION_URL), F.lit(1)), lambda s: F.regexp_replace(F.lower(s), "^-+|-+$", "")), lambda s: (s != "") & ~s.isin(*PLAIN_SLUGS))
    named = F.transform(slugs, lambda s: F.concat(F.lit("location page: "), F.initcap(F.replace(s, F.lit("-"), F.lit(" ")))))
    return F.array_sort(F.array_distinct(F.concat(F.transform(places, lambda x: F.left(x, F.lit(140))), named)))


#: Roles, words that no name holds, and the shape of a name on a line.
STAFF_ROLES = r"(?i)\b(attorney|counsel|closer|closing|escrow officer|processor|president|manager|owner|partner|director|coordinator|examiner|sales|operations|officer|founder|ceo|cfo|vp|vice president)\b"
NO_STAFF = (
    "abstract", "active", "advantage", "agency", "areas", "assurance", "bag", "board", "buyer", "calculator", "closing", "commercial", "community", "company", "competitive", "connect", "contact", "corporation", "county", "education", "efficiency", "escrow", "facts", "family", "foundation", "frequently", "history", "home", "insurance", "land",
    "locations", "mission", "mobile", "number", "office", "order", "policy", "price", "program", "questions", "rate", "realty", "recovery", "resources", "seller", "services", "settlement", "sign", "single", "sponsor", "summary", "title", "trust", "workout",
)
CONTACT_WORDS = "street|suite|phone|fax|email|copyright"
STAFF_NAME = r"^[A-Z][a-zA-Z'.-]+(?:\s+[A-Z]\.)?(?:\s+[A-Z][a-zA-Z'.-]+){1,3}(?:,\s*(?:Esq\.?|Attorney|President|Manager|Closer|Processor|Counsel|CEO|Owner).*)?$"


def visible_staff(text: Column) -> Column:
    """Distinct names, sorted: short lines shaped like a name of two to four words, with a role in them or within two lines."""
    raw, every = F.split(text, "\n"), lines(text)

    def fits(x: Column, k: Column) -> Column:
        low = F.trim(F.regexp_replace(F.lower(x), "[^a-z ]", ""))
        words = F.filter(F.split(low, " +"), lambda w: w != "")
        first = F.greatest(F.lit(0), k - 2)
        near = F.array_join(F.slice(raw, first + 1, k + 3 - first), " ")
        short = (x != "") & (F.length(x) <= 80) & F.size(words).between(2, 4)
        return short & ~F.arrays_overlap(words, F.array(*map(F.lit, NO_STAFF))) & ~F.rlike(low, F.lit(CONTACT_WORDS)) & F.rlike(near, F.lit(STAFF_ROLES)) & F.rlike(x, F.lit(STAFF_NAME))

    names = F.transform(every, lambda x, k: F.when(fits(x, k), F.trim(F.regexp_replace(x, ",.*$", ""))))
    return F.array_sort(F.array_distinct(F.array_compact(names)))
