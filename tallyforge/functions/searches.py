"""Queries by which an account's site or registry entry is searched for, as arrays of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import bound, col, host

#: Words that don't tell a name apart, and legal forms as they are written.
COMMON = ("a", "and", "at", "co", "company", "corp", "corporation", "dba", "escrow", "firm", "for", "group", "inc", "insurance", "law", "llc", "llp", "lp", "ltd", "of", "pc", "plc", "pllc", "service", "services", "settlement", "the", "title", "to")
LEGAL_SUFFIX = r"(?i)\b(inc|incorporated|llc|l\.?l\.?c\.?|llp|l\.?l\.?p\.?|plc|p\.?l\.?c\.?|pllc|p\.?l\.?l\.?c\.?|pc|p\.?c\.?|corp|corporation|ltd|limited)\b"
#: What stands behind a name and its state, and behind a name and its site.
SITE_TEMPLATES = ("title settlement escrow", "ALTA Registry", "title insurance agency", "underwriter title agent", "real estate settlement attorney", "location office")
LONGEST = 50


def spaced(c: str | Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"\s+", " "))


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def site_searches(name: str | Column, state: str | Column, site: str | Column, home: str = "Virginia") -> Column:
    """An account's searches by name and state (home if it has none), and by the host of its site if it has one."""
    n, s = quoted(spaced(name)), spaced(state)
    place = quoted(F.when(s == "", home).otherwise(s))
    own = F.coalesce(host(site), F.lit(""))
    every = [F.concat_ws(" ", n, place, F.lit(t)) for t in SITE_TEMPLATES]
    return F.array_compact(F.array(*every, F.when(own != "", F.concat_ws(" ", n, quoted(own), F.lit("title settlement")))))


def website_searches(name: str | Column, state: str | Column, site: str | Column) -> Column:
    n, s, own = quoted(spaced(name)), spaced(state), F.coalesce(host(site), F.lit(""))
    with_state = [F.when(s != "", F.concat_ws(" ", n, s, F.lit(t))) for t in ("official website", "title escrow law website")]
    return F.array_compact(F.array(*with_state, F.concat_ws(" ", n, F.lit("official website")), F.concat_ws(" ", n, F.lit("title escrow law firm website")), F.when(own != "", F.concat_ws(" ", quoted(F.substring_index(own, ".", 1)), n))))


def registry_names(name: str | Column, *sites: str | Column) -> Column:
    """Names under which a registry may hold an account, in order, each once whatever its case: as it is written without its legal form, by initials, by its sites' labels, by its distinctive words."""
    whole = spaced(name)
    plain = F.regexp_replace(F.replace(F.regexp_replace(F.regexp_replace(whole, r"(?i)\bd/?b/?a\b.*", ""), LEGAL_SUFFIX, " "), F.lit("&"), F.lit(" and ")), "[^A-Za-z0-9 ]+", " ")

    def by_site(site: Column) -> Column:
        label = F.regexp_replace(F.substring_index(F.coalesce(host(site), F.lit("")), ".", 1), "[^a-z0-9]+", "")
        before = F.regexp_extract(label, "^(.{2,4})title$", 1)
        short = F.upper(before)
        return F.array(label, F.when(before != "", F.concat(short, F.lit(" Title"))), F.when(before != "", F.concat(F.array_join(F.split(short, ""), " "), F.lit(" Title"))))

    def named(v: Column) -> Column:
        words = F.filter(F.regexp_extract_all(F.lower(v["plain"]), F.lit("([a-z0-9]+)"), F.lit(1)), lambda t: ~t.isin(*COMMON) & (F.length(t) > 1))
        first, low = F.coalesce(F.get(words, F.lit(0)), F.lit("")), F.lower(v["plain"])
        initial = [F.upper(F.regexp_extract(v["whole"], r"\b([A-Za-z])\s*(?:and|&)\s*([A-Za-z])\b", k)) for k in (1, 2)]
        initials = (initial[0] != "") & F.contains(F.lower(v["whole"]), F.lit("title"))
        has = F.size(words) > 0
        return F.concat(
            F.array(v["plain"], F.when(initials, F.concat(*initial, F.lit(" Title"))), F.when(initials, F.concat(initial[0], F.lit(" "), initial[1], F.lit(" Title")))),
            *(by_site(col(s)) for s in sites),
            F.array(
                F.when(has & F.contains(low, F.lit("title")), F.concat(first, F.lit(" Title"))),
                F.when(F.size(words) >= 2, F.array_join(F.slice(words, 1, 2), " ")).when(F.length(first) >= 3, first),
                F.when(has & F.contains(low, F.lit("law")), F.concat(first, F.lit(" Law"))),
            ),
        )

    every = bound({"whole": whole, "plain": F.left(spaced(plain), F.lit(LONGEST))}, named)
    neat = F.filter(F.transform(F.array_compact(every), lambda x: spaced(F.regexp_replace(x, "[^A-Za-z0-9 ]+", " "))), lambda x: F.length(x) >= 3)

    def once(v: Column) -> Column:
        low = F.transform(v["all"], lambda x: F.lower(x))
        return F.transform(F.filter(v["all"], lambda x, k: F.array_position(low, F.lower(x)) == k + 1), lambda x: F.left(x, F.lit(LONGEST)))

    return bound({"all": neat}, once)
