"""Text, host and name expressions.  All are columns: they stay in generated code and never leave the JVM."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that say only the legal form of a company.
LEGAL_FORMS = ("co", "company", "corp", "corporation", "inc", "incorporated", "llc", "llp", "lp", "ltd", "limited", "pa", "pc", "pllc")
#: Suffixes under which names are registered one label further down.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "org.nz")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """body of a struct of values, each computed once however often the body names it."""
    return F.get(F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), lambda s: body(s)), F.lit(0))


def clean(c: str | Column) -> Column:
    """Trimmed; null becomes blank."""
    return F.trim(F.coalesce(col(c).cast("string"), F.lit("")))


def first_filled(*columns: str | Column) -> Column:
    """The first of several alternative columns that isn't blank; blank if none is."""
    return F.coalesce(*(F.nullif(clean(c), F.lit("")) for c in columns), F.lit(""))


#: Truth as several parts of a pipeline understand it.
TRUE_WORDS = {"wide": ("1", "true", "t", "yes", "y"), "release": ("1", "true", "yes", "y"), "evaluation": ("1", "true", "t", "yes", "y", "accepted", "score_now", "publish_value"), "strict": ("true",)}


def truthy(c: str | Column, dialect: str = "wide") -> Column:
    return F.lower(clean(c)).isin(*TRUE_WORDS[dialect])


def split_values(c: str | Column, separators: str = "[|;,]") -> Column:
    """A delimited cell as an array of filled values, in order, each once."""
    parts = F.transform(F.split(clean(c), separators), lambda x: F.trim(x))  # trim itself would take the place as second argument
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


@lru_cache(maxsize=1)
def ascii_forms() -> tuple[str, str, dict[str, str]]:
    """Letters whose compatible decomposition (NFKD) has one ASCII letter, these letters, and those with several."""
    forms = {chr(k): unicodedata.normalize("NFKD", chr(k)).encode("ascii", "ignore").decode() for k in range(0x80, 0x20000) if not 0xD800 <= k < 0xE000}
    one = {c: a for c, a in forms.items() if len(a) == 1}
    return "".join(one), "".join(one.values()), {c: a for c, a in forms.items() if len(a) > 1}


def fold_ascii(c: str | Column) -> Column:
    """ASCII letters of a text's compatible decomposition: marks go, ligatures and digits in signs come apart, what has no such letter is dropped."""
    marked, plain, several = ascii_forms()
    text = F.translate(clean(c), marked, plain)
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")  # one literal once Spark has folded it
    apart = F.array_join(F.transform(F.split(text, ""), lambda x: F.coalesce(F.element_at(table, x), x)), "")
    text = F.when(F.rlike(text, F.lit("[^\\x00-\\x7F]")), apart).otherwise(text)  # after the first step few texts have one
    return F.regexp_replace(text, "[^\\x00-\\x7F]", "")


def tokens(c: str | Column) -> Column:
    """Lower-case words of letters and digits; & reads and."""
    return F.filter(F.split(F.regexp_replace(F.lower(fold_ascii(c)), "&", " and "), "[^a-z0-9]+"), lambda x: x != "")


def entity_name(c: str | Column, drop: tuple[str, ...] = LEGAL_FORMS) -> Column:
    """Words of a name without its legal form, joined by spaces."""
    return F.array_join(F.filter(tokens(c), lambda x: ~x.isin(*drop)), " ")


def distinctive(c: str | Column, stop: tuple[str, ...] = LEGAL_FORMS, least: int = 3) -> Column:
    return F.array_distinct(F.filter(tokens(c), lambda x: (F.length(x) >= least) & ~x.isin(*stop)))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    small = F.least(F.size(a), F.size(b))
    return F.when(small > 0, F.size(F.array_intersect(a, b)) / small).otherwise(F.lit(0.0))


def host(c: str | Column) -> Column:
    """Host of a URL or bare name: lower case, no user, port or leading www."""
    bare = F.regexp_replace(F.lower(clean(c)), "^[a-z][a-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, "^([^/?#]*)", 1), "^[^@]*@|:[0-9]*$", ""), "^www\\.", "")


def registered_domain(h: str | Column, second: tuple[str, ...] = SECOND_LEVEL) -> Column:
    """The last two labels, or three under a two-label suffix; blank without a dot."""
    labels = F.split(col(h), "\\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, n - k + 1, k), ".")
    return F.when(n < 2, F.lit("")).when((n >= 3) & last(2).isin(*second), last(3)).otherwise(last(2))


def same_domain(a: Column, b: Column) -> Column:
    """Equal, or one below the other."""
    return (a != "") & (b != "") & ((a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a)))


def foreign_country_domain(h: str | Column, home: str = "us") -> Column:
    last = F.element_at(F.split(col(h), "\\."), -1)
    return (F.length(last) == 2) & (last != home)


def phone10(c: str | Column) -> Column:
    digits = F.regexp_replace(clean(c), "[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10))).otherwise("")


def phones(c: str | Column) -> Column:
    """Ten-digit numbers in a text, in order, each once."""
    found = F.regexp_extract_all(clean(c), F.lit(r"(?<!\d)(\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4})(?!\d)"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: F.right(F.regexp_replace(x, "[^0-9]", ""), F.lit(10))))


def keyword_hits(text: str | Column, words: dict[str, tuple[str, ...]]) -> Column:
    """Sorted labels of which some keyword stands alone in the text."""
    hit = lambda w: F.rlike(F.lower(col(text)), F.lit(f"(^|[^a-z0-9]){w}([^a-z0-9]|$)"))
    found = [F.when(reduce(lambda a, b: a | b, map(hit, ws)), F.lit(label)) for label, ws in sorted(words.items())]
    return F.array_compact(F.array(*found))


def excerpt(text: str | Column, word: str, before: int, after: int, cap: int = 280) -> Column:
    """What stands around the first place of a word, white space collapsed; null without it."""
    at = F.instr(F.lower(col(text)), word)
    start = F.greatest(F.lit(1), at - before)
    cut = F.substring(col(text), start, at + len(word) + after - start)
    return F.when(at > 0, F.left(F.trim(F.regexp_replace(cut, "\\s+", " ")), F.lit(cap)))


def shortened(c: str | Column, cap: int) -> Column:
    return F.when(F.length(col(c)) > cap, F.concat(F.left(col(c), F.lit(cap - 3)), F.lit("..."))).otherwise(col(c))


def slug(c: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(clean(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def html_title(c: str | Column) -> Column:
    """The title's text, entities of five kinds decoded, white space collapsed."""
    raw = F.regexp_extract(col(c), "(?is)<title[^>]*>(.*?)</title>", 1)
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(raw, "\\s+", " "))


def fingerprint(*columns: str) -> Column:
    """SHA-256 of the trimmed values as one line per column, in order of names: equal rows have equal prints."""
    return F.sha2(F.concat_ws("\n", *(F.concat(F.lit(f"{c}="), clean(c)) for c in sorted(columns))), 256)
