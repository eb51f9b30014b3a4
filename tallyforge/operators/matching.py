"""Accounts matched with members by name: exact in their state, close in their state, then close anywhere for accounts without one.

Candidates of a close match meet by q-grams.  An edit (a letter more or less) harms q grams of a name at most, so of two
names at most d edits apart, the rarest gram that lies unharmed in both stands among the first q * d + 1 of each, in any
order of rarity that both share.  Only at these grams names meet, so common pieces of names are asked for only where a
name has no rarer ones, and the grams' order decides what the join costs, never what it finds.
All work is on distinct names: members of a name are summed up before an account meets them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.aggregates import with_range
from tallyforge.operators.outcomes import _common, in_cells
from tallyforge.sources.scratch import written

#: Grams counted as common, at most (an order of rarity, so any number gives the same matches); all others are rarer.
COMMON = 10_000
#: Names of a block that are all compared with each account's, at most; of more, those that share a gram.
DIRECT = 1 << 15
#: Stands before and behind a name, so that short names have grams too; no name holds it.
PAD = "\x1f"


def edits(length: Column, least: float) -> Column:
    """Letters by which names of a ratio of `least` can differ at most, if one has this length."""
    q = least / 100
    return F.floor(2 * (1 - q) / q * length + 1e-9).cast("int")


def grams(names: DataFrame, q: int) -> DataFrame:
    """names (with a column name) with gram and place, a row for each q-gram."""
    padded = F.concat(F.lit(PAD * (q - 1)), F.col("name"), F.lit(PAD * (q - 1)))
    places = F.sequence(F.lit(1), F.length("name") + (q - 1))
    return names.withColumn("_g", F.explode(F.transform(places, lambda k: F.struct(F.substring(padded, k, q).alias("gram"), k.alias("place"))))).select(*names.columns, "_g.gram", "_g.place")


def rarest(names: DataFrame, common: DataFrame, q: int, least: float) -> DataFrame:
    """names' rows with each gram by which their name must be met."""
    by = F.struct(F.coalesce("n", F.lit(0)), "gram", "place")
    found = grams(names.select("name").distinct(), q).join(F.broadcast(common), "gram", "left")  # COMMON rows at most
    met = found.groupBy("name").agg(F.sort_array(F.collect_list(by)).alias("_all"))  # a name's grams are few
    first = F.slice("_all", F.lit(1), q * edits(F.length("name"), least) + 1)
    asked = met.select("name", F.array_distinct(first["gram"]).alias("_g"))
    return (names.join(asked, "name") if len(names.columns) > 1 else asked).select(*names.columns, F.explode("_g").alias("gram"))


class _Tree:
    """Distinct names of one length by their beginnings: the nodes of each level with their letters, and where each node's children begin and how many they are."""

    def __init__(self, names: list[str], at: dict[str, int]):
        names = sorted(names)
        grid = np.array([[at[c] for c in x] for x in names])
        new = np.logical_or.accumulate(grid[1:] != grid[:-1], axis=1)
        node = np.vstack([np.zeros((1, grid.shape[1]), np.int64), np.cumsum(new, axis=0)])
        self.names, self.levels, nodes = names, [], 1
        for t in range(grid.shape[1]):
            first = np.flatnonzero(np.concatenate([[True], new[:, t]]))
            many = np.bincount(node[first, t - 1] if t else np.zeros(len(first), np.int64), minlength=nodes)
            self.levels.append((grid[first, t], np.cumsum(many) - many, many))
            nodes = len(first)


#: Low bits, and pairs of a name and a node held at once.
_LOW = np.array([(1 << k) - 1 for k in range(65)], np.uint64)
PAIRS = 1 << 18


def near(names: list[str], others: list[str], least: float) -> Iterator[tuple[str, str, float]]:
    """All pairs of a ratio of `least` or more, with it; either list's names are distinct and not empty.

    Others of one length are walked down letter by letter for many names at once, a column of each pair's table of common
    letters in the bits of a number; a beginning that has lost more letters than a whole pair may is left with all its names.
    """
    if not names or not others:
        return
    q = least / 200
    short = [x for x in names if len(x) <= 64] if len(names) * len(others) > 64 else []
    for x in names:
        if len(x) > 64 or not short:
            for y in others:
                if min(len(x), len(y)) >= q * (len(x) + len(y)) - 1e-9 and (r := 200.0 * _common(x, y) / (len(x) + len(y))) >= least:
                    yield x, y, r
    if not short:
        return
    at = {c: k for k, c in enumerate(sorted({c for y in others for c in y}))}
    mask = np.zeros((len(short), len(at)), np.uint64)
    for i, x in enumerate(short):
        own: dict[int, int] = {}
        for k, c in enumerate(x):
            if c in at:
                own[at[c]] = own.get(at[c], 0) | 1 << k
        mask[i, list(own)] = np.array(list(own.values()), np.uint64)
    lengths = np.array([len(x) for x in short])
    kinds: dict[int, list[str]] = {}
    for y in others:
        kinds.setdefault(len(y), []).append(y)
    for m, own_names in kinds.items():
        # letters that the other and the name can lose
        lost = np.floor(m - q * (lengths + m) + 1e-9).astype(np.int64)
        gone = np.floor(lengths - q * (lengths + m) + 1e-9).astype(np.int64)
        asked = np.flatnonzero((lost >= 0) & (gone >= 0))
        if not asked.size:
            continue
        tree, step = _Tree(own_names, at), max(1, PAIRS // len(own_names))
        for k in range(0, asked.size, step):
            s = asked[k : k + step]
            node, row = np.zeros(s.size, np.int64), np.full(s.size, ~np.uint64(0))
            for t, (chars, first, many) in enumerate(tree.levels):
                n = many[node]
                end = np.cumsum(n)
                node = np.repeat(first[node] - end + n, n) + np.arange(end[-1] if n.size else 0)
                s, row = np.repeat(s, n), np.repeat(row, n)
                u = row & mask[s, chars[node]]
                row = (row + u) | (row - u)
                low = _LOW[np.minimum(lengths, t + 1 + gone)]
                kept = np.flatnonzero(np.bitwise_count(~row & low[s]) >= (t + 1 - lost)[s])
                s, row, node = s[kept], row[kept], node[kept]
            ratios = 200.0 * np.bitwise_count(~row & _LOW[lengths][s]) / (lengths[s] + m)
            for i, j, r in zip(s.tolist(), node.tolist(), ratios.tolist(), strict=True):
                if r >= least:
                    yield short[i], tree.names[j], r


def _by_grams(left: DataFrame, right: DataFrame, q: int, least: float) -> list[DataFrame]:
    """Both tables' rows with the grams by which their names must be met."""
    everything = grams(left.select("name"), q).unionByName(grams(right.select("name"), q))
    common = everything.groupBy("gram").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "gram").limit(COMMON)
    return [rarest(df, common, q, least) for df in (left, right)]


def close_names(left: DataFrame, right: DataFrame, least: float, on: list[str], q: int = 2) -> DataFrame:
    """left's (name and on), other and score for all names of right with a ratio of `least` or more and equal on.

    left and right hold distinct names, not empty.  Names that share a gram, or a block of few names, are compared where
    they meet, so only close ones are pairs of rows.
    """
    left, right = (written(df.select("name", *on).dropna()) for df in (left, right))
    whole = lambda df: df.withColumn("gram", F.lit(""))
    large = right.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > DIRECT)
    if large.isEmpty():
        a, b = whole(left), whole(right)
    elif not on:
        a, b = _by_grams(left, right, q, least)
    else:
        large = large.drop("_n")
        few, many = ([df.join(large, on, how) for df in (left, right)] for how in ("left_anti", "left_semi"))
        a, b = (whole(x).unionByName(y) for x, y in zip(few, _by_grams(*many, q, least), strict=True))
    types = dict(left.dtypes)

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        found = list(zip(*near(x["name"].to_pylist(), y["other"].to_pylist(), least), strict=True)) or [[]] * 3
        same = [pa.array(x[c].slice(0, 1).to_pylist() * len(found[0]), x.schema.field(c).type) for c in on]
        return pa.Table.from_arrays([pa.array(found[0], pa.string()), *same, pa.array(found[1], pa.string()), pa.array(found[2], pa.float64())], ["name", *on, "other", "score"])

    schema = ", ".join(["name string", *(f"`{c}` {types[c]}" for c in on), "other string, score double"])
    return in_cells(a, b.withColumnRenamed("name", "other"), [*on, "gram"], run, schema).distinct()


def _first(found: DataFrame, key: list[str]) -> DataFrame:
    """The best-scored other of each key; ties take the one whose first member comes first."""
    return found.groupBy(*key).agg(F.max_by(F.struct("other", "score"), F.struct(F.col("score"), -F.col("first"))).alias("b")).select(*key, "b.other", "b.score")


def _chosen(matches: DataFrame, members: DataFrame, group: list[str]) -> DataFrame:
    """matches (id, raw, city, and the group that their candidates make) with rid, candidates and same_city.

    Of a group's members those of the account's city, and then those that are written like it, come first; of what is
    left, the least rid.  Least rids of each (city, writing) are found once for a group, so no group meets its accounts
    member by member.
    """

    def least(extra: list[str], name: str) -> DataFrame:
        keep = members.where(" AND ".join(f"{c} <> ''" for c in extra) or "true")
        return keep.groupBy(*group, *extra).agg(F.min("rid").alias(name))

    whole = members.groupBy(*group).agg(F.min("rid").alias("_any"), F.count("*").alias("candidates"))
    out = matches.join(whole, group)
    for extra, name in ((["city", "raw"], "_both"), (["city"], "_city"), (["raw"], "_raw")):
        out = out.join(least(extra, name), [*group, *extra], "left")
    return out.withColumn("rid", F.coalesce("_both", "_city", "_raw", "_any")).withColumn("same_city", F.col("_city").isNotNull()).drop("_both", "_city", "_raw", "_any")


def cascade(accounts: DataFrame, members: DataFrame, near: float = 90.0, far: float = 95.0) -> DataFrame:
    """The match of each account, if it has one: id, rid, confidence, method, score (whole per cents), candidates, needs_review.

    accounts: id, raw (as written), name (normalised), state, city; members the same with rid.  Blank names match
    nothing.  A close name anywhere counts for accounts without a state only, and only if the city agrees, or the name
    is of three words or more and one member has it.
    """
    clean = lambda df: df.withColumns({"raw": F.lower(F.trim(F.coalesce("raw", F.lit("")))), **{c: F.coalesce(c, F.lit("")) for c in ("name", "state", "city")}}).where("name <> ''")
    accounts, members = written(clean(accounts)), written(clean(members))  # read by a dozen steps
    own = members.where("state <> ''").groupBy("name", "state").agg(F.min("rid").alias("first"))
    names = members.groupBy("name").agg(F.min("rid").alias("first"))

    asked = accounts.groupBy("name", "state").agg(F.lit(1).alias("_"))
    exact = asked.where("state <> ''").join(own, ["name", "state"]).select("name", "state", F.col("name").alias("other"), F.lit(100.0).alias("score"))
    rest = asked.where("state <> ''").join(exact, ["name", "state"], "left_anti").select("name", "state")
    medium = close_names(rest, own.select("name", "state"), near, ["state"]).join(own.select("state", F.col("name").alias("other"), "first"), ["state", "other"])
    in_state = exact.withColumn("confidence", F.lit("high")).unionByName(_first(medium, ["name", "state"]).withColumn("confidence", F.lit("medium")))

    homeless = accounts.where("state = ''").select("name").distinct()
    same = homeless.join(names, "name").select("name", F.col("name").alias("other"), F.lit(100.0).alias("score"))
    other = close_names(homeless.join(same, "name", "left_anti"), names.select("name"), far, []).join(names.select(F.col("name").alias("other"), "first"), "other")
    low = same.unionByName(_first(other, ["name"]))

    local = _chosen(accounts.join(in_state, ["name", "state"]), members.withColumnRenamed("name", "other"), ["other", "state"])
    loose = _chosen(accounts.where("state = ''").join(low, "name"), members.withColumnRenamed("name", "other").drop("state"), ["other"])
    words = F.size(F.split("name", " +"))
    loose = loose.where(F.col("same_city") | ((F.col("candidates") == 1) & (words >= 3))).withColumn("confidence", F.lit("low"))
    out = local.select("id", "rid", "confidence", "score", "candidates").unionByName(loose.select("id", "rid", "confidence", "score", "candidates"))
    method = F.when(F.col("confidence") == "high", "exact_name_state").when(F.col("confidence") == "medium", "fuzzy_name_state").otherwise("fuzzy_name_only")
    review = (F.col("confidence") == "low") | (F.col("candidates") > 1)
    return out.select("id", "rid", "confidence", method.alias("method"), F.floor(F.col("score") + 1e-9).cast("int").alias("score"), "candidates", review.alias("needs_review"))


def _in_order(mixed: DataFrame, rows: DataFrame, group: str) -> DataFrame:
    """group and pairs: for each a and b of mixed, how many keys of a's rows lie below how many of b's.

    Running counts go over ranges of keys and then over the ranges, so no task holds all rows of two sets.
    """
    sides = F.explode(F.array(F.struct("a.w", "a.n", F.lit(0).alias("_b")), F.struct("b.w", "b.n", F.lit(1).alias("_b"))))
    asked = mixed.select(group, F.struct("a", "b").alias("_pair"), sides.alias("_s")).select(group, "_pair", "_s.*")
    met = with_range(asked.join(rows.hint("merge"), [group, "w", "n"]).select(group, "_pair", "_b", "k"), "k")
    first, second = F.count_if(F.col("_b") == 0), F.count_if(F.col("_b") == 1)
    within = met.withColumn("pairs", first.over(Window.partitionBy(group, "_pair", "_p").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))).where("_b = 1").select(group, "pairs")
    sums = met.groupBy(group, "_pair", "_p").agg(first.alias("_first"), second.alias("_second"))
    before = F.sum("_first").over(Window.partitionBy(group, "_pair").orderBy("_p")) - F.col("_first")
    return within.unionByName(sums.select(group, (before * F.col("_second")).alias("pairs")))


def overlap_counts(df: DataFrame, group: str, key: str, words: str) -> DataFrame:
    """group and pairs: how many pairs of a group's keys, the lower one first, share two words and half of the first's.

    Keys of the same words are one set, and sets meet, not keys: what they count is the product of their sizes, or what
    lies in order where only one way counts.  A set of n words that shares h = max(2, n / 2) must share one of any
    n - h + 1 of its words, so sets meet by their rarest ones, and a pair stays where the first of them meets.
    """
    known = df.select(group, F.col(key).alias("k"), F.col(words).alias("w")).where((F.size("w") > 0) & F.col(group).isNotNull() & F.col("k").isNotNull())
    # a key is one row; should one come again, its words count as one row's
    once = known.groupBy(group, "k").agg(F.min(F.size("w")).alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("w")))).alias("w"))
    rows = once.where(F.size("w") > 1)
    sets = rows.groupBy(group, "w", "n").agg(F.count("*").alias("c"), F.min("k").alias("least"), F.max("k").alias("most")).select(group, F.struct("w", "n", "c", "least", "most").alias("a"))
    each = sets.select(group, "a", F.explode("a.w").alias("x"))
    often = each.groupBy(group, "x").agg(F.count("*").alias("_f"))
    take = F.size("a.w") - F.greatest(F.lit(2), F.ceil(F.col("a.n") / 2)) + 1
    rare = F.slice(F.array_sort(F.collect_list(F.struct("_f", "x"))), F.lit(1), take.cast("int"))
    asked = each.join(often.hint("merge"), [group, "x"]).groupBy(group, "a").agg(rare.alias("_r")).select(group, "a", F.col("_r.x").alias("_r"), F.explode("_r.x").alias("x"))  # a name's words are few
    other = each.withColumnRenamed("a", "b")
    met = asked.join(other.hint("merge"), [group, "x"]).where("a <> b").where(F.get(F.filter("_r", lambda y: F.array_contains("b.w", y)), F.lit(0)) == F.col("x"))
    hits = F.size(F.array_intersect("a.w", "b.w"))
    pairs = met.where((hits >= 2) & (2 * hits >= F.col("a.n"))).select(group, "a", "b", (2 * hits >= F.col("b.n")).alias("_both"))
    every = F.col("a.c") * F.col("b.c")
    whole = pairs.where("CASE WHEN _both THEN a < b ELSE a.most < b.least END").select(group, every.alias("pairs"))
    mixed = pairs.where("NOT _both AND a.least < b.most AND a.most > b.least")
    same = sets.where("a.c > 1").select(group, F.expr("a.c * (a.c - 1) div 2").alias("pairs"))
    found = same.unionByName(whole).unionByName(_in_order(mixed, rows, group))
    return found.groupBy(group).agg(F.sum("pairs").alias("pairs")).where("pairs > 0")
