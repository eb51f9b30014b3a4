"""Facts of decision stages as rows of orders: for Spark, and for the SQL twins."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.ladders import Ladder, Ledger
from tallyforge.sources.tables import tables

_KINDS = {str: ("string", "VARCHAR"), bool: ("boolean", "BOOLEAN"), int: ("int", "INTEGER"), float: ("double", "DOUBLE")}


#: A whole number below 97 for the k-th fact of an order, from its price and keys; both engines read this text.
def _spread(k: int) -> str:
    return f"((CAST(round(o_totalprice * 100) AS BIGINT) * {2 * k + 3} + o_custkey * {7 * k + 11} + o_orderkey * {k * k + 1}) % 97)"


class Fixture:
    """Facts by column, each with the values that it can have: as rows of orders, whose price and keys choose the values, or as literal rows for tests.

    base: how many of 97 orders have a fact's first value (0: all values alike).  together: one choice for all columns, so
    that values of a place stay together.  key: a column that gets the order's key behind it, so that it tells rows apart.
    """

    def __init__(self, facts: dict[str, list], base: int = 0, together: bool = False, key: str = ""):
        self.facts, self.base, self.together, self.key = facts, base, together, key
        self.kinds = {c: _KINDS[type(v[0])] for c, v in facts.items()}

    def _index(self, k: int, n: int) -> str:
        e = _spread(0 if self.together else k)
        return "0" if n == 1 else f"CASE WHEN {e} < {self.base} THEN 0 ELSE 1 + {e} % {n - 1} END" if self.base else f"{e} % {n}"

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """row_id and a value of each fact for every order."""
        out = tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_totalprice")
        columns = [F.col("o_orderkey").alias("row_id")]
        for k, (c, values) in enumerate(self.facts.items()):
            kind = self.kinds[c][0]
            one = F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.expr(f"CAST({self._index(k, len(values))} AS INT)"))
            columns.append((F.concat(one, F.lit("-"), F.col("o_orderkey").cast("string")) if c == self.key else one).alias(c))
        return out.select(*columns)

    @property
    def sql(self) -> str:
        def cell(v, kind):
            text = "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower()
            return f"CAST({text} AS {kind})"

        columns = []
        for k, (c, values) in enumerate(self.facts.items()):
            one = f"CASE {self._index(k, len(values))} {' '.join(f'WHEN {n} THEN {cell(v, self.kinds[c][1])}' for n, v in enumerate(values))} END"
            columns.append(f"{one} || '-' || o_orderkey AS {c}" if c == self.key else f"{one} AS {c}")
        return f"(SELECT o_orderkey AS row_id, {', '.join(columns)} FROM orders)"

    def pairs(self) -> Iterator[dict]:
        """A row of all first values, and rows in which one fact or two have another value: every rule and every precedence of two is met."""
        base = {k: v[0] for k, v in self.facts.items()}
        yield base
        other = [(k, x) for k, v in self.facts.items() for x in v[1:]]
        for k, x in other:
            yield base | {k: x}
        for (k, x), (m, y) in combinations(other, 2):
            if k != m:
                yield base | {k: x, m: y}


def listed(rows: list[dict], **how) -> Fixture:
    """Facts from rows of columns."""
    return Fixture({c: [r[c] for r in rows] for c in rows[0]}, **how)


def pairwise(facts: dict[str, list]) -> Fixture:
    """Facts of which most have their first value."""
    return Fixture(facts, base=72)


def duck(sql: str) -> str:
    """A Spark expression of the ladders as DuckDB reads it."""
    return sql.replace("regexp_like(", "regexp_matches(").replace(", r'", ", '")


def twin(source: str, *layers: tuple[tuple[str, str], ...] | Ladder | Ledger) -> str:
    """A query over source that adds layer by layer of columns."""
    out = source
    for layer in layers:
        if isinstance(layer, Ladder):
            out = f"(SELECT *, {', '.join(f'{duck(c)} AS {n}' for n, c in layer.cases().items())} FROM {out} q)"
        elif isinstance(layer, Ledger):
            found = ", ".join(f"CASE WHEN {duck(when)} THEN '{n}' END" for n, when in layer.rules)
            out = f"(SELECT *, array_to_string(list_filter([{found}], lambda x: x IS NOT NULL), '; ') AS {layer.name} FROM {out} q)"
        else:
            for name, sql in layer:
                out = f"(SELECT *, {duck(sql)} AS {name} FROM {out} q)"
    return out
