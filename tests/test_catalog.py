"""Every query of the reference part against its SQL twin."""

import datetime
import decimal
import math

import duckdb
import pandas as pd
import pytest

from tallyforge.plans import catalog, entities, evidence, ladders, matches, names, outcomes, quality, release, replay, run, shadow, text_queries, usage  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return None if isinstance(v, float) and math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return pd.Timestamp(v).isoformat()
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(name, spark, duck):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in catalog.SQL:
        r = duck.execute(catalog.SQL[name])
        own = [d[0] for d in r.description]
        assert sorted(own) == columns
        assert got == sorted((tuple(plain(x[own.index(c)]) for c in columns) for x in r.fetchall()), key=repr)
