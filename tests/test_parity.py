"""Every registered query against its independent SQL formulation (DuckDB),
on the smallest driver tables. Exact match of the value multiset."""

import datetime as dt
import decimal
import math
import os

import pytest

import __spark_entry__ as entry
from quarry.oracle_sql import all_oracles
from quarry.plans.registry import registry
from quarry.sources.tables import DRIVER_TABLES, table_path

duckdb = pytest.importorskip("duckdb")


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con(small_sf):
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        p = table_path(small_sf, t)
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_keys_match():
    assert set(all_oracles()) == set(registry())
    assert set(registry()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(registry()))
def test_query_matches_oracle(spark, con, small_sf, key):
    df = entry.queries()[key](spark, small_sf)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted(tuple(canon(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want
