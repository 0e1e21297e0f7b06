"""Registered corpus queries against their SQL in DuckDB, on the smallest tables."""

import os

import pytest

from quarry.llm.oracle import ORACLE_SQL
from quarry.llm.queries import QUERIES
from quarry.sources.tables import DRIVER_TABLES, table_path
from tests.test_parity import canon

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, small_sf, key):
    con = duckdb.connect()
    for t in [*DRIVER_TABLES, "documents", "labels", "conversations"]:
        if os.path.exists(p := table_path(small_sf, t)):
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = QUERIES[key](spark, small_sf)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(ORACLE_SQL[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_every_operator_has_its_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
