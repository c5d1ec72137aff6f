"""Every registered core query against its SQL twin in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from tapewright import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def cell(v):
    if v is None or v != v:
        return "null"
    return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = df.collect()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    names = [c[0] for c in result.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    want = sorted(tuple(cell(r[names.index(c)]) for c in order) for r in result.fetchall())
    assert sorted(tuple(cell(r[c]) for c in order) for r in rows) == want
