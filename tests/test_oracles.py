"""Every registered query against its SQL over the smallest given tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_entry(spark):
    assert entry.entry(spark).columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert got
        return
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())
