"""Every registered metric against its SQL twin on DuckDB (sf0.001):
same columns, same row count, same values (order-insensitive)."""

import duckdb
import pytest

import __spark_entry__ as E
from metricforge.plans import ORACLE, QUERIES
from check_oracle import digest
from metricforge.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [x[0] for x in res.description]
    drows = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows, 6)[0] == digest(dcols, drows, 6)[0]
