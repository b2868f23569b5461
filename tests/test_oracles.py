"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as contract
from registry import ORACLES, QUERIES
from tools.check import TABLES, rows_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, rows) == rows_of(rel.columns, rel.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "request_id" and df.limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())
