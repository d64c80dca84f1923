"""Every query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as contract
from ebbline.plans.catalog import QUERIES
from ebbline.plans.expected import SQL

SF = "/root/testdata/sf0.001"
TABLES = ["events", "documents", "conversations", "embeddings", "part"]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(repr(r[i]) for i in order) for r in rows])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    result = oracle.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == _sorted(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
