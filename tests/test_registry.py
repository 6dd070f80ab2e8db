"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from sparrowmill import plans

SF_DIR = contract.SMOKE_DIR
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_names():
    assert set(plans.SQL) == set(plans.QUERIES)
    assert set(plans.QUERIES) <= set(contract.queries())


@needs_tables
def test_entry(spark):
    assert contract.entry(spark).columns == ["term", "df", "segment", "postings"]


@needs_tables
@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_same_rows(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toArrow()
    want = duck.sql(contract.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)

    def rows(table):
        return sorted(map(repr, zip(*[table.column(c).to_pylist() for c in columns])))

    assert rows(got) == rows(want)
