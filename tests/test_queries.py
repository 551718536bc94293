"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, rows_of
from shelfmark.plans.oracle import SQL
from shelfmark.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    mine = QUERIES[name](spark, DATA).toPandas()
    theirs = db.execute(SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows_of(mine) == rows_of(theirs)
