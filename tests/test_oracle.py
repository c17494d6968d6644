import duckdb
import pytest

from __spark_entry__ import entry
from check_oracle import TABLES, compare
from tierflow.workloads.oracle import SQL
from tierflow.workloads.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    rows, verdict = compare(spark, connection, name, SF)
    assert verdict == "ok"
    assert rows > 0


def test_entry(spark):
    assert entry(spark).count() > 0
