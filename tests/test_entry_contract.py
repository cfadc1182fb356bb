"""Driver contract: entry() has a stable schema; every query returns a
DataFrame whose columns are exactly its oracle's columns."""

from tests.conftest import SF001
from riskloom.oracle.compare import duckdb_connection

from __spark_entry__ import entry, oracle_sql, queries


def test_entry_schema_is_stable(spark):
    assert entry(spark).schema == entry(spark).schema


def test_query_columns_equal_oracle_columns(spark):
    con = duckdb_connection(SF001)
    for name, sql in oracle_sql().items():
        cols = queries()[name](spark, SF001).columns
        ocols = [d[0] for d in con.execute(f"SELECT * FROM ({sql}) q LIMIT 0").description]
        assert sorted(cols) == sorted(ocols), name
