"""Every query with a SQL counterpart gives the same rows as DuckDB."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import assert_same
from retailflow.oracle import ORACLE
from retailflow.workload import QUERIES, drop_scratch_databases

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), ORACLE[name], SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_stored_tables_can_be_dropped(spark):
    QUERIES["describe_fact"](spark, SF_DIR).collect()
    drop_scratch_databases(spark)
    assert not [r for r in spark.sql("SHOW DATABASES LIKE 'retail_*'").collect()]


def test_entry(spark):
    assert entry(spark).columns == ["product_name", "total_sold_units"]
    assert entry(spark).count() == 10
