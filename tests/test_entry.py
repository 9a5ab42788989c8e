"""The driver contract, on the smallest test tables when they are there."""

import os

import pytest

import __spark_entry__ as entry

TABLES = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    """Queries of models and heuristics are the exception; their own tests hold them."""
    assert set(entry.QUERIES) == set(entry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize(
    "name", ["capacity_factor_monthly", "load_versions", "rules_counts", "change_history", "report_headlines", "responses_by_position"]
)
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from tools.check_oracle import TABLES as NAMES
    from tools.check_oracle import rows_of

    database = duckdb.connect()
    for table in NAMES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    df = entry.queries()[name](spark, TABLES)
    cursor = database.execute(entry.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["trailing_window"](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "o_orderstatus" not in plan


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_rules_reach_the_scan(spark):
    plan = entry.queries()["rules_pass"](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,5.0), LessThanOrEqual(value,150.0)" in plan
