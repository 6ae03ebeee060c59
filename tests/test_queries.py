"""Registered queries against their DuckDB twins; `compare.py` runs all of them at any scale."""

import duckdb
import pytest

import __spark_entry__ as registry
from compare import difference, open_duckdb

SF = "/root/testdata/sf0.001"

CHECKED = (
    "normalize_id", "normalize_date", "normalize_date_fallback", "csv_by_heading", "csv_counts", "json_array", "normalize_boolean", "title_case", "dedup_exact",
    "first_non_null_per_key", "latest_snapshot", "school_master_clean", "attendance_clean",
    "procurement_clean", "infra_current", "scores_clean", "audit_counts", "attendance_daily",
    "district_summary", "kpi_scoped", "monthly_trend", "proxy_top20", "welfare_risk", "workbook_scan",
)


@pytest.fixture(scope="module")
def connection():
    return open_duckdb(SF)


def test_every_query_has_a_twin():
    school = {name for name in registry.queries() if not name.startswith("op") and name != "pipeline"}
    assert school <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_twin(spark, connection, name):
    df = registry.queries()[name](spark, SF)
    assert difference(df, connection, registry.oracle_sql()[name]) is None


def test_twins_are_valid_sql(connection):
    for name, sql in registry.oracle_sql().items():
        assert isinstance(connection.execute(f"EXPLAIN {sql}"), duckdb.DuckDBPyConnection), name


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() > 0 and "district" in df.columns
