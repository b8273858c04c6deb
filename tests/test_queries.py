"""Registered queries next to their DuckDB statements on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import check_oracle
from txlake.plans.oracle import ORACLE
from txlake.plans.registry import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUICK = """
bronze_frame wire_validate wire_validate_tx ingest_run_stats cast_extract dq_rule_counts quarantine
dedup_latest upsert_merge upsert_moved_day quarantine_append report_roundtrip quality_profile quality_gate daily_volume_by_country account_velocity
fraud_signals heuristic_score drift_report deciles average_precision stratified_split
q1_top_countries q4_high_velocity_accounts q6_highest_scores kpi_row
""".split()
NAMES = list(all_queries()) if os.environ.get("ALL_QUERIES") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert check_oracle.compare(spark, con, SF_DIR, name, entry.queries()[name], sql) is None


def test_entry_and_registry(spark):
    assert entry.entry(spark).columns[:2] == ["event_date", "country"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all_queries().keys() == ORACLE.keys()
