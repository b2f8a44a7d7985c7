"""Registered queries against their SQL checks.

A selection runs by default. ``TALLYFOLD_ALL=1`` runs every one; ``tests/compare.py``
does the same with timings.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import difference, make_duckdb

SF = os.environ.get("TALLYFOLD_SF", "/root/testdata/sf0.001")
SELECTION = [
    "scan_merge_sources", "validate_schema", "preprocess", "demand_features", "own_range_calendar",
    "rfm_features_events", "rfm_quintiles", "churn_features", "decision_log", "describe_numeric",
    "segment_profile", "temporal_split_by_product", "select_demand_champion", "seasonal_decompose",
    "data_drift", "alert_forecast", "roi_total", "best_runs", "sales_heatmap", "top_churn_risk",
    "classifier_metrics", "threshold_table", "silhouette_euclid",
]
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return make_duckdb(SF)


@pytest.mark.parametrize("name", list(CHECKS) if os.environ.get("TALLYFOLD_ALL") else SELECTION)
def test_query_agrees_with_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, CHECKS[name]) == ""


def test_every_check_belongs_to_a_query():
    assert set(CHECKS) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "product"
