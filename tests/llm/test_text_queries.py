"""Registered text queries: against their SQL, and the shape their contracts fix."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import difference, make_duckdb
from tallyfold.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return make_duckdb(SF)


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, catalog.CHECKS[name]) == ""


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


COLUMNS = {
    "op3_weighted_fingerprints": [
        ("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"),
        ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")],
    "op7_mix_sources": [
        ("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")],
    "op9_shingle_join": [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")],
    "op10_secret_scans": [("doc_id", "bigint"), ("n_assign", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op13_personal_data": [
        ("doc_id", "bigint"), ("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"),
        ("base_sha256", "string"), ("spans", "string")],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_of_contracts(spark, name):
    out = catalog.QUERIES[name](spark, SF)
    assert set(COLUMNS[name]) <= set(out.dtypes)
    assert out.count() == 200
