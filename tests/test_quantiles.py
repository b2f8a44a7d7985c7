"""Exact quantiles by refinement against numpy, at sizes that need several passes."""

from __future__ import annotations

import numpy as np
import pytest

from tallyfold.operators import ordering

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def expected(values):
    with np.errstate(invalid="ignore"):
        return np.quantile(values, PROBS)


@pytest.mark.parametrize("slice_, buckets, groups", [(100_000, 4096, 10_000), (30, 32, 10_000), (10, 10, 1)])
def test_quantiles_equal_numpy(spark, monkeypatch, slice_, buckets, groups):
    monkeypatch.setattr(ordering, "MAX_SLICE", slice_)
    monkeypatch.setattr(ordering, "BUCKETS", buckets)
    monkeypatch.setattr(ordering, "MAX_GROUPS", groups)
    r = np.random.default_rng(slice_)
    data = {
        "normal": r.normal(size=300), "hot": np.concatenate([np.zeros(300), r.normal(size=60)]), "one": np.array([4.5]),
        "wide": 10.0 ** r.uniform(-300, 300, 40), "signed": np.array([-0.0, 0.0, 1.0, -1.0]), "same": np.full(50, 7.25),
        "huge": np.array([-1.7e308, 1.7e308, 0.0, 5.0]),
    }
    rows = [(g, float(v)) for g, values in data.items() for v in values]
    rows += [("normal", None), ("normal", float("nan")), (None, 1.0), ("empty", None)]
    table = spark.createDataFrame(rows, "g string, v double")
    got = {x["g"]: x for x in ordering.exact_quantiles(table, "v", PROBS, ["g"]).collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        assert got[g]["n"] == len(values)
        ordered = np.sort(values)
        place = (len(values) - 1) * np.array(PROBS)
        low, high, t = ordered[np.floor(place).astype(int)], ordered[np.ceil(place).astype(int)], place - np.floor(place)
        with np.errstate(over="ignore"):
            want = np.where(t == 0, low, low + (high - low) * t)
        assert np.allclose(got[g]["quantiles"], want, rtol=1e-12, atol=0), g
        if g not in ("wide", "huge"):
            assert np.allclose(want, expected(values))


@pytest.mark.parametrize("slice_", [1, 100_000])
def test_whole_tables_infinite_and_missing_values(spark, monkeypatch, slice_):
    monkeypatch.setattr(ordering, "MAX_SLICE", slice_)
    monkeypatch.setattr(ordering, "BUCKETS", 4)
    values = [float("inf"), float("-inf"), 1.0, 2.0, 3.0, 4.0, 5.0]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    assert ordering.exact_quantiles(table, "v", [0.5]).first()["quantiles"] == [3.0]
    nothing = ordering.exact_quantiles(table.limit(0), "v", [0.5, 0.9]).collect()
    assert len(nothing) == 1 and nothing[0]["quantiles"] == [None, None]
    assert ordering.exact_quantiles(table.limit(0).selectExpr("v", "'a' AS g"), "v", [0.5], ["g"]).collect() == []


def test_rows_are_not_shuffled_by_value(spark):
    """A pass over a large interval groups by bucket: no range exchange, no exchange of values."""
    table = spark.range(100).selectExpr("CAST(id AS double) AS v", "1 AS k", "CAST(0 AS double) AS lo")
    plan = ordering.exact_quantiles(table, "v", [0.5])._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()
