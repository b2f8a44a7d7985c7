"""Boosted trees per group against trees grown by trying every split."""

from __future__ import annotations

import numpy as np
import pytest

from tallyfold.operators import boosting, forecasting as fc


def brute_tree(x, y, depth, min_rows, min_gain=0.0):
    """Prediction of one full-rate tree on the residuals of the mean."""
    base = y.mean()
    out = np.full(len(y), base)

    def grow(rows, depth):
        g = base - y[rows]
        best = None
        for c in range(x.shape[1]) if depth else ():
            for at in np.unique(x[rows, c])[:-1]:
                left = x[rows, c] <= at
                n, m = left.sum(), (~left).sum()
                if min(n, m) < min_rows:
                    continue
                gain = g[left].sum() ** 2 / (n + 1) + g[~left].sum() ** 2 / (m + 1) - g.sum() ** 2 / (n + m + 1)
                if gain > max(min_gain, 1e-12) and (best is None or gain > best[0] + 1e-9):
                    best = gain, left
        if best is None:
            out[rows] += -g.sum() / (len(rows) + 1)
        else:
            grow(rows[best[1]], depth - 1)
            grow(rows[~best[1]], depth - 1)

    grow(np.arange(len(y)), depth)
    return out


@pytest.mark.parametrize("seed", range(25))
def test_one_round_equals_trying_every_split(seed):
    r = np.random.default_rng(seed)
    n, depth, min_rows = int(r.integers(1, 60)), int(r.integers(1, 5)), int(r.integers(1, 5))
    x = np.column_stack([r.normal(size=n).round(1), r.integers(0, 4, n), np.zeros(n)])
    x[r.random(x.shape) < 0.05] = -np.inf
    y, gain = r.normal(size=n), float(r.choice([0.0, 1.0]))
    trees = boosting.fit_trees(x, y, {"rounds": 1, "depth": depth, "rate": 1.0, "min_rows": min_rows, "min_gain": gain})
    assert np.allclose(boosting.predict_trees(trees, x), brute_tree(x, y, depth, min_rows, gain))


def test_rounds_add_up_and_blocks_do_not_matter():
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 4))
    y = x[:, 0] * 2 + (x[:, 1] > 0)
    one = {"rate": 1.0, "depth": 3}
    first = boosting.predict_trees(boosting.fit_trees(x, y, {"rounds": 1, **one}), x)
    second = boosting.predict_trees(boosting.fit_trees(x, y, {"rounds": 2, **one}), x)
    rest = y - first
    assert np.abs(y - second).mean() < np.abs(rest).mean()
    trees = boosting.fit_trees(x, y, {"rounds": 50, "subsample": 0.7, "columns": 0.5})
    assert np.allclose(boosting.predict_trees(trees, x), boosting.predict_trees(trees, x, block=100))
    again = boosting.fit_trees(x, y, {"rounds": 50, "subsample": 0.7, "columns": 0.5})
    assert (again.value == trees.value).all() and np.sqrt(((boosting.predict_trees(trees, x) - y) ** 2).mean()) < y.std() / 2


ROWS = "product string, date date, a double, b int, y double, part string"


def test_groups_are_fitted_apart(spark):
    r = np.random.default_rng(2)
    data = []
    for product, n in (("p", 40), ("q", 25), ("one", 1), (None, 12), ("none", 3)):
        for i in range(n):
            a, y = float(r.normal()), float(r.normal())
            data.append((product, f"2024-01-{i % 28 + 1:02d}", None if i % 9 == 4 else a, int(r.integers(0, 3)),
                         None if product == "none" or i % 11 == 10 else y, "test" if i % 5 == 0 else "train"))
    rows = spark.createDataFrame(data, ROWS.replace("date date", "date string")).selectExpr(
        "product", "CAST(date AS date) AS date", "a", "b", "y", "part", "1 AS trial")
    one = [{"rounds": 1, "depth": 2, "rate": 1.0}] * 2
    trees = boosting.fit_groups(rows, "product", ["a", "b"], "y", "date", one)
    assert {t["product"] for t in trees.collect()} == {"p", "q", "one", None}
    got = boosting.predict_groups(rows, trees, "product", ["a", "b"]).toPandas()
    assert len(got) == len(data) and got[got["product"] == "none"]["prediction"].isna().all()
    for product, mine in got.groupby("product", dropna=False):
        known = mine[mine["y"].notna()]
        if len(known):
            x = np.nan_to_num(known[["a", "b"]].to_numpy(float), nan=-np.inf)
            assert np.allclose(known["prediction"], brute_tree(x, known["y"].to_numpy(), 2, 1)), product
    assert boosting.fit_groups(rows.limit(0), "product", ["a", "b"], "y", "date", one).count() == 0

    tried = boosting.try_settings(rows.selectExpr("*", "part = 'test' AS asked"), "product", ["a", "b"], "y", "date",
                                  [{"rounds": 1, "depth": 2, "rate": 1.0}, {"rounds": 1, "depth": 1, "rate": 0.5}], "asked")
    held = tried.toPandas()
    assert sorted(held["trial"].unique()) == [0, 1] and len(held) == 2 * sum(1 for d in data if d[5] == "test")
    apart = boosting.fit_groups(rows.where("part = 'train'"), "product", ["a", "b"], "y", "date", one, "trial")
    again = boosting.predict_groups(rows.where("part = 'test'"), apart, "product", ["a", "b"]).toPandas()
    first = held[held["trial"] == 0]
    assert np.allclose(sorted(first["prediction"].dropna()), sorted(again["prediction"].dropna()))


def test_products_that_never_sold_are_predicted_as_zero(spark):
    days = [("idle", f"2024-01-{i + 1:02d}", 0.0) for i in range(20)]
    lags = ["CAST(0 AS double) AS " + c for c in ("lag_1", "lag_7", "lag_14", "rolling_mean_7", "rolling_mean_14")]
    rows = spark.createDataFrame(days, "product string, date string, revenue double").selectExpr(
        "product", "CAST(date AS date) AS date", "revenue", *lags, "dayofweek(date) AS day_of_week", "0 AS is_weekend", "1 AS month")
    model = fc.train_demand_gbt(rows, {"rounds": 5})
    assert fc.predict_demand(model, rows).agg({"prediction": "max"}).first()[0] == 0.0
    assert fc.retrain_errors(rows.limit(0)).first()["n_products"] == 0
