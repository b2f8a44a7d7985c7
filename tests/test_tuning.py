"""Batched fits against plain single fits on the same rows."""

from __future__ import annotations

import itertools
import math
import threading

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import classification as cl, segmentation as sg, tuning
from tallyfold.scratch import materialise

FOLDS = 3


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(4)
    rows = []
    for i in range(240):
        a, b = r.normal(), r.normal() * 3 + 1
        y = float(r.random() < 1 / (1 + math.exp(-(a - 0.4 * b))))
        rows.append((f"c{i}", i % FOLDS, y, a, b, 7.0))
    return spark.createDataFrame(rows, "key string, fold int, y double, x0 double, x1 double, x2 double"), rows


def test_logistic_fits_are_optima_of_their_pairs(points):
    table, rows = points
    penalties = [0.01, 1.0, 50.0]
    fits = tuning.logistic_fits(table, 3, FOLDS, penalties)
    assert set(fits) == set(itertools.product(range(3), range(FOLDS)))
    for (t, f), beta in fits.items():
        rest = [r for r in rows if r[1] != f]
        x, y = np.array([r[3:] for r in rest]), np.array([r[2] for r in rest])
        scale = x.std(axis=0, ddof=1)
        z = np.where(scale > 0, (x - x.mean(axis=0)) / np.where(scale > 0, scale, 1), 0)
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        p = 1 / (1 + np.exp(-(x @ beta[:-1] + beta[-1])))
        slope = z.T @ (w * (p - y)) + np.where(scale > 0, beta[:-1] * scale, 0) / penalties[t]
        assert np.abs(slope).max() < 1e-5 and abs((w * (p - y)).sum()) < 1e-5


def test_every_family_scores_every_row_of_its_fold_once(points):
    table, rows = points
    fits = tuning.logistic_fits(table, 3, FOLDS, [1.0, 2.0])
    scored = [tuning.logistic_scores(table, 3, fits, 2)]
    small = [{"rounds": 10, "depth": 2, "rate": 0.3, "subsample": 1.0, "columns": 1.0}] * 2
    scored.append(tuning.tree_scores(table, 3, FOLDS, "gbt", small))
    scored.append(tuning.tree_scores(table, 3, FOLDS, "forest", [{"trees": 10, "depth": 3}] * 2))
    for table_ in scored:
        got = table_.groupBy("trial", "fold").agg(F.count("*").alias("n"), F.corr("y", "probability").alias("r")).collect()
        assert len(got) == 2 * FOLDS and all(g["n"] == 80 and g["r"] > 0.2 for g in got)
    for family in ("gbt", "forest"):
        params = [{"rounds": 3, "depth": 2, "rate": 0.3, "trees": 3}]
        again = [sorted(map(tuple, tuning.tree_scores(table, 3, FOLDS, family, params).collect())) for _ in range(2)]
        assert again[0] == again[1]


def test_one_class_has_no_fit(spark, points):
    table = points[0].withColumn("y", F.lit(1.0))
    assert tuning.logistic_fits(table, 3, FOLDS, [1.0]) == {}
    assert tuning.logistic_scores(table, 3, {}, 1).count() == 0
    held = tuning.tree_scores(table, 3, FOLDS, "gbt", [{"rounds": 2, "depth": 2}])
    assert held.where("probability IS NOT NULL").count() == 0 and held.count() == 240
    assert tuning.logistic_fits(table.limit(0), 3, FOLDS, [1.0]) == {}


def test_search_orders_settings_by_average_precision(spark):
    rows = [(f"c{i}", i % 2, float(i % 2) + (i % 7) / 5, i, None if i % 5 == 0 else "Loyal") for i in range(60)]
    table = spark.createDataFrame(rows, "card string, churn int, recency_norm double, frequency int, segment_name string")
    for family, space in (("logistic", None), ("gbt", {"rounds": (2, 4), "depth": (1, 2)}), ("forest", {"trees": (2, 4), "depth": (1, 2)})):
        out = cl.tune_churn(table, family, trials=3, folds=3, space=space).collect()
        assert [r["pr_auc"] for r in out] == sorted((r["pr_auc"] for r in out), reverse=True)
        assert sorted(r["trial"] for r in out) == [0, 1, 2] and all(0.5 < r["pr_auc"] <= 1 for r in out)


@pytest.fixture(scope="module")
def blobs(spark):
    r = np.random.default_rng(6)
    centres = [(0, 0, 0), (5, 0, 0), (0, 5, 0), (0, 0, 5)]
    rows = [(f"c{i}", *(float(v) for v in r.normal(centres[i % 4], 0.3))) for i in range(200)]
    rows += [("c0", *rows[0][1:])] * 20 + [("gone", None, 1.0, 1.0), ("bad", float("nan"), 1.0, 1.0)]
    return spark.createDataFrame(rows, "card string, recency_norm double, frequency_norm double, monetary_norm double"), rows


def test_all_starts_share_passes_and_end_at_fixed_points(blobs):
    table, rows = blobs
    x = np.array([r[1:] for r in rows if None not in r and r[1] == r[1]])
    best = sg.kmeans_runs(table, [2, 4, 6], restarts=4)
    for k, run in best.items():
        squares = ((x[:, None] - run.centres[None]) ** 2).sum(axis=2)
        near = squares.argmin(axis=1)
        for c in np.unique(near):
            assert np.abs(x[near == c].mean(axis=0) - run.centres[c]).max() <= 1e-4
        assert math.isclose(squares.min(axis=1).sum(), run.cost, rel_tol=1e-9)
    assert best[4].cost < 0.1 * best[2].cost and len(np.unique(best[4].centres.round(1), axis=0)) == 4
    alone = sg.kmeans_runs(table, [4], restarts=4)[4]
    assert np.allclose(alone.centres, best[4].centres)
    placed = sg.place_rows(table, best[4].centres)
    assert placed.where("cluster_id IS NULL").count() == 2 and placed.count() == len(rows)


def test_sweep_measures_equal_those_of_pairs(spark, blobs):
    table, rows = blobs
    x = np.array([r[1:] for r in rows if None not in r and r[1] == r[1]])
    best = sg.kmeans_runs(table, [3, 5], restarts=2)
    for line in sg.sweep_quality(table, best).collect():
        near = ((x[:, None] - best[line["k"]].centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        widths = []
        for i in range(len(x)):
            own = near == near[i]
            a = far[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else None
            b = min(far[i, near == c].mean() for c in set(near) - {near[i]})
            widths.append(0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b))
        assert math.isclose(np.mean(widths), line["silhouette_squared"], abs_tol=1e-9)
        means = {c: x[near == c].mean(axis=0) for c in set(near)}
        spread = {c: np.linalg.norm(x[near == c] - means[c], axis=1).mean() for c in means}
        worst = [max((spread[a] + spread[b]) / np.linalg.norm(means[a] - means[b]) for b in means if b != a) for a in means]
        assert math.isclose(np.mean(worst), line["davies_bouldin"], rel_tol=1e-9)


def test_fewer_rows_than_centres(spark):
    table = spark.createDataFrame([("a", 1.0, 1.0, 1.0)] * 3 + [("b", 2.0, 2.0, 2.0)],
                                  "card string, recency_norm double, frequency_norm double, monetary_norm double")
    run = sg.kmeans_runs(table, [4], restarts=2)[4]
    assert run.cost == 0.0 and sg.place_rows(table, run.centres).select("cluster_id").distinct().count() == 2
    assert sg.kmeans_runs(table.limit(0), [2], restarts=1)[2].cost == 0.0


def test_a_newton_pass_takes_few_products_whatever_the_pairs(spark, points, monkeypatch):
    """The logistic curve is asked once a batch and step for all settings and folds together."""
    calls, keep = [], tuning.boosting.logistic
    monkeypatch.setattr(tuning.boosting, "logistic", lambda x: calls.append(x.shape) or keep(x))
    table, rows = points

    class Here:
        """Rows in this process, so that calls can be counted."""

        def mapInArrow(self, run, schema):
            batches = pa.Table.from_batches(table.toArrow().to_batches()).combine_chunks().to_batches()
            return spark.createDataFrame([r for b in run(iter(batches)) for r in map(tuple, (d.values() for d in b.to_pylist()))], schema)

    monkeypatch.setattr(tuning, "fold_moments", lambda points, width, folds, known=tuning.fold_moments: known(table, width, folds))
    fits = tuning.logistic_fits(Here(), 3, FOLDS, [0.01, 1.0, 50.0])
    assert calls[0] == (len(rows), 3 * FOLDS) and len(calls) <= tuning.NEWTON_STEPS
    apart = tuning.logistic_fits(table, 3, FOLDS, [0.01, 1.0, 50.0])
    assert all(np.allclose(fits[p], apart[p], rtol=1e-6, atol=1e-9) for p in fits)


def test_fits_pass_over_a_multiple_of_the_cores(spark):
    """One part more than cores doubles the time of a pass; few parts stay."""
    cores = spark.sparkContext.defaultParallelism

    def stored(parts, rows=5000):
        table = materialise(spark.range(rows).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("s")).repartition(parts))
        read = table.rdd.getNumPartitions()
        return table, read

    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        many, read = stored(3)
        assert read > cores and read % cores
        even = cl.even_parts(many)
        assert even.count() == 5000 and even.select("id").distinct().count() == 5000 and even.stored_at != many.stored_at
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    few, read = stored(3)
    assert read <= cores and cl.even_parts(few) is few
    # As many files as cores are read as so many parts, whatever their size.
    assert stored(cores)[1] == cores


def test_every_pair_of_a_tree_search_has_a_task_of_its_own_the_longest_first(points):
    """Dealt by a hash, some tasks had several of the longest fits and others none."""
    settings = [{"rounds": r, "depth": 2, "rate": 0.3} for r in (2, 9, 5, 2, 9, 5)]
    scored = tuning.tree_scores(points[0], 3, FOLDS, "gbt", settings).withColumn("part", F.spark_partition_id())
    held = {r["part"]: (r["pairs"], r["trial"]) for r in scored.groupBy("part").agg(
        F.count_distinct("trial", "fold").alias("pairs"), F.first("trial").alias("trial")).collect()}
    assert sorted(held) == list(range(6 * FOLDS)) and all(n == 1 for n, _ in held.values())
    assert [held[p][1] for p in sorted(held)] == [t for t in (1, 4, 2, 5, 0, 3) for _ in range(FOLDS)]


def test_candidates_are_fitted_side_by_side(spark, monkeypatch):
    """Every fit waits for the others to begin, which no fit after another survives."""
    met = threading.Barrier(len(cl.TRAINERS))

    def trainer(family):
        def fit(train, label, params, **layout):
            met.wait(timeout=60)
            return family, train.count(), label, params, sorted(layout)

        return fit

    monkeypatch.setattr(cl, "TRAINERS", {family: trainer(family) for family in cl.TRAINERS})
    models = cl.churn_candidates(spark.range(7), {"gbt": {"rounds": 3}})
    assert list(models) == ["logistic", "forest", "gbt"]
    assert [m[0] for m in models.values()] == list(models) and all(m[1:3] == (7, "churn") for m in models.values())
    assert models["gbt"][3] == {"rounds": 3} and models["forest"][3:] == (None, ["laid_out"])


def test_a_long_fit_keeps_to_half_of_the_cores(spark, monkeypatch):
    half = spark.sparkContext.defaultParallelism // 2
    table = materialise(spark.range(4000).repartition(2 * half))
    assert cl.half_parts(table) is table  # passes over so few rows hold up nobody
    monkeypatch.setattr(cl, "HALF_ROWS", (100, 2000))
    laid = cl.half_parts(table)
    assert laid.rdd.getNumPartitions() == half and laid.count() == laid.distinct().count() == 4000
    monkeypatch.setattr(cl, "HALF_ROWS", (1, 10))
    assert cl.half_parts(table) is table  # too many rows for so few tasks


def test_a_tree_search_takes_all_rows(spark):
    """Every row is in the fits and scored, also beyond the 20,000 rows once drawn; no setting gets a shuffled copy."""
    rows = 26_000
    table = materialise(spark.range(rows).select(
        F.col("id").cast("string").alias("key"), F.floor(F.col("id") / 8 % 2).cast("int").alias("fold"),
        (F.col("id") % 8 < 2).cast("double").alias("y"), (F.col("id") % 8).cast("double").alias("x0"),
    ))
    for family in ("gbt", "forest"):
        setting = {"rounds": 1, "trees": 1, "depth": 1, "rate": 1.0, "columns": 1.0, "penalty": 0.0}
        scored = tuning.tree_scores(table, 1, 2, family, [setting])
        assert "Exchange" not in scored._jdf.queryExecution().toString()
        got = scored.groupBy("trial", "fold").agg(F.count("probability").alias("n"), F.corr("y", "probability").alias("r")).collect()
        assert sorted((g["fold"], g["n"]) for g in got) == [(0, rows // 2), (1, rows // 2)]
        assert all(g["r"] == pytest.approx(1.0) for g in got)


def test_columns_searched_apart_give_the_same_trees(monkeypatch):
    r = np.random.default_rng(8)
    x = np.where(r.random((700, 6)) < 0.5, r.integers(0, 4, (700, 6)), r.normal(size=(700, 6)))
    y = (x[:, 0] + r.normal(size=700) > 0.5).astype(float)
    settings = {"rounds": 6, "depth": 5, "subsample": 0.8, "loss": "logistic"}
    together = tuning.boosting.fit_trees(x, y, settings)
    monkeypatch.setattr(tuning.boosting, "VALUES_AT_ONCE", 700)
    apart = tuning.boosting.fit_trees(x, y, settings)
    assert all(np.array_equal(getattr(together, k), getattr(apart, k)) for k in ("feature", "threshold", "value"))


def test_cluster_searches_run_side_by_side(spark, monkeypatch):
    """Each search waits for the other to begin."""
    from tallyfold.plans import queries_models

    met = threading.Barrier(2)

    def sweep(rows):
        met.wait(timeout=60)
        return spark.createDataFrame([(3, 0.25), (4, 0.5)], "k int, silhouette_squared double")

    def search(rows):
        met.wait(timeout=60)
        return spark.createDataFrame([(0.75, 5, 10)], "silhouette double, n_noise long, n_rows long")

    monkeypatch.setattr(sg, "k_sweep", sweep)
    monkeypatch.setattr(queries_models.density, "dbscan_search", search)
    assert [tuple(r) for r in queries_models.champion_of(spark.range(1)).collect()] == [(0.5, 0.75, True, "dbscan")]
