"""Orders, quantiles, drift, alerts, returns, forecasts and classifier metrics."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import alerts, classification, decisions, drift, forecasting as fc, ordering, roi, segmentation
from tallyfold.sources import runs


NAN = float("nan")


# -- orders ----------------------------------------------------------------------


def test_quantiles_match_numpy_with_a_hot_value_and_hot_group(spark):
    rng = np.random.default_rng(0)
    hot = np.concatenate([np.full(4000, 7.0), rng.normal(7, 3, 1500)])
    cold = rng.random(11)
    pdf = pd.DataFrame({"g": ["hot"] * len(hot) + ["cold"] * 11, "v": np.concatenate([hot, cold])})
    probs = [0.0, 0.1, 0.25, 0.5, 0.85, 1.0]
    got = {r.g: r for r in ordering.exact_quantiles(spark.createDataFrame(pdf), "v", probs, ["g"]).collect()}
    assert np.allclose(got["hot"].quantiles, np.quantile(hot, probs)) and got["hot"].n == len(hot)
    assert np.allclose(got["cold"].quantiles, np.quantile(cold, probs))


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.permutation(3000), "w": rng.integers(0, 9, 3000)})
    got = ordering.running_totals(spark.createDataFrame(pdf), ["k"], ["w"]).toPandas().sort_values("k")
    want = pdf.sort_values("k")["w"].cumsum()
    assert got["w_upto"].tolist() == want.tolist() and set(got["w_total"]) == {pdf["w"].sum()}


@pytest.mark.parametrize("target", ["1b", "3kb", "64mb"])
def test_global_rank_is_unique_on_ties(spark, target):
    """With all slices kept, some merged, and all merged."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": target,
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
                "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    df = spark.range(5000).select((F.col("id") % 3).alias("v"), "id")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = ordering.global_rank(df, ["v", "id"]).orderBy("v", "id").toPandas()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert got["rank"].tolist() == list(range(1, 5001))


# -- drift -----------------------------------------------------------------------


def counted_psi(reference, current, bins=10):
    """Straight from the definition: shares per bin between the percentiles of the reference."""
    cuts = sorted({float(np.quantile(reference, i / bins)) for i in range(bins + 1)})
    total = 0.0
    for low, high in zip(cuts, cuts[1:]):
        def share(values):
            inside = sum(low <= v < high or (high == cuts[-1] and v == high) for v in values)
            return inside / len(values) + drift.EPSILON

        expected, actual = share(reference), share(current)
        total += (actual - expected) * math.log(actual / expected)
    return total


def sided(spark, **pairs):
    parts = []
    for name, (a, b) in pairs.items():
        parts += [(name, "reference", float(v)) for v in a] + [(name, "current", float(v)) for v in b]
    return spark.createDataFrame(parts, "feature string, side string, value double")


@pytest.fixture(scope="module")
def shifts():
    rng = np.random.default_rng(42)
    base = rng.normal(0, 1, 1000)
    return {
        "same": (base, rng.normal(0, 1, 1000)),
        "shift": (base, rng.normal(5, 1, 1000)),
        "outside": (np.arange(100.0), np.arange(50.0, 250.0)),
        "constant": (np.full(50, 3.0), np.arange(50.0)),
        "few": (np.repeat([1.0, 2.0, 3.0], [700, 200, 100]), np.repeat([1.0, 2.0, 3.0], [200, 200, 600])),
    }


def test_psi_matches_numpy(spark, shifts):
    got = {r.feature: r.psi for r in drift.psi(sided(spark, **shifts)).collect()}
    assert set(got) == set(shifts)
    for name, (a, b) in shifts.items():
        assert math.isclose(got[name], counted_psi(a, b), abs_tol=1e-9), name
    assert got["same"] < 0.05 and got["shift"] > 0.2 and got["constant"] == 0.0


def test_ks_matches_definition(spark, shifts):
    got = {r.feature: r for r in drift.ks_two_sample(sided(spark, **shifts)).collect()}
    for name, (a, b) in shifts.items():
        at = np.union1d(a, b)
        d = np.abs(np.searchsorted(np.sort(a), at, "right") / len(a) - np.searchsorted(np.sort(b), at, "right") / len(b)).max()
        assert math.isclose(got[name].ks_statistic, d, abs_tol=1e-12)
    assert got["same"].ks_statistic < 0.1 and got["shift"].ks_statistic > 0.8 and got["shift"].ks_p_value < 1e-6


def test_data_drift_skips_missing_and_empty_features(spark):
    df = spark.createDataFrame([("reference", 1.0, None), ("current", 2.0, 3.0), ("reference", 2.0, None)], "side string, a double, b double")
    got = drift.data_drift(df, ["a", "b", "absent"]).collect()
    assert [r.feature for r in got] == ["a"]


def history(spark, values, key="mape"):
    rows = [("e", str(i), str(i), dt.datetime(2024, 1, 1) + dt.timedelta(days=i), {key: float(v)}, {}, {}) for i, v in enumerate(values)]
    from tallyfold.schemas import RUN_METRICS

    return spark.createDataFrame(rows, RUN_METRICS)


@pytest.mark.parametrize("values, flagged", [(np.linspace(0.15, 0.161, 12), False), ([0.1] * 6 + [0.2] * 6, True), ([0.2] * 6 + [0.1] * 6, True), ([0.3], False)])
def test_concept_drift(spark, values, flagged):
    row = drift.concept_drift(history(spark, values), "mape").first()
    base = np.mean(values[: max(1, len(values) // 4)])
    assert row.drift_detected is flagged and math.isclose(row.baseline_value, base)
    assert row.degradation_pct == pytest.approx(round((values[-1] - base) / base, 4))


def test_concept_drift_direction_empty_and_unknown(spark):
    better = history(spark, [0.2] * 6 + [0.1] * 6)
    assert drift.concept_drift(better, "mape", direction="up").first().drift_detected is False
    assert drift.concept_drift(better.limit(0), "mape").collect() == []
    with pytest.raises(Exception, match="not found"):
        drift.concept_drift(better, "pr_auc").collect()


# -- alerts and returns ------------------------------------------------------------


def pair(spark, current, baseline):
    return spark.createDataFrame([(current, baseline)], "current double, baseline double")


def around(limit):
    """Relative changes below, between and above half the limit and the limit."""
    return [(0.0, "ok"), (limit * 0.6, "warning"), (limit * 1.4, "critical"), (-limit, "ok")]


@pytest.mark.parametrize("change, severity", around(alerts.MAPE_THRESHOLD))
def test_forecast_alert(spark, change, severity):
    row = alerts.alert_forecast(pair(spark, 8.0 * (1 + change), 8.0)).first()
    assert (row.severity, row.alert) == (severity, severity != "ok") and "MAPE" in row.message


@pytest.mark.parametrize("change, severity", around(alerts.PR_AUC_THRESHOLD))
def test_churn_alert(spark, change, severity):
    assert alerts.alert_churn(pair(spark, 0.6 * (1 - change), 0.6)).first().severity == severity


def test_alerts_need_a_positive_baseline(spark):
    for baseline in (0.0, -2.0):
        assert alerts.alert_forecast(pair(spark, 9.0, baseline)).first().severity == "ok"
        assert alerts.alert_churn(pair(spark, 0.1, baseline)).first().severity == "ok"


def test_drift_alert_limits_belong_to_the_higher_level(spark):
    cases = [(0.0, "ok"), (np.nextafter(alerts.PSI_WARNING, 0), "ok"), (alerts.PSI_WARNING, "warning"),
             (np.nextafter(alerts.PSI_CRITICAL, 0), "warning"), (alerts.PSI_CRITICAL, "critical"), (7.0, "critical")]
    got = alerts.alert_drift(spark.createDataFrame([(float(v),) for v, _ in cases], "psi double")).collect()
    assert [r.severity for r in got] == [s for _, s in cases]


def test_missing_scores_do_not_win_or_count(spark):
    means = spark.createDataFrame([("a", 5.0), ("b", None), ("c", NAN)], "model string, mape double")
    assert tuple(fc.select_champion(means).first()) == ("a", 5.0)
    rows = spark.createDataFrame([("x", 10.0, None), ("x", 10.0, 10.0)], "product string, revenue double, prediction double")
    scored = fc.forecast_metrics(rows).first()
    assert (scored.mae, scored.mape) == (0.0, 0.0)


def test_nan_features_are_left_out_of_drift(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(0, 1, 300), rng.normal(1, 1, 300)
    clean = {r.feature: r for r in drift.data_drift(wide(spark, a, b), ["v"]).collect()}
    dirty = {r.feature: r for r in drift.data_drift(wide(spark, [*a, NAN], [*b, NAN, NAN]), ["v"]).collect()}
    assert clean["v"] == dirty["v"]


def wide(spark, reference, current):
    rows = [("reference", float(v)) for v in reference] + [("current", float(v)) for v in current]
    return spark.createDataFrame(rows, "side string, v double")


def test_products_without_sales_keep_their_rows(spark):
    from tallyfold.operators import demand

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    columns = [*demand.MODEL_FEATURES, "revenue"]
    rows = [(p, d, *[float((i * 7 + j) % 5) * level for j in range(len(columns))]) for p, level in (("a", 1.0), ("zero", 0.0)) for i, d in enumerate(days)]
    schema = "product string, date date, " + ", ".join(f"{c} double" for c in columns)
    table = spark.createDataFrame(rows, schema)
    model = fc.train_demand_gbt(table, {"rounds": 2})
    new = table.unionByName(table.where("product = 'a'").withColumn("product", F.lit("new")))
    got = {r.product: (r.n, r.low, r.missing) for r in fc.predict_demand(model, new).groupBy("product").agg(
        F.count("*").alias("n"), F.max("prediction").alias("low"), F.count_if(F.col("prediction").isNull()).alias("missing")).collect()}
    assert got["zero"] == (40, 0.0, 0) and got["new"] == (40, None, 40) and got["a"][2] == 0


def test_absent_sections_raise_no_check(spark):
    report = spark.createDataFrame([(None, None, 0.5, 0.75, 0.3)], "current_mape double, baseline_mape double, current_pr_auc double, baseline_pr_auc double, psi double")
    raised = alerts.alerts(report)
    assert [r.check_no for r in raised.orderBy("check_no").collect()] == [2, 3]
    counts = alerts.alert_counts(raised).first()
    assert (counts.checks, counts.active, counts.critical, counts.warning) == (2, 2, 2, 0)
    plan = sorted(r.model for r in alerts.retrain_plan(raised).collect())
    assert plan == [alerts.CHURN_MODEL, alerts.CHURN_MODEL, alerts.DEMAND_MODEL]


def test_returns_match_the_published_report(spark):
    from tallyfold.plans import jobs

    f = roi.roi_forecast(jobs.scenario(spark, jobs.FORECAST_SCENARIO))
    c = roi.roi_churn(jobs.scenario(spark, jobs.CHURN_SCENARIO))
    one, two, both = f.first(), c.first(), roi.roi_total(f, c, "scenario").first()
    assert (one.waste_savings, one.stockout_recovery, one.total_benefit, one.roi_pct, one.payback_days) == (2160.0, 810.0, 2970.0, 890.0, 3.0)
    assert (two.customers_retained, two.revenue_saved, two.total_cost, two.net_benefit, two.roi_pct) == (8.4, 604.8, 570.0, 34.8, 6.11)
    assert (both.total_net_benefit, both.total_cost, both.combined_roi_pct) == (2704.8, 870.0, 310.9)


def test_no_gain_has_no_payback(spark):
    from tallyfold.plans import jobs

    worse = jobs.scenario(spark, {**jobs.FORECAST_SCENARIO, "mape_model": 0.5, "infra_cost_monthly": 0.0})
    row = roi.roi_forecast(worse).first()
    assert (row.total_benefit, row.roi_pct, row.payback_days) == (0.0, 0.0, None)


# -- run store -----------------------------------------------------------------------


def test_best_runs_and_status_defaults(spark):
    table = history(spark, [30.0, 10.0, 20.0]).withColumn("experiment", F.lit("Demand_X"))
    best = {r.area: r.run_name for r in runs.best_runs(table).collect()}
    assert best == {"demand": "1"}
    status = runs.model_status(table).first()
    assert (status.mape, status.pr_auc, status.silhouette) == (10.0, 0.0, 0.0)
    assert (status.demand_status, status.churn_status, status.clustering_status) == ("OK", "Critical", "Warning")


# -- forecasts -----------------------------------------------------------------------


def seasonal(spark, days=400, products=("a", "b")):
    start = dt.date(2023, 1, 1)
    rows = []
    for j, p in enumerate(products):
        for i in range(days):
            d = start + dt.timedelta(days=i)
            rows.append((p, d, 100.0 * (j + 1) + 10 * d.weekday() + 5 * math.sin(2 * math.pi * i / 365.25)))
    return spark.createDataFrame(rows, "product string, date date, revenue double")


def with_features(spark, df):
    from tallyfold.operators import cleaning, demand

    return df.transform(demand.lag_features).transform(demand.rolling_features).transform(cleaning.calendar_features)


def test_both_splits_hold_out_the_same_days(spark):
    f = with_features(spark, seasonal(spark, 100))
    a = fc.temporal_split(f).where("part = 'test'").select("product", "date")
    b = fc.temporal_split_by_product(f).where("part = 'test'").select("product", "date")
    assert a.count() == 60 and a.exceptAll(b).isEmpty()


def test_metrics_skip_zero_truth_and_clip(spark):
    df = spark.createDataFrame([("a", 0.0, 5.0), ("a", 10.0, -5.0), ("z", 0.0, 1.0)], "product string, revenue double, prediction double")
    got = {r["product"]: r for r in fc.forecast_metrics(df).collect()}
    assert got["a"].mape == 100.0 and got["a"].mae == 7.5 and got["z"].mape is None
    assert {r["product"]: r.mae for r in fc.forecast_metrics(df, clip=False).collect()}["a"] == 10.0
    assert fc.mean_metrics(fc.forecast_metrics(df)).first().mape == 100.0


def test_unseen_weekday_takes_the_training_mean(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 0, 4.0, "train"), ("a", dt.date(2024, 1, 2), 1, 8.0, "train"),
                                ("a", dt.date(2024, 1, 8), 0, 1.0, "test"), ("a", dt.date(2024, 1, 10), 2, 1.0, "test")],
                               "product string, date date, day_of_week int, revenue double, part string")
    assert {r.date.day: r.prediction for r in fc.seasonal_naive(df).collect()} == {8: 4.0, 10: 6.0}


def test_seasonal_regression_beats_the_naive_forecast_on_a_seasonal_series(spark):
    split = fc.temporal_split(with_features(spark, seasonal(spark)))
    betas = fc.fit_seasonal_regression(fc.part(split, "train"))
    ours = fc.mean_metrics(fc.forecast_metrics(fc.predict_seasonal_regression(fc.part(split, "test"), betas))).first()
    naive = fc.mean_metrics(fc.forecast_metrics(fc.seasonal_naive(split))).first()
    assert ours.mape < 0.2 and ours.mape < naive.mape


def test_trees_and_recursion(spark):
    f = with_features(spark, seasonal(spark, 200))
    split = fc.temporal_split(f)
    model = fc.train_demand_gbt(fc.part(split, "train").where("date >= '2023-02-01'"), {"rounds": 15, "rate": 0.3, "subsample": 1.0})
    errors = fc.mean_metrics(fc.forecast_metrics(fc.predict_demand(model, fc.part(split, "test")))).first()
    assert errors.mape < 5
    steps = fc.recursive_forecast(f, lambda r: fc.predict_demand(model, r), 12, store_every=5)
    out = steps.where("product = 'b'").orderBy("step").toPandas()
    assert out["date"].iloc[0] == dt.date(2023, 7, 20) and len(out) == 12
    assert out["predicted_revenue"].between(150, 300).all()


def test_decomposition_recovers_a_weekly_pattern(spark):
    df = seasonal(spark, 70, ("a",))
    out = fc.seasonal_decompose(df, "revenue", 7).toPandas().sort_values("date")
    assert out["trend"].isna().sum() == 6 and abs(out["seasonal"].iloc[:7].sum()) < 1e-6
    assert out["residual"].abs().max() < 2.5


# -- decisions -----------------------------------------------------------------------


def test_churn_window_prefers_the_shortest_balanced_one(spark):
    stats = spark.createDataFrame([(d,) for d in [5] * 3 + [50] * 3 + [100] * 4], "recency_days int")
    assert decisions.choose_churn_window(decisions.churn_balance(stats)).first()[:3] == (30, 30.0, "classification")
    rare = spark.createDataFrame([(d,) for d in [5] * 19 + [100]], "recency_days int")
    assert decisions.choose_churn_window(decisions.churn_balance(rare)).first().approach == "anomaly_detection"


# -- classifier metrics ------------------------------------------------------------------


def brute_metrics(y, s, t=0.5):
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    ap = prev = 0.0
    for v in np.sort(np.unique(s))[::-1]:
        hit = s >= v
        recall = y[hit].sum() / y.sum()
        ap += (recall - prev) * y[hit].mean()
        prev = recall
    flag = s >= t
    p, r = y[flag].mean(), y[flag].sum() / y.sum()
    return {"roc_auc": auc, "pr_auc": ap, "precision": p, "recall": r, "f1": 2 * p * r / (p + r)}


def test_classifier_metrics_match_brute_force(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 600)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # many tied scores
    df = spark.createDataFrame(pd.DataFrame({"churn": y, "churn_probability": s}))
    row = classification.classifier_metrics(df).first().asDict()
    for name, want in brute_metrics(y, s).items():
        assert math.isclose(row[name], want, abs_tol=1e-12), name
    none = classification.classifier_metrics(df, threshold=2.0).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("card"), (F.col("id") % 10 < 3).cast("int").alias("churn"))
    a = classification.stratified_split(df)
    sizes = {(r.churn, r.part): r["count"] for r in a.groupBy("churn", "part").count().collect()}
    assert sizes == {(1, "test"): 60, (1, "train"): 240, (0, "test"): 140, (0, "train"): 560}
    assert a.exceptAll(classification.stratified_split(df.repartition(3))).isEmpty()


def test_classifiers_learn_and_rank_features(spark):
    rng = np.random.default_rng(0)
    n = 400
    x = rng.random(n)
    pdf = pd.DataFrame({"card": [f"c{i}" for i in range(n)], "recency_norm": x, "frequency_norm": rng.random(n),
                        "monetary": 1.0, "segment_name": rng.choice(["Loyal", "Lost"], n), "churn": (x + rng.normal(0, 0.1, n) < 0.3).astype(int)})
    df = spark.createDataFrame(pdf)
    for name, params in (("logistic", {}), ("forest", {"trees": 10}), ("gbt", {"rounds": 5, "rate": 0.3})):
        model = classification.TRAINERS[name](df, params=params)
        out = classification.score_customers(model, df)
        assert out.where("churn_probability NOT BETWEEN 0 AND 1").isEmpty()
        scored = classification.score(model, df)
        assert classification.classifier_metrics(scored).first().roc_auc > 0.9
        assert classification.feature_importance(model).first().feature == "recency_norm"


# -- clusters ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.05, (40, 3)) for c in ([0.2] * 3, [0.8] * 3, [0.2, 0.8, 0.5])])
    label = np.repeat([0, 1, 2], 40)
    pdf = pd.DataFrame(x, columns=["recency_norm", "frequency_norm", "monetary_norm"]).assign(card=[f"c{i}" for i in range(120)], cluster_id=label)
    return x, label, spark.createDataFrame(pdf)


def test_quality_matches_definition(spark, blobs):
    x, label, df = blobs
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    s = []
    for i in range(len(x)):
        a = d[i, label == label[i]].sum() / ((label == label[i]).sum() - 1)
        b = min(d[i, label == c].mean() for c in set(label) - {label[i]})
        s.append((b - a) / max(a, b))
    noise = df.union(df.limit(1).withColumn("cluster_id", F.lit(-1).cast("bigint")).withColumn("card", F.lit("noise")))
    got = segmentation.silhouette_rows(noise, block_rows=32).agg(F.avg("silhouette")).first()[0]
    assert math.isclose(got, np.mean(s), abs_tol=1e-12)
    c = np.array([x[label == k].mean(0) for k in range(3)])
    w = [np.sqrt(((x[label == k] - c[k]) ** 2).sum(1)).mean() for k in range(3)]
    db = np.mean([max((w[i] + w[j]) / np.linalg.norm(c[i] - c[j]) for j in range(3) if j != i) for i in range(3)])
    assert math.isclose(segmentation.davies_bouldin(noise).first()[0], db, abs_tol=1e-12)


def test_one_cluster_is_an_error(spark, blobs):
    with pytest.raises(ValueError, match="two clusters"):
        segmentation.davies_bouldin(blobs[2].withColumn("cluster_id", F.lit(0)))


def test_kmeans_finds_the_blobs(spark, blobs):
    fit = segmentation.kmeans_segments(segmentation.vectors(blobs[2].drop("cluster_id")), 3, restarts=3)
    pairs = fit.rows.toPandas().set_index("card")["cluster_id"]
    assert len({(blobs[1][i], pairs[f"c{i}"]) for i in range(120)}) == 3
    assert segmentation.centroid_table(fit).count() == 3


def test_ladder_swaps_the_first_two_names(spark):
    schema = "cluster_id int, recency_days double, frequency double"
    calm = spark.createDataFrame([(0, 5.0, 9.0), (1, 20.0, 3.0), (2, 90.0, 1.0)], schema)
    busy = spark.createDataFrame([(0, 5.0, 3.0), (1, 20.0, 9.0), (2, 90.0, 1.0)], schema)
    late = spark.createDataFrame([(0, 5.0, 3.0), (1, 20.0, 1.0), (2, 90.0, 9.0)], schema)
    names = [{r.cluster_id: r.segment_name for r in segmentation.name_clusters_ladder(s).collect()} for s in (calm, busy, late)]
    assert names[0] == names[2] == {0: "Champions", 1: "Loyal", 2: "Potential"}
    assert names[1] == {1: "Champions", 0: "Loyal", 2: "Potential"}


def test_champion_needs_little_noise(spark):
    km = spark.createDataFrame([(0.4,)], "silhouette double")
    rows = [(0.9, 60, 100, "kmeans"), (0.9, 50, 100, "dbscan"), (0.4, 0, 100, "kmeans"), (None, 0, 100, "kmeans")]
    for s, noise, n, want in rows:
        db = spark.createDataFrame([(s, noise, n)], "silhouette double, n_noise int, n_rows int")
        assert segmentation.cluster_champion(km, db).first().champion == want


def test_silhouette_meets_every_pair_of_blocks_once(spark):
    """Each distance is computed once for both ends; blocks, tiles and clusters of one row may not lose any."""
    rng = np.random.default_rng(5)
    x, c = rng.random((301, 3)), np.append(rng.integers(0, 3, 300), 7)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    mean = np.array([[d[i, c == k].sum() / max((c == k).sum() - (c[i] == k), 1) for k in (0, 1, 2, 7)] for i in range(301)])
    at = np.searchsorted([0, 1, 2, 7], c)
    a = mean[np.arange(301), at]
    mean[np.arange(301), at] = np.inf
    want = np.where(c == 7, 0.0, (mean.min(axis=1) - a) / np.maximum(a, mean.min(axis=1)))
    rows = spark.createDataFrame([(f"p{i:03d}", *map(float, p), int(k)) for i, (p, k) in enumerate(zip(x, c))],
                                 "card string, recency_norm double, frequency_norm double, monetary_norm double, cluster_id int")
    for block_rows in (40, 1000):
        table = segmentation.silhouette_rows(rows, block_rows=block_rows)
        got = {r.card: r.silhouette for r in table.collect()}
        assert np.allclose([got[f"p{i:03d}"] for i in range(301)], want, rtol=0, atol=1e-12)
    parts = {k: (int(np.flatnonzero(np.sort(c) == k)[0]), int(np.flatnonzero(np.sort(c) == k)[-1]) + 1) for k in (0, 1, 2, 7)}
    order = np.argsort(c, kind="stable")
    both = segmentation._distance_sums(x[order], x[order], parts, parts)
    assert np.allclose(both[0], both[1]) and np.allclose(both[0].sum(axis=1), d[order].sum(axis=1))


def test_nearest_centres_keep_the_first_of_ties():
    x = np.array([[0.0, 0.0], [1.0, 0.0], [0.5, 0.0], [3.0, 4.0]])
    near, least = segmentation._nearest(segmentation._squares(x, np.array([[0.0, 0.0], [1.0, 0.0], [1.0, 0.0]])))
    assert near.tolist() == [0, 1, 0, 1] and least.tolist() == [0.0, 0.0, 0.25, 20.0]


def test_run_table_joins_sales_once(spark, monkeypatch):
    """Errors by month, customers and churn labels read one stored table of sales."""
    from tallyfold.plans import inputs
    lines = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), "card", f"{i % 7}", 10.0 + i % 5, "LARGE") for i in range(120)]
    sales = spark.createDataFrame(lines, "datetime timestamp_ntz, cash_type string, card string, money double, coffee_name string")
    people = spark.createDataFrame([(i, i % 2) for i in range(7)], "c_custkey bigint, c_nationkey int")
    calls = []
    monkeypatch.setattr(inputs, "sales", lambda *a: calls.append(a) or sales)
    monkeypatch.setattr(inputs.adapters, "table", lambda *a: people)
    found = {r.experiment: r.n for r in inputs.run_table(spark, "").groupBy("experiment").agg(F.count("*").alias("n")).collect()}
    assert len(calls) == 1
    assert found == {"demand_forecasting": 4, "monitoring": 3, "churn_classification": 2}


def test_exact_silhouette_copies_a_row_to_few_blocks():
    """A row is met by every block, so copies grew with the square of the rows; blocks of large tables grow first, up to a bound."""
    assert segmentation.pair_blocks(0) == segmentation.pair_blocks(32_768) == 1 and segmentation.pair_blocks(900_000) == 28
    assert segmentation.pair_blocks(5_400_000) == 44
    for n in (10**6, 10**7, 10**8):
        blocks = segmentation.pair_blocks(n)
        assert n / blocks <= segmentation.MOST_PAIR_ROWS and blocks <= max(44, n / segmentation.MOST_PAIR_ROWS + 1)
