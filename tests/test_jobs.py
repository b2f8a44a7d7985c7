"""The training, monitoring and re-training jobs end to end on the smallest data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import alerts
from tallyfold.plans import jobs
from tallyfold.plans.queries_tables import write_sources
from tallyfold.sources import adapters, files, runs

SF = "/root/testdata/sf0.001"
QUICK = jobs.Settings(
    products=adapters.FORECAST_TYPES,
    demand_params={"rounds": 3, "rate": 0.3},
    churn_params={"rounds": 3, "rate": 0.3},
    restarts=1,
)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    stages = jobs.training_job(spark, write_sources(spark, SF), root, QUICK)
    return root, {r.stage: (r.status, r.message) for r in stages.collect()}


def test_every_stage_succeeds(trained):
    assert {name: s for name, s in trained[1].items() if s[0] != "ok"} == {}


def test_forecast_bounds(spark, trained):
    fc = files.scan_parquet(spark, f"{trained[0]}/demand_forecast")
    assert fc.where("NOT (0 <= lower_bound AND lower_bound <= predicted_revenue AND predicted_revenue <= upper_bound)").isEmpty()
    sizes = {(r.product, r.horizon): r["count"] for r in fc.groupBy("product", "horizon").count().collect()}
    assert all(n == horizon for (_, horizon), n in sizes.items())
    assert len(sizes) == 2 * len(adapters.FORECAST_TYPES)


def test_predictions_and_segments(spark, trained):
    p = files.scan_parquet(spark, f"{trained[0]}/churn_predictions")
    assert p.where("churn_probability NOT BETWEEN 0 AND 1 OR segment_name IS NULL").isEmpty()
    assert p.count() == files.scan_parquet(spark, f"{trained[0]}/rfm_features").count()


def test_runs_are_stored(spark, trained):
    stored = runs.run_metrics_scan(spark, f"{trained[0]}/runs")
    assert {r.experiment for r in stored.select("experiment").distinct().collect()} == {
        "demand_forecasting", "rfm_clustering", "churn_classification", "monitoring"}
    total = stored.where("experiment = 'monitoring'").select(F.col("metrics")["combined_roi_pct"]).first()[0]
    assert total == 310.90


def test_retraining_follows_critical_alerts(spark, trained):
    report = spark.range(1).select(
        F.lit(0.5).alias("current_mape"), F.lit(0.2).alias("baseline_mape"),
        F.lit(0.75).alias("current_pr_auc"), F.lit(0.75).alias("baseline_pr_auc"), F.lit(0.05).alias("psi"))
    plan = jobs.retraining_job(spark, trained[0], report, QUICK).collect()
    assert [r.model for r in plan] == [alerts.DEMAND_MODEL]
    again = runs.run_metrics_scan(spark, f"{trained[0]}/runs").where("experiment = 'monitoring_retrain'")
    assert again.first()["tags"]["model_name"] == alerts.DEMAND_MODEL
    assert again.first()["metrics"]["n_products"] == len(adapters.FORECAST_TYPES)
