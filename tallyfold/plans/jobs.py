"""Multi-stage jobs: training, monitoring and re-training.

Stages exchange stored tables only. A failed stage is recorded and the next one still
runs; the outcome of every stage goes to the run store.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators import (
    alerts,
    classification,
    cleaning,
    customers,
    demand,
    drift,
    forecasting,
    roi,
    segmentation,
)
from tallyfold.scratch import materialise, stage_folder
from tallyfold.session import configure
from tallyfold.sources import files, runs

log = logging.getLogger(__name__)

CLUSTERS = 5

# Financial inputs of the monitoring report and the assumed quality.
FORECAST_SCENARIO = {
    "mape_baseline": 0.35, "mape_model": 0.14, "avg_daily_revenue": 1500.0, "waste_rate": 0.08,
    "stockout_rate": 0.05, "margin": 0.60, "infra_cost_monthly": 300.0,
}
CHURN_SCENARIO = {
    "n_churners_detected": 28, "retention_rate": 0.30, "avg_monthly_revenue_per_customer": 120.0,
    "margin": 0.60, "campaign_cost_per_customer": 15.0, "infra_cost_monthly": 150.0,
}
ASSUMED_QUALITY = {
    "current_mape": 0.14, "baseline_mape": 0.35, "current_pr_auc": 0.73, "baseline_pr_auc": 0.75,
}


@dataclass(frozen=True)
class Layout:
    """Where a job keeps its tables, below one shared folder."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass
class Settings:
    """Model settings of a job; the defaults are those of the operators."""

    products: Sequence[str] = field(default_factory=lambda: cleaning.FORECAST_PRODUCTS)
    demand_params: dict = field(default_factory=dict)
    churn_params: dict = field(default_factory=dict)
    restarts: int = segmentation.RESTARTS
    threshold: float = classification.DEFAULT_THRESHOLD
    churn_window_days: int = customers.CHURN_WINDOW_DAYS


def scenario(spark: SparkSession, values: dict) -> DataFrame:
    """One scenario row from literal inputs."""
    return spark.range(1).select(F.lit("default").alias("scenario"), *[F.lit(v).alias(k) for k, v in values.items()])


def append_run(spark: SparkSession, path: str, experiment: str, name: str, row: DataFrame,
               metrics: Sequence[str], tags: dict[str, str] | None = None) -> None:
    """Store a one-row result as a run that starts now."""
    pairs = [F.lit(v) for kv in (tags or {}).items() for v in kv]
    tag_map = F.create_map(*pairs) if pairs else None
    run_id = F.lit(f"{name}-{uuid.uuid4().hex[:8]}")
    now = F.current_timestamp().cast("timestamp_ntz")
    stored = runs.as_runs(row, experiment, run_id, now, metrics, tags=tag_map)
    runs.run_metrics_append(stored.withColumn("run_name", F.lit(name)), path)


def run_stages(spark: SparkSession, layout: Layout, stages: Sequence[tuple[str, Callable[[], None]]]) -> DataFrame:
    """Run all stages in order and return ``stage, status, elapsed, message``."""
    done = []
    for name, stage in stages:
        start = time.time()
        try:
            with stage_folder(spark):
                stage()
            done.append((name, "ok", time.time() - start, ""))
        except Exception as error:  # one failed stage must not stop the others
            log.exception("stage %s failed", name)
            done.append((name, "failed", time.time() - start, str(error)[:500]))
    table = spark.createDataFrame(done, "stage string, status string, elapsed double, message string")
    files.sink_parquet(table, layout.stages)
    return files.scan_parquet(spark, layout.stages)


# -- training ------------------------------------------------------------------------------


def train_demand(spark: SparkSession, layout: Layout, settings: Settings) -> None:
    """Three candidates on the last 30 days; the champion forecasts 7 and 30 days from the full history."""
    features = files.scan_parquet(spark, layout.demand_features)
    split = materialise(forecasting.temporal_split_by_product(features), "split")
    candidates = forecasting.demand_candidates(split, settings.demand_params)
    files.sink_parquet(forecasting.demand_leaderboard(candidates), layout.demand_leaderboard)
    best = files.scan_parquet(spark, layout.demand_leaderboard).where("place = 1")
    name = best.first()["model"]
    champion = candidates[name]
    files.sink_parquet(forecasting.backtest_bands(champion.tested), layout.backtest_forecast)
    append_run(spark, layout.runs, "demand_forecasting", "pipeline_demand", best,
               ["mae", "rmse", "mape", "n_products"], {"model_name": alerts.DEMAND_MODEL, "champion": name})
    steps = forecasting.recursive_forecast(features, champion.predict, forecasting.HOLD_OUT_DAYS)
    bounded = forecasting.forecast_interval(steps, forecasting.residual_spread(champion.tested))
    files.sink_parquet(forecasting.union_horizons(materialise(bounded, "forecast")), layout.demand_forecast)


def train_clustering(spark: SparkSession, layout: Layout, settings: Settings) -> None:
    rows = segmentation.vectors(files.scan_parquet(spark, layout.rfm_features))
    fit = segmentation.kmeans_segments(rows, CLUSTERS, restarts=settings.restarts)
    labelled = materialise(fit.rows.drop("features"), "clusters")
    quality = segmentation.linear_quality(fit.rows).withColumn("inertia", F.lit(float(fit.inertia)))
    append_run(spark, layout.runs, "rfm_clustering", "pipeline_kmeans", quality,
               ["silhouette_squared", "davies_bouldin", "inertia"])
    names = segmentation.name_clusters_ladder(segmentation.cluster_summary(labelled))
    files.sink_parquet(segmentation.customer_segments(labelled, names), layout.customer_segments)


def train_churn(spark: SparkSession, layout: Layout, settings: Settings) -> None:
    rows = files.scan_parquet(spark, layout.churn_features)
    split = materialise(classification.stratified_split(rows), "churn-split")
    models = classification.churn_candidates(split.where("part = 'train'"), {"gbt": settings.churn_params})
    files.sink_parquet(
        classification.churn_leaderboard(models, split.where("part = 'test'")), layout.churn_leaderboard
    )
    best = files.scan_parquet(spark, layout.churn_leaderboard).where("place = 1")
    name = best.first()["model"]
    append_run(spark, layout.runs, "churn_classification", "pipeline_churn", best,
               ["precision", "recall", "f1", "roc_auc", "pr_auc"],
               {"model_name": alerts.CHURN_MODEL, "champion": name})
    segments = files.scan_parquet(spark, layout.customer_segments)
    scored = classification.score_customers(models[name], rows, segments, settings.threshold)
    files.sink_parquet(scored, layout.churn_predictions)


def training_job(spark: SparkSession, raw_paths: Sequence[str], root: str,
                 settings: Settings | None = None, skip_training: bool = False) -> DataFrame:
    """Raw files to features, models, predictions and the monitoring run."""
    configure(spark)
    layout, settings = Layout(root), settings or Settings()

    def transactions() -> DataFrame:
        return files.scan_parquet(spark, layout.transactions)

    def raw_sales() -> DataFrame:
        return cleaning.coerce_types(files.scan_csv(spark, layout.sales_csv))

    stages: list[tuple[str, Callable[[], None]]] = [
        ("ingest", lambda: cleaning.ingest(spark, layout.sales_csv, raw_paths=raw_paths)),
        ("preprocess", lambda: files.sink_parquet(cleaning.preprocess(raw_sales()), layout.transactions)),
        ("demand_features", lambda: files.sink_parquet(
            demand.demand_features(transactions(), settings.products), layout.demand_features)),
        # Customer tables start from the validated rows, outliers included.
        ("rfm_features", lambda: files.sink_parquet(customers.rfm_features(raw_sales()), layout.rfm_features)),
    ]
    if not skip_training:
        stages += [
            ("train_clustering", lambda: train_clustering(spark, layout, settings)),
            ("churn_features", lambda: files.sink_parquet(
                customers.churn_features(
                    raw_sales(), files.scan_parquet(spark, layout.rfm_features),
                    files.scan_parquet(spark, layout.customer_segments), settings.churn_window_days,
                ), layout.churn_features)),
            ("train_demand", lambda: train_demand(spark, layout, settings)),
            ("train_churn", lambda: train_churn(spark, layout, settings)),
        ]
    stages.append(("monitoring", lambda: monitoring_job(spark, root)))
    return run_stages(spark, layout, stages)


# -- monitoring ------------------------------------------------------------------------------


def measured_quality(spark: SparkSession, layout: Layout) -> dict[str, float]:
    """MAPE and PR-AUC of the two newest runs of each model; assumed figures stand in for missing ones."""
    found = dict(ASSUMED_QUALITY)
    if not files.path_exists(spark, layout.runs):
        return found
    stored = runs.run_metrics_scan(spark, layout.runs)
    for experiment, metric, scale in (("demand_forecasting", "mape", 0.01), ("churn_classification", "pr_auc", 1.0)):
        newest = (
            stored.where((F.col("experiment") == experiment) & F.col("metrics")[metric].isNotNull())
            .orderBy(F.col("start_time").desc(), F.col("run_id").desc())
            .limit(2)
            .select(F.col("metrics")[metric].alias("value"))
            .collect()
        )
        for which, row in zip(("current", "baseline"), newest):
            found[f"{which}_{metric}"] = float(row["value"]) * scale
    return found


def monitoring_job(spark: SparkSession, root: str, mode: str = "position",
                   quality: dict | None = None) -> dict[str, DataFrame]:
    """Drift, concept drift, alerts and returns; stored below ``root`` and appended as a run.

    Alerts judge the ``quality`` given, else what the run store measured, else the assumed figures.
    """
    layout = Layout(root)
    quality = quality or measured_quality(spark, layout)
    features = files.scan_parquet(spark, layout.demand_features)
    drifted = materialise(drift.data_drift(demand.halves(features, mode)), "drift-report")
    report = drifted.agg(F.coalesce(F.max("psi"), F.lit(0.0)).alias("psi")).select(
        *[F.lit(v).alias(k) for k, v in quality.items()], "psi"
    )
    raised = materialise(alerts.alerts(report), "alerts")
    forecast_roi = roi.roi_forecast(scenario(spark, FORECAST_SCENARIO))
    churn_roi = roi.roi_churn(scenario(spark, CHURN_SCENARIO))
    total = roi.roi_total(forecast_roi, churn_roi, "scenario")
    out = {"drift": drifted, "alerts": raised, "forecast_roi": forecast_roi, "churn_roi": churn_roi,
           "total_roi": total}
    if files.path_exists(spark, layout.runs):
        history = runs.run_metrics_scan(spark, layout.runs).where(
            F.lower("experiment").contains("demand") & F.col("metrics")["mape"].isNotNull()
        )
        out["concept_drift"] = drift.concept_drift(history, "mape")
    for name, table in out.items():
        files.sink_parquet(table, f"{layout.monitoring}/{name}")
        out[name] = files.scan_parquet(spark, f"{layout.monitoring}/{name}")

    wide = drifted.groupBy().pivot("feature", drift.DRIFT_FEATURES).agg(
        F.first("psi").alias("psi"), F.first("ks_statistic").alias("ks_stat"),
        F.first("ks_p_value").alias("ks_pval"), F.first(F.col("drift_detected").cast("int")).alias("flag"),
    )
    flags = [F.coalesce(F.col(f"{f}_flag"), F.lit(0)) for f in drift.DRIFT_FEATURES]
    counts = alerts.alert_counts(raised).select(F.struct("critical", "warning")).scalar()
    returns = total.select(F.struct("total_net_benefit", "total_cost", "combined_roi_pct")).scalar()
    row = wide.withColumns(
        {
            "drift_detected": F.greatest(*flags),
            "alerts_critical": counts["critical"],
            "alerts_warning": counts["warning"],
            **{c: returns[c] for c in ("total_net_benefit", "total_cost", "combined_roi_pct")},
        }
    )
    metrics = [c for c in row.columns if not c.endswith("_flag")]
    append_run(spark, layout.runs, "monitoring", "monitoring_report", row, metrics, {"pipeline": "monitoring"})
    return out


# -- re-training -----------------------------------------------------------------------------


def retrain_demand(spark: SparkSession, layout: Layout, settings: Settings) -> DataFrame:
    features = files.scan_parquet(spark, layout.demand_features)
    return forecasting.retrain_errors(features, settings.demand_params)


def retrain_churn(spark: SparkSession, layout: Layout, settings: Settings) -> DataFrame:
    split = materialise(
        classification.stratified_split(files.scan_parquet(spark, layout.churn_features)), "churn-split"
    )
    model = classification.churn_gbt(split.where("part = 'train'"), params=settings.churn_params)
    return classification.classifier_metrics(classification.score(model, split.where("part = 'test'")))


RETRAINERS = {
    alerts.DEMAND_MODEL: (retrain_demand, ["mape", "mae", "n_products"]),
    alerts.CHURN_MODEL: (retrain_churn, ["pr_auc"]),
}


def retraining_job(spark: SparkSession, root: str, report: DataFrame, settings: Settings | None = None,
                   experiment: str = "monitoring_retrain") -> DataFrame:
    """Re-train what the critical alerts of a report ask for; returns the plan that was run."""
    configure(spark)
    layout, settings = Layout(root), settings or Settings()
    plan = materialise(alerts.retrain_plan(alerts.alerts(report)), "plan")
    # One row per alert and model: at most four.
    for line in plan.collect():
        trainer, metrics = RETRAINERS[line["model"]]
        append_run(spark, layout.runs, experiment, f"auto_retrain_{line['model']}",
                   trainer(spark, layout, settings), metrics,
                   {"trigger": "auto_retrain", "model_name": line["model"],
                    "trigger_reason": line["trigger_reason"]})
    return plan
