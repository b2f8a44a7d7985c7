"""Registered queries: drift, alerts, return on investment, run store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import alerts, demand, drift, forecasting as fc, profiles, reports, roi
from tallyfold.plans import inputs, jobs, sqltext as S
from tallyfold.plans.queries_forecast import METRICS, stored_demand
from tallyfold.plans.registry import query
from tallyfold.scratch import materialise, scratch_path
from tallyfold.sources import adapters, files, runs

# -- drift -----------------------------------------------------------------------

POSITION_SIDES = """sided AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY product, date) <= count(*) OVER () // 2
                 THEN 'reference' ELSE 'current' END AS side FROM demand)"""
TIME_SIDES = """sided AS (
  SELECT demand.*, CASE WHEN date < lo + CAST((hi - lo + 1) // 2 AS INTEGER) THEN 'reference' ELSE 'current' END AS side
  FROM demand, (SELECT min(date) AS lo, max(date) AS hi FROM demand))"""

DRIFT = """long AS (
""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, side, CAST({c} AS DOUBLE) AS value FROM sided" for c in drift.DRIFT_FEATURES
) + """),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS edges
  FROM long WHERE side = 'reference' GROUP BY 1),
binned AS (
  SELECT feature, side, CASE WHEN value BETWEEN edges[1] AND edges[-1]
           THEN least(len(list_filter(edges, lambda e: e <= value)), len(edges) - 1) END AS bin, count(*) AS n
  FROM long JOIN edges USING (feature) GROUP BY ALL),
totals AS (
  SELECT feature, sum(n) FILTER (side = 'reference') AS r, sum(n) FILTER (side = 'current') AS c FROM binned GROUP BY 1),
cells AS (
  SELECT g.feature, g.bin, coalesce(sum(n) FILTER (side = 'current'), 0) / any_value(c) + 1e-6 AS pc,
         coalesce(sum(n) FILTER (side = 'reference'), 0) / any_value(r) + 1e-6 AS pr
  FROM (SELECT feature, unnest(generate_series(1, len(edges) - 1)) AS bin FROM edges) g
  JOIN totals USING (feature) LEFT JOIN binned b ON b.feature = g.feature AND b.bin = g.bin GROUP BY 1, 2),
psi AS (SELECT feature, sum((pc - pr) * ln(pc / pr)) AS psi FROM cells GROUP BY 1),
steps AS (
  SELECT feature, sum(r) OVER w / sum(r) OVER f AS fr, sum(c) OVER w / sum(c) OVER f AS fcur,
         CAST(sum(r) OVER f AS DOUBLE) AS nr, CAST(sum(c) OVER f AS DOUBLE) AS nc
  FROM (SELECT feature, value, count(*) FILTER (side = 'reference') AS r, count(*) FILTER (side = 'current') AS c
        FROM long GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature)),
ks0 AS (SELECT feature, max(abs(fr - fcur)) AS d, sqrt(max(nr) * max(nc) / (max(nr) + max(nc))) AS root FROM steps GROUP BY 1),
ks AS (
  SELECT feature, d AS ks_statistic,
         CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2.0 * list_sum(list_transform(range(1, 101),
           lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))))) END AS ks_p_value
  FROM (SELECT *, (root + 0.12 + 0.11 / root) * d AS lam FROM ks0))"""

REPORT = """report AS (
  SELECT feature, round_even(psi, 4) AS psi, round_even(ks_statistic, 4) AS ks_statistic,
         round_even(ks_p_value, 4) AS ks_p_value, max(psi.psi) OVER () > 0.2 AS drift_detected
  FROM psi JOIN ks USING (feature))"""


def drift_sql(body: str, *more: str, sides: str = POSITION_SIDES) -> str:
    return S.demand_sql(body, sides, DRIFT, REPORT, *more)


def sided(spark, sf_dir, mode: str = "position") -> DataFrame:
    return demand.halves(stored_demand(spark, sf_dir), mode)


def paired(spark, sf_dir) -> DataFrame:
    return drift.paired_values(sided(spark, sf_dir))


@query("psi", drift_sql("SELECT * FROM psi"), "psi:9")
def _(spark, sf_dir):
    return drift.psi(paired(spark, sf_dir))


@query("ks_two_sample", drift_sql("SELECT * FROM ks"), "ks_statistic:9 ks_p_value:9")
def _(spark, sf_dir):
    return drift.ks_two_sample(paired(spark, sf_dir))


@query("data_drift", drift_sql("SELECT * FROM report"))
def _(spark, sf_dir):
    return drift.data_drift(sided(spark, sf_dir))


@query("data_drift_time", drift_sql("SELECT * FROM report", sides=TIME_SIDES))
def _(spark, sf_dir):
    return drift.data_drift(sided(spark, sf_dir, "time"))


@query("psi_status", drift_sql("""
SELECT feature, psi, CASE WHEN psi > 0.2 THEN 'CRITICAL' WHEN psi > 0.1 THEN 'warning' ELSE 'ok' END AS status FROM report"""))
def _(spark, sf_dir):
    report = drift.data_drift(sided(spark, sf_dir))
    return drift.psi_status(report).select("feature", "psi", "status")


# -- run store ---------------------------------------------------------------------

SCORES = """labelled AS (
  SELECT r.*, b.churn, 0.6 * (1 - recency_norm) + 0.4 * (1 - frequency_norm) AS churn_probability
  FROM rfm r JOIN beh b USING (card))"""

AP = """byscore AS (
  SELECT {by} AS grp, churn_probability AS s, count(*) FILTER (churn = 1) AS pos, count(*) FILTER (churn = 0) AS neg
  FROM {source} GROUP BY 1, 2),
cum AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS p, sum(neg) OVER g AS n
  FROM byscore WINDOW w AS (PARTITION BY grp ORDER BY s DESC), g AS (PARTITION BY grp)),
quality0 AS (
  SELECT grp, sum(pos) FILTER (s >= 0.5) AS hit, sum(pos + neg) FILTER (s >= 0.5) AS flagged, max(p) AS p,
         CASE WHEN max(p) * max(n) > 0 THEN sum(neg * (tp - pos / 2)) / (max(p) * max(n)) END AS roc_auc,
         coalesce(sum(CASE WHEN p > 0 THEN pos / p * tp / (tp + fp) END), 0.0) AS pr_auc
  FROM cum GROUP BY 1),
quality1 AS (
  SELECT grp, roc_auc, pr_auc, CASE WHEN coalesce(flagged, 0) > 0 THEN hit / flagged ELSE 0.0 END AS precision,
         CASE WHEN p > 0 THEN coalesce(hit, 0) / p ELSE 0.0 END AS recall FROM quality0),
quality AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM quality1)"""

NATIONS = """people AS (
  SELECT labelled.*, c_nationkey AS nation FROM labelled JOIN customer ON CAST(c_custkey AS VARCHAR) = card)"""

ERRORS = """errors AS (
  SELECT date_trunc('month', date)::TIMESTAMP AS month, """ + METRICS.format(p="lag_7") + """ FROM demand GROUP BY 1),
pairs AS (
  SELECT month, mape AS current, lag(mape) OVER (ORDER BY month) AS baseline FROM errors QUALIFY baseline IS NOT NULL)"""

FORECAST_ALERT = """CASE WHEN baseline > 0 AND (current - baseline) / baseline > 0.20 THEN 'critical'
       WHEN baseline > 0 AND (current - baseline) / baseline > 0.10 THEN 'warning' ELSE 'ok' END"""

RUNS = f"""runs AS (
  SELECT 'demand_forecasting' AS experiment, strftime(month, '%Y-%m') AS run_id, month AS start_time,
         mape, CAST(NULL AS DOUBLE) AS pr_auc, CAST(NULL AS DOUBLE) AS alerts_critical FROM errors
  UNION ALL SELECT 'monitoring', strftime(month, '%Y-%m'), month, NULL, NULL,
         CAST({FORECAST_ALERT} = 'critical' AS INTEGER) FROM pairs
  UNION ALL SELECT 'churn_classification', 'nation-' || lpad(CAST(grp AS VARCHAR), 2, '0'),
         TIMESTAMP '2001-01-01' + to_days(CAST(grp AS INTEGER)), NULL, pr_auc, NULL FROM quality),
latest AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS INTEGER) AS recency_rank FROM runs
  QUALIFY recency_rank <= 10)"""


def runs_sql(body: str, *more: str) -> str:
    return S.with_ctes(
        S.SALES, S.DAILY, S.GRID, S.DEMAND, S.rfm(), S.behaviour(), SCORES, NATIONS,
        AP.format(by="nation", source="people"), ERRORS, RUNS, *more, body=body,
    )


RUN_DOUBLES = "mape:6 pr_auc:9"


def flat(df: DataFrame, *extra: str) -> DataFrame:
    metrics = [F.col("metrics")[m].alias(m) for m in ("mape", "pr_auc", "alerts_critical")]
    return df.select("experiment", "run_id", "start_time", *metrics, *extra)


@query("run_metrics_append", runs_sql("SELECT * FROM runs"), RUN_DOUBLES)
def _(spark, sf_dir):
    path = scratch_path(spark, "runs")
    table = materialise(inputs.run_table(spark, sf_dir), "runs")
    for name in ("demand_forecasting", "monitoring", "churn_classification"):
        runs.run_metrics_append(table.where(F.col("experiment") == name), path)
    return flat(runs.run_metrics_scan(spark, path))


@query("run_metrics_scan", runs_sql("SELECT * FROM runs"), RUN_DOUBLES)
def _(spark, sf_dir):
    path = scratch_path(spark, "runs")
    runs.run_metrics_append(inputs.run_table(spark, sf_dir), path)
    return flat(runs.run_metrics_scan(spark, path))


@query("latest_runs", runs_sql("SELECT * FROM latest"), RUN_DOUBLES)
def _(spark, sf_dir):
    return flat(runs.latest_runs(inputs.run_table(spark, sf_dir)), "recency_rank")


@query("latest_tagged_run", runs_sql("""
SELECT experiment, run_id, start_time, mape, pr_auc, alerts_critical FROM runs
WHERE experiment = 'churn_classification' ORDER BY start_time DESC LIMIT 1"""), RUN_DOUBLES)
def _(spark, sf_dir):
    table = inputs.run_table(spark, sf_dir)
    return flat(runs.latest_tagged_run(table, "churn_classification", "rule_score"))


@query("best_runs", runs_sql("""
(SELECT 'demand' AS area, run_id AS run_name, mape AS metric FROM latest WHERE experiment = 'demand_forecasting' ORDER BY mape, recency_rank LIMIT 1)
UNION ALL (SELECT 'churn', run_id, pr_auc FROM latest WHERE experiment = 'churn_classification' ORDER BY pr_auc DESC, recency_rank LIMIT 1)
UNION ALL (SELECT 'monitoring', run_id, alerts_critical FROM latest WHERE experiment = 'monitoring' ORDER BY recency_rank LIMIT 1)"""),
    "metric:6")
def _(spark, sf_dir):
    best = runs.best_runs(inputs.run_table(spark, sf_dir))
    names = {"demand": "mape", "churn": "pr_auc", "monitoring": "alerts_critical"}
    metric = F.coalesce(*[F.when(F.col("area") == a, F.col("metrics")[m]) for a, m in names.items()])
    return best.select("area", "run_name", metric.alias("metric"))


@query("mape_history", runs_sql("""
SELECT run_id AS run_name, mape, start_time FROM latest WHERE experiment = 'demand_forecasting'"""), "mape:6")
def _(spark, sf_dir):
    return runs.mape_history(inputs.run_table(spark, sf_dir))


@query("model_status", runs_sql("""
SELECT mape, pr_auc, silhouette, CASE WHEN mape < 50 THEN 'OK' ELSE 'Warning' END AS demand_status,
       CASE WHEN pr_auc >= 0.7 THEN 'OK' ELSE 'Critical' END AS churn_status, 'Warning' AS clustering_status
FROM (SELECT min(mape) AS mape, max(pr_auc) AS pr_auc, CAST(0.0 AS DOUBLE) AS silhouette FROM latest)"""), RUN_DOUBLES)
def _(spark, sf_dir):
    return runs.model_status(inputs.run_table(spark, sf_dir))


MARKED = """marked AS (
  SELECT experiment, run_id, start_time, mape AS value,
         CAST(row_number() OVER (PARTITION BY experiment ORDER BY start_time, run_id) AS INTEGER) AS seq,
         count(*) OVER (PARTITION BY experiment) AS n FROM runs WHERE mape IS NOT NULL)"""


@query("baseline_window", runs_sql("""
SELECT *, seq <= greatest(1, n // 4) AS is_baseline, seq = n AS is_latest FROM marked""", MARKED), "value:6")
def _(spark, sf_dir):
    return drift.baseline_window(inputs.run_table(spark, sf_dir), "mape")


@query("concept_drift", runs_sql("""
SELECT experiment, base AS baseline_value, cur AS current_value,
       round_even((cur - base) / abs(base), 4) AS degradation_pct, abs((cur - base) / abs(base)) > 0.2 AS drift_detected
FROM (SELECT experiment, avg(value) FILTER (seq <= greatest(1, n // 4)) AS base, max(value) FILTER (seq = n) AS cur
      FROM marked GROUP BY 1)""", MARKED), "baseline_value:6 current_value:6")
def _(spark, sf_dir):
    table = inputs.run_table(spark, sf_dir).where("experiment = 'demand_forecasting'")
    return drift.concept_drift(table, "mape")


@query("stage_summary", """
SELECT status, count(*) AS stages, true AS timed
FROM (SELECT unnest(['ok', 'ok', 'failed']) AS status FROM (SELECT count(*) FROM lineitem)) GROUP BY 1""")
def _(spark, sf_dir):
    """Two stages that store tables and one that misses its columns, run and timed as jobs run theirs."""
    sales, root = inputs.sales(spark, sf_dir), scratch_path(spark, "staged")
    layout = jobs.Layout(root)
    done = jobs.run_stages(spark, layout, [
        ("sales", lambda: files.sink_parquet(sales, f"{root}/sales")),
        ("demand", lambda: files.sink_parquet(inputs.demand_table(spark, sf_dir), layout.demand_features)),
        ("incomplete", lambda: files.sink_parquet(fc.train_demand_gbt(sales).trees, f"{root}/trees")),
    ])
    return runs.stage_summary(done).select("status", "stages", (F.col("elapsed") > 0).alias("timed"))


# -- alerts ------------------------------------------------------------------------

FORECAST_ALERTS = f"""fa AS (
  SELECT month, current, baseline, 'demand_forecast_xgboost' AS model, {FORECAST_ALERT} AS severity,
         (current - baseline) / baseline AS change FROM pairs),
forecast_alerts AS (
  SELECT month, model, severity, severity <> 'ok' AS alert,
         CASE severity WHEN 'critical' THEN printf('MAPE degraded %.1f%% above baseline (baseline=%.4f, current=%.4f). Re-training recommended.', change * 100, baseline, current)
           WHEN 'warning' THEN printf('MAPE showing early degradation %.1f%% above baseline (baseline=%.4f, current=%.4f). Monitor closely.', change * 100, baseline, current)
           ELSE printf('MAPE within acceptable bounds (baseline=%.4f, current=%.4f, change=%+.1f%%).', baseline, current, change * 100) END AS message
  FROM fa)"""

CHURN_ALERTS = """churn_pairs AS (
  SELECT grp AS nation, pr_auc AS current, (SELECT avg(pr_auc) FROM quality) AS baseline FROM quality),
ca AS (
  SELECT *, (baseline - current) / baseline AS falling,
         CASE WHEN (baseline - current) / baseline > 0.10 THEN 'critical'
              WHEN (baseline - current) / baseline > 0.05 THEN 'warning' ELSE 'ok' END AS severity FROM churn_pairs),
churn_alerts AS (
  SELECT nation, 'churn_classifier' AS model, severity, severity <> 'ok' AS alert,
         CASE severity WHEN 'critical' THEN printf('PR-AUC dropped %.1f%% below baseline (baseline=%.4f, current=%.4f). Re-training recommended.', falling * 100, baseline, current)
           WHEN 'warning' THEN printf('PR-AUC showing early decline %.1f%% below baseline (baseline=%.4f, current=%.4f). Monitor closely.', falling * 100, baseline, current)
           ELSE printf('PR-AUC within acceptable bounds (baseline=%.4f, current=%.4f, change=%+.1f%%).', baseline, current, -falling * 100) END AS message
  FROM ca)"""

DRIFT_ALERT_SQL = """SELECT {key} 'data_drift' AS model, severity, severity <> 'ok' AS alert,
  CASE severity WHEN 'critical' THEN printf('PSI=%.4f — significant population shift detected. Data re-collection and model re-training required.', psi)
    WHEN 'warning' THEN printf('PSI=%.4f — moderate population shift. Increase monitoring frequency.', psi)
    ELSE printf('PSI=%.4f — distribution is stable.', psi) END AS message
FROM (SELECT *, CASE WHEN psi >= 0.2 THEN 'critical' WHEN psi >= 0.1 THEN 'warning' ELSE 'ok' END AS severity FROM {source})"""


@query("alert_forecast", S.demand_sql("SELECT * FROM forecast_alerts", ERRORS, FORECAST_ALERTS))
def _(spark, sf_dir):
    pairs = inputs.month_pairs(inputs.monthly_errors(spark, sf_dir))
    return alerts.alert_forecast(pairs).select("month", *alerts.ALERT_COLUMNS)


@query("alert_churn", runs_sql("SELECT * FROM churn_alerts", CHURN_ALERTS))
def _(spark, sf_dir):
    scores = materialise(inputs.nation_scores(spark, sf_dir), "scores")
    pairs = scores.select(
        "nation", F.col("pr_auc").alias("current"), scores.agg(F.avg("pr_auc")).scalar().alias("baseline")
    )
    return alerts.alert_churn(pairs).select("nation", *alerts.ALERT_COLUMNS)


@query("alert_drift", drift_sql(DRIFT_ALERT_SQL.format(key="feature,", source="report")))
def _(spark, sf_dir):
    report = drift.data_drift(sided(spark, sf_dir))
    return alerts.alert_drift(report).select("feature", *alerts.ALERT_COLUMNS)


# The report of all checks: last month against the mean of all, worst nation against
# the mean of all, and the largest PSI.
REPORT_ROW = """summary AS (
  SELECT (SELECT arg_max(mape, month) FROM errors) AS current_mape, (SELECT avg(mape) FROM errors) AS baseline_mape,
         (SELECT min(pr_auc) FROM quality) AS current_pr_auc, (SELECT avg(pr_auc) FROM quality) AS baseline_pr_auc,
         (SELECT max(psi) FROM report) AS psi),
pairs2 AS (SELECT 1 AS check_no, current_mape AS current, baseline_mape AS baseline FROM summary),
checks AS (
  SELECT 1 AS check_no, 'demand_forecast_xgboost' AS model,
         CASE WHEN (current_mape - baseline_mape) / baseline_mape > 0.2 THEN 'critical'
              WHEN (current_mape - baseline_mape) / baseline_mape > 0.1 THEN 'warning' ELSE 'ok' END AS severity FROM summary
  UNION ALL SELECT 2, 'churn_classifier',
         CASE WHEN (baseline_pr_auc - current_pr_auc) / baseline_pr_auc > 0.1 THEN 'critical'
              WHEN (baseline_pr_auc - current_pr_auc) / baseline_pr_auc > 0.05 THEN 'warning' ELSE 'ok' END FROM summary
  UNION ALL SELECT 3, 'data_drift', CASE WHEN psi >= 0.2 THEN 'critical' WHEN psi >= 0.1 THEN 'warning' ELSE 'ok' END FROM summary)"""


def report_row(spark, sf_dir) -> DataFrame:
    table = stored_demand(spark, sf_dir)
    month = F.date_trunc("month", F.col("date")).cast("timestamp_ntz")
    from tallyfold.operators.forecasting import forecast_metrics

    errors = forecast_metrics(
        table.withColumns({"month": month, "prediction": F.col("lag_7")}), ["month"]
    )
    shift = drift.data_drift(demand.halves(table)).agg(F.max("psi")).scalar()
    quality = inputs.nation_scores(spark, sf_dir).agg(
        F.struct(F.min("pr_auc").alias("low"), F.avg("pr_auc").alias("mean"))
    ).scalar()
    return materialise(
        errors.agg(F.max_by("mape", "month").alias("current_mape"), F.avg("mape").alias("baseline_mape")).select(
            "*", quality["low"].alias("current_pr_auc"), quality["mean"].alias("baseline_pr_auc"),
            shift.alias("psi"),
        ),
        "report",
    )


def report_sql(body: str, *more: str) -> str:
    return runs_sql(body, POSITION_SIDES, DRIFT, REPORT, REPORT_ROW, *more)


@query("alerts", report_sql("SELECT check_no, model, severity, severity <> 'ok' AS alert FROM checks"))
def _(spark, sf_dir):
    return alerts.alerts(report_row(spark, sf_dir)).drop("message")


@query("alert_counts", report_sql("""
SELECT count(*) AS checks, count(*) FILTER (severity <> 'ok') AS active,
       count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning FROM checks"""))
def _(spark, sf_dir):
    return alerts.alert_counts(alerts.alerts(report_row(spark, sf_dir)))


@query("retrain_plan", report_sql("""
SELECT unnest(CASE WHEN model = 'data_drift' THEN ['demand_forecast_xgboost', 'churn_classifier'] ELSE [model] END) AS model
FROM checks WHERE severity = 'critical'"""))
def _(spark, sf_dir):
    return alerts.retrain_plan(alerts.alerts(report_row(spark, sf_dir))).select("model")


@query("retrain_proxy_report", runs_sql("""
SELECT (SELECT avg(mape) FROM (SELECT mape, row_number() OVER (ORDER BY month) AS i, count(*) OVER () AS n FROM errors) WHERE i > n // 2) AS current_mape,
       (SELECT avg(mape) FROM (SELECT mape, row_number() OVER (ORDER BY month) AS i, count(*) OVER () AS n FROM errors) WHERE i <= n // 2) AS baseline_mape,
       greatest(0.0, 0.75 - (second - first) * 0.5) AS current_pr_auc, CAST(0.75 AS DOUBLE) AS baseline_pr_auc, CAST(0.05 AS DOUBLE) AS psi
FROM (SELECT avg(churn_probability) FILTER (i <= n // 2) AS first, avg(churn_probability) FILTER (i > n // 2) AS second
      FROM (SELECT churn_probability, row_number() OVER (ORDER BY card) AS i, count(*) OVER () AS n FROM labelled))"""),
    "current_mape:6 baseline_mape:6 current_pr_auc:9")
def _(spark, sf_dir):
    from tallyfold.operators.ordering import running_totals

    def placed(df: DataFrame, order: str) -> DataFrame:
        ranked = running_totals(df.withColumn("one", F.lit(1).cast("bigint")), [order], ["one"])
        return ranked.withColumns({"position": F.col("one_upto") - 1, "n_rows": F.col("one_total")})

    errors = inputs.monthly_errors(spark, sf_dir).select("month", "mape")
    scores = inputs.labelled_scores(spark, sf_dir).select("card", "churn_probability")
    return alerts.retrain_proxy_report(placed(errors, "month"), placed(scores, "card"))


# -- return on investment --------------------------------------------------------------

PRODUCT_ERRORS = """perr AS (
  SELECT product, avg(abs(revenue - lag_7)) AS base, avg(abs(revenue - rolling_mean_14)) AS model, avg(revenue) AS daily
  FROM demand GROUP BY 1),
scen AS (
  SELECT product, base / daily AS mape_baseline, model / daily AS mape_model, daily AS avg_daily_revenue,
         0.08 AS waste_rate, 0.05 AS stockout_rate, 0.60 AS margin, 300.0 AS infra_cost_monthly FROM perr),
rf0 AS (
  SELECT product, avg_daily_revenue * 30 * waste_rate * ratio AS waste_savings,
         avg_daily_revenue * 30 * stockout_rate * ratio * margin AS stockout_recovery, CAST(infra_cost_monthly AS DOUBLE) AS total_cost
  FROM (SELECT *, greatest(0.0, mape_baseline - mape_model) / mape_baseline AS ratio FROM scen)),
rf AS (
  SELECT product, round_even(waste_savings, 2) AS waste_savings, round_even(stockout_recovery, 2) AS stockout_recovery,
         round_even(waste_savings + stockout_recovery, 2) AS total_benefit, round_even(total_cost, 2) AS total_cost,
         round_even((waste_savings + stockout_recovery - total_cost) / total_cost * 100, 2) AS roi_pct,
         CASE WHEN waste_savings + stockout_recovery > 0
              THEN round_even(total_cost / ((waste_savings + stockout_recovery) / 30), 1) END AS payback_days FROM rf0)"""

SEGMENT_ROI = """sc AS (
  SELECT segment_name, count(*) FILTER (churn_probability >= 0.5) AS n, avg(monetary) / 80 AS monthly
  FROM predictions GROUP BY 1),
rc0 AS (
  SELECT segment_name, n * CAST(0.3 AS DOUBLE) AS kept, n * CAST(0.3 AS DOUBLE) * monthly * 0.6 AS saved, CAST(n * 15.0 AS DOUBLE) AS campaign,
         CAST(n * 15.0 AS DOUBLE) + 150 AS cost FROM sc),
rc AS (
  SELECT segment_name, round_even(kept, 1) AS customers_retained, round_even(saved, 2) AS revenue_saved,
         round_even(campaign, 2) AS campaign_cost, round_even(cost, 2) AS total_cost,
         round_even(saved - cost, 2) AS net_benefit, round_even((saved - cost) / cost * 100, 2) AS roi_pct FROM rc0)"""

PREDICTIONS = """predictions AS (
  SELECT card, 0.6 * (1 - recency_norm) + 0.4 * (1 - frequency_norm) AS churn_probability,
         CAST(0.6 * (1 - recency_norm) + 0.4 * (1 - frequency_norm) >= 0.5 AS INTEGER) AS churn_label, segment_name, monetary
  FROM churnfeat)"""

FORECAST_ROI = ["product", "waste_savings", "stockout_recovery", "total_benefit", "total_cost", "roi_pct", "payback_days"]
CHURN_ROI = ["segment_name", "customers_retained", "revenue_saved", "campaign_cost", "total_cost", "net_benefit", "roi_pct"]


def product_roi(spark, sf_dir) -> DataFrame:
    """One scenario per product: weighted errors of two baselines and its daily revenue."""
    y = F.col("revenue")
    scenarios = inputs.demand_table(spark, sf_dir).groupBy("product").agg(
        F.avg(F.abs(y - F.col("lag_7"))).alias("base"),
        F.avg(F.abs(y - F.col("rolling_mean_14"))).alias("model"),
        F.avg(y).alias("avg_daily_revenue"),
    ).select(
        "product",
        (F.col("base") / F.col("avg_daily_revenue")).alias("mape_baseline"),
        (F.col("model") / F.col("avg_daily_revenue")).alias("mape_model"),
        "avg_daily_revenue",
        F.lit(0.08).alias("waste_rate"), F.lit(0.05).alias("stockout_rate"),
        F.lit(0.60).alias("margin"), F.lit(300.0).alias("infra_cost_monthly"),
    )
    return roi.roi_forecast(scenarios).select(*FORECAST_ROI)


def segment_roi(spark, sf_dir) -> DataFrame:
    """One scenario per segment: customers flagged and their monthly revenue."""
    scenarios = inputs.predictions(spark, sf_dir).groupBy("segment_name").agg(
        F.count_if(F.col("churn_label") == 1).alias("n_churners_detected"),
        (F.avg("monetary") / 80).alias("avg_monthly_revenue_per_customer"),
    ).select(
        "*", F.lit(0.30).alias("retention_rate"), F.lit(0.60).alias("margin"),
        F.lit(15.0).alias("campaign_cost_per_customer"), F.lit(150.0).alias("infra_cost_monthly"),
    )
    return roi.roi_churn(scenarios).select(*CHURN_ROI)


@query("roi_forecast", S.demand_sql("SELECT * FROM rf", PRODUCT_ERRORS))
def _(spark, sf_dir):
    return product_roi(spark, sf_dir)


@query("roi_churn", S.churn_sql("SELECT * FROM rc", PREDICTIONS, SEGMENT_ROI))
def _(spark, sf_dir):
    return segment_roi(spark, sf_dir)


@query("roi_total", S.churn_sql("""
SELECT scenario, round_even(fb - fcost + net, 2) AS total_net_benefit, round_even(fcost + ccost, 2) AS total_cost,
       round_even((fb - fcost + net) / (fcost + ccost) * 100, 2) AS combined_roi_pct
FROM (SELECT 'all' AS scenario, (SELECT sum(total_benefit) FROM rf) AS fb, (SELECT sum(total_cost) FROM rf) AS fcost,
             (SELECT sum(net_benefit) FROM rc) AS net, (SELECT sum(total_cost) FROM rc) AS ccost)""",
    PREDICTIONS, SEGMENT_ROI, S.DAILY, S.GRID, S.DEMAND, PRODUCT_ERRORS))
def _(spark, sf_dir):
    forecast = product_roi(spark, sf_dir).agg(
        F.lit("all").alias("scenario"), F.sum("total_benefit").alias("total_benefit"),
        F.sum("total_cost").alias("total_cost"),
    )
    churn = segment_roi(spark, sf_dir).agg(
        F.lit("all").alias("scenario"), F.sum("net_benefit").alias("net_benefit"),
        F.sum("total_cost").alias("total_cost"),
    )
    return roi.roi_total(forecast, churn, "scenario")


@query("roi_dashboard", S.churn_sql("""
SELECT fb AS forecast_benefit, CAST(500.0 AS DOUBLE) AS forecast_cost, cb AS churn_benefit, cc AS churn_cost,
       (fb - 500) / 500 * 100 AS forecast_roi, (cb - cc) / cc * 100 AS churn_roi,
       fb + cb - (500 + cc) AS combined_net, (fb + cb - (500 + cc)) / (500 + cc) * 100 AS combined_roi,
       CAST(floor(500 / ((fb + cb) / 30)) AS INTEGER) AS payback_days
FROM (SELECT (SELECT avg(r) FROM (SELECT sum(money) AS r FROM txn GROUP BY CAST(datetime AS DATE))) * 0.15 * 30 AS fb,
             count(*) FILTER (churn_label = 1) * 0.30 * avg(monetary) FILTER (churn_label = 1) * 0.35 AS cb,
             CAST(count(*) FILTER (churn_label = 1) * 10 AS DOUBLE) AS cc FROM predictions)""", PREDICTIONS),
    "forecast_benefit:4 churn_benefit:4 forecast_roi:5 churn_roi:4 combined_net:4 combined_roi:5")
def _(spark, sf_dir):
    daily = profiles.daily_average_revenue(inputs.sales(spark, sf_dir))
    return roi.roi_dashboard(daily, inputs.predictions(spark, sf_dir))


# -- dashboards ---------------------------------------------------------------------------


@query("revenue_timeseries", S.with_ctes(S.SALES, """d AS (
  SELECT CAST(datetime AS DATE) AS date, sum(money) AS revenue FROM txn GROUP BY 1)""", body="""
SELECT date, revenue, CASE WHEN count(*) OVER w = 7 THEN avg(revenue) OVER w END AS ma7 FROM d
WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""), "revenue ma7:6")
def _(spark, sf_dir):
    return reports.revenue_timeseries(inputs.sales(spark, sf_dir))


@query("sales_heatmap", S.with_ctes(S.EVENTS, body="""
SELECT CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week, any_value(dayname(datetime)) AS day_name, """ + ", ".join(
    f"coalesce(sum(money) FILTER (hour(datetime) = {h}), 0.0) AS h{h:02d}" for h in range(24)
) + " FROM evt GROUP BY 1"), " ".join(f"h{h:02d}" for h in range(24)))
def _(spark, sf_dir):
    return reports.sales_heatmap(inputs.events(spark, sf_dir))


@query("churn_kpis", S.churn_sql("""
SELECT count(*) FILTER (churn_label = 1) AS at_risk, sum(monetary) FILTER (churn_label = 1) AS revenue_at_risk,
       count(*) FILTER (churn_label = 1) / count(*) * 100 AS pct_of_base FROM predictions""", PREDICTIONS),
    "revenue_at_risk pct_of_base:9")
def _(spark, sf_dir):
    return reports.churn_kpis(inputs.predictions(spark, sf_dir))


@query("churn_pct_display", S.churn_sql("""
SELECT card, round_even(churn_probability * 100, 1) AS churn_pct, round_even(round(monetary, 4), 2) AS monetary FROM predictions""", PREDICTIONS))
def _(spark, sf_dir):
    from tallyfold.functions import numeric

    return inputs.predictions(spark, sf_dir).select(
        "card", numeric.as_percent(F.col("churn_probability")).alias("churn_pct"),
        numeric.half_even(F.round("monetary", 4), 2).alias("monetary"),
    )


@query("top_churn_risk", S.churn_sql("""
SELECT '****' || right(card, 4) AS card, round_even(churn_probability * 100, 1) AS churn_pct, segment_name,
       round_even(monetary, 2) AS monetary FROM predictions ORDER BY churn_probability DESC, predictions.card LIMIT 20""", PREDICTIONS))
def _(spark, sf_dir):
    return reports.top_churn_risk(inputs.predictions(spark, sf_dir))


@query("top_value_churners", S.churn_sql("""
SELECT card, churn_probability, segment_name, monetary FROM predictions WHERE churn_label = 1
ORDER BY monetary DESC, card LIMIT 10""", PREDICTIONS), "churn_probability:9 monetary")
def _(spark, sf_dir):
    return reports.top_value_churners(inputs.predictions(spark, sf_dir))


@query("sorted_predictions", S.churn_sql("SELECT * FROM predictions", PREDICTIONS), "churn_probability:9 monetary")
def _(spark, sf_dir):
    return reports.sorted_predictions(inputs.predictions(spark, sf_dir))


@query("segment_scatter_data", S.scored_sql("""
SELECT segment_name, card, recency_days, frequency, monetary, pow(greatest(monetary, 1), 0.4) AS size FROM scored"""), "monetary size:6")
def _(spark, sf_dir):
    return reports.segment_scatter(inputs.segments(spark, sf_dir))
