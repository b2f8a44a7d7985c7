"""Model health alerts and what they trigger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEMAND_MODEL = "demand_forecast_xgboost"
CHURN_MODEL = "churn_classifier"
DRIFT_MODEL = "data_drift"

MAPE_THRESHOLD = 0.20
PR_AUC_THRESHOLD = 0.10
PSI_WARNING = 0.1
PSI_CRITICAL = 0.2

# Message formats.
MAPE_MESSAGES = {
    "none": "Baseline MAPE is zero or negative — cannot compute degradation.",
    "critical": "MAPE degraded %.1f%% above baseline (baseline=%.4f, current=%.4f). Re-training recommended.",
    "warning": "MAPE showing early degradation %.1f%% above baseline (baseline=%.4f, current=%.4f). Monitor closely.",
    "ok": "MAPE within acceptable bounds (baseline=%.4f, current=%.4f, change=%+.1f%%).",
}
PR_AUC_MESSAGES = {
    "none": "Baseline PR-AUC is zero or negative — cannot compute degradation.",
    "critical": "PR-AUC dropped %.1f%% below baseline (baseline=%.4f, current=%.4f). Re-training recommended.",
    "warning": "PR-AUC showing early decline %.1f%% below baseline (baseline=%.4f, current=%.4f). Monitor closely.",
    "ok": "PR-AUC within acceptable bounds (baseline=%.4f, current=%.4f, change=%+.1f%%).",
}
DRIFT_MESSAGES = {
    "critical": "PSI=%.4f — significant population shift detected. Data re-collection and model re-training required.",
    "warning": "PSI=%.4f — moderate population shift. Increase monitoring frequency.",
    "ok": "PSI=%.4f — distribution is stable.",
}


def _with_alert(df: DataFrame, model: str, severity: Column, message: Column) -> DataFrame:
    return df.withColumns(
        {
            "model": F.lit(model),
            "severity": severity,
            "alert": severity != "ok",
            "message": message,
        }
    )


def _relative_alert(df: DataFrame, model: str, worse: Column, shown: Column, threshold: float,
                    messages: dict[str, str]) -> DataFrame:
    """Alert on a relative loss ``worse``; ``shown`` is the signed change in the ok message."""
    current, baseline = F.col("current"), F.col("baseline")
    usable = baseline > 0
    severity = (
        F.when(usable & (worse > threshold), "critical")
        .when(usable & (worse > threshold * 0.5), "warning")
        .otherwise("ok")
    )
    pct = worse * 100
    text = (
        F.when(~usable, messages["none"])
        .when(severity == "critical", F.format_string(messages["critical"], pct, baseline, current))
        .when(severity == "warning", F.format_string(messages["warning"], pct, baseline, current))
        .otherwise(F.format_string(messages["ok"], baseline, current, shown * 100))
    )
    return _with_alert(df, model, severity, text)


def alert_forecast(df: DataFrame, threshold: float = MAPE_THRESHOLD) -> DataFrame:
    """Rows with ``current`` and ``baseline`` MAPE; a rise is worse."""
    rise = F.when(F.col("baseline") > 0, (F.col("current") - F.col("baseline")) / F.col("baseline"))
    return _relative_alert(df, DEMAND_MODEL, rise, rise, threshold, MAPE_MESSAGES)


def alert_churn(df: DataFrame, threshold: float = PR_AUC_THRESHOLD) -> DataFrame:
    """Rows with ``current`` and ``baseline`` PR-AUC; a drop is worse."""
    drop = F.when(F.col("baseline") > 0, (F.col("baseline") - F.col("current")) / F.col("baseline"))
    return _relative_alert(df, CHURN_MODEL, drop, -drop, threshold, PR_AUC_MESSAGES)


def alert_drift(df: DataFrame) -> DataFrame:
    """Rows with ``psi``; both limits are inclusive."""
    value = F.col("psi")
    severity = (
        F.when(value >= PSI_CRITICAL, "critical").when(value >= PSI_WARNING, "warning").otherwise("ok")
    )
    text = (
        F.when(severity == "critical", F.format_string(DRIFT_MESSAGES["critical"], value))
        .when(severity == "warning", F.format_string(DRIFT_MESSAGES["warning"], value))
        .otherwise(F.format_string(DRIFT_MESSAGES["ok"], value))
    )
    return _with_alert(df, DRIFT_MODEL, severity, text)


ALERT_COLUMNS = ["model", "alert", "message", "severity"]


def alerts(report: DataFrame) -> DataFrame:
    """All checks of a report, in the order forecast, churn, drift (``check_no``).

    A report row has ``current_mape, baseline_mape, current_pr_auc, baseline_pr_auc,
    psi``; a section that is NULL is absent.
    """
    forecast = report.where(F.col("current_mape").isNotNull()).select(
        F.col("current_mape").alias("current"), F.col("baseline_mape").alias("baseline")
    )
    churn = report.where(F.col("current_pr_auc").isNotNull()).select(
        F.col("current_pr_auc").alias("current"), F.col("baseline_pr_auc").alias("baseline")
    )
    drift = report.where(F.col("psi").isNotNull()).select("psi")
    checks = [alert_forecast(forecast), alert_churn(churn), alert_drift(drift)]
    numbered = [c.select(F.lit(i).alias("check_no"), *ALERT_COLUMNS) for i, c in enumerate(checks, 1)]
    return numbered[0].unionByName(numbered[1]).unionByName(numbered[2])


def alert_counts(raised: DataFrame) -> DataFrame:
    """One row: checks, active alerts, and how many are critical or warnings."""
    return raised.agg(
        F.count("*").alias("checks"),
        F.count_if("alert").alias("active"),
        F.count_if(F.col("severity") == "critical").alias("critical"),
        F.count_if(F.col("severity") == "warning").alias("warning"),
    )


def retrain_plan(raised: DataFrame) -> DataFrame:
    """``model, trigger_reason`` to retrain: critical alerts only; drift retrains every model."""
    every = F.array(F.lit(DEMAND_MODEL), F.lit(CHURN_MODEL))
    targets = F.when(F.col("model") == DRIFT_MODEL, every).otherwise(F.array("model"))
    return raised.where(F.col("severity") == "critical").select(
        F.explode(targets).alias("model"), F.col("message").alias("trigger_reason")
    )


def retrain_proxy_report(forecast_errors: DataFrame, scores: DataFrame) -> DataFrame:
    """One report row from past forecast errors and current churn scores.

    Both inputs hold ``position`` (0-based), ``n_rows`` and a value: ``mape`` or
    ``churn_probability``. The second half is compared with the first; a shift of the
    scores moves the assumed PR-AUC of 0.75 by half of it.
    """

    def half_means(df: DataFrame, value: str) -> DataFrame:
        first = F.col("position") < F.floor(F.col("n_rows") / 2)
        alone = F.col("n_rows") == 1
        return df.agg(
            F.struct(
                F.avg(F.when(first | alone, F.col(value))).alias("first"),
                F.avg(F.when(~first | alone, F.col(value))).alias("second"),
            )
        )

    shift = half_means(scores, "churn_probability").scalar()
    halves = half_means(forecast_errors, "mape").toDF("m")
    return halves.select(
        F.col("m.second").alias("current_mape"),
        F.col("m.first").alias("baseline_mape"),
        F.greatest(F.lit(0.0), 0.75 - (shift["second"] - shift["first"]) * 0.5).alias("current_pr_auc"),
        F.lit(0.75).alias("baseline_pr_auc"),
        F.lit(0.05).alias("psi"),
    )
