"""Return on investment, one row per scenario."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import numeric

DAYS_PER_MONTH = 30


def _pct(net: Column, cost: Column) -> Column:
    return F.when(cost > 0, net / cost * 100).otherwise(F.lit(0.0))


def _rounded(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    return df.withColumns({c: numeric.half_even(F.col(c), n) for c, n in columns.items()})


def roi_forecast(scenarios: DataFrame) -> DataFrame:
    """Monthly return of the demand model.

    Needs ``mape_baseline, mape_model, avg_daily_revenue, waste_rate, stockout_rate,
    margin, infra_cost_monthly``. Pay-back is NULL without benefit.
    """
    monthly = F.col("avg_daily_revenue") * DAYS_PER_MONTH
    gain = F.greatest(F.lit(0.0), F.col("mape_baseline") - F.col("mape_model"))
    ratio = F.when(F.col("mape_baseline") > 0, gain / F.col("mape_baseline")).otherwise(F.lit(0.0))
    cost = F.col("total_cost")
    benefit = F.col("total_benefit")
    out = (
        scenarios.withColumn("waste_savings", monthly * F.col("waste_rate") * ratio)
        .withColumn("stockout_recovery", monthly * F.col("stockout_rate") * ratio * F.col("margin"))
        .withColumn("total_benefit", F.col("waste_savings") + F.col("stockout_recovery"))
        .withColumn("total_cost", F.col("infra_cost_monthly").cast("double"))
        .withColumn("roi_pct", _pct(benefit - cost, cost))
        .withColumn("payback_days", F.when(benefit > 0, cost / (benefit / DAYS_PER_MONTH)))
    )
    return _rounded(
        out,
        {"waste_savings": 2, "stockout_recovery": 2, "total_benefit": 2, "total_cost": 2,
         "roi_pct": 2, "payback_days": 1},
    )


def roi_churn(scenarios: DataFrame) -> DataFrame:
    """Monthly return of the retention campaign.

    Needs ``n_churners_detected, retention_rate, avg_monthly_revenue_per_customer,
    margin, campaign_cost_per_customer, infra_cost_monthly``.
    """
    found = F.col("n_churners_detected")
    out = (
        scenarios.withColumn("customers_retained", found * F.col("retention_rate"))
        .withColumn(
            "revenue_saved",
            F.col("customers_retained") * F.col("avg_monthly_revenue_per_customer") * F.col("margin"),
        )
        .withColumn("campaign_cost", (found * F.col("campaign_cost_per_customer")).cast("double"))
        .withColumn("total_cost", F.col("campaign_cost") + F.col("infra_cost_monthly"))
        .withColumn("net_benefit", F.col("revenue_saved") - F.col("total_cost"))
        .withColumn("roi_pct", _pct(F.col("net_benefit"), F.col("total_cost")))
    )
    return _rounded(
        out,
        {"customers_retained": 1, "revenue_saved": 2, "campaign_cost": 2, "total_cost": 2,
         "net_benefit": 2, "roi_pct": 2},
    )


def roi_total(forecast: DataFrame, churn: DataFrame, by: str) -> DataFrame:
    """Both returns added per scenario, from their rounded parts."""
    net = (F.col("f.total_benefit") - F.col("f.total_cost")) + F.col("c.net_benefit")
    cost = F.col("f.total_cost") + F.col("c.total_cost")
    both = forecast.alias("f").join(churn.alias("c"), by).select(
        by, net.alias("total_net_benefit"), cost.alias("total_cost"), _pct(net, cost).alias("combined_roi_pct")
    )
    return _rounded(both, {"total_net_benefit": 2, "total_cost": 2, "combined_roi_pct": 2})


def roi_dashboard(daily_average: DataFrame, predictions: DataFrame, waste_cost: float | None = None,
                  margin: float | None = None, campaign_cost: float | None = None,
                  infra_cost: float | None = None) -> DataFrame:
    """One row with the dashboard's own, simpler formula; empty or zero inputs take defaults."""
    unit, margin = float(waste_cost or 5.0), float(margin or 0.35)
    per_campaign, infra = float(campaign_cost or 10.0), float(infra_cost or 500.0)
    daily = daily_average.select("daily_avg_revenue").scalar()
    at_risk = F.col("churn_label") == 1
    row = predictions.agg(
        F.count_if(at_risk).alias("at_risk"),
        F.coalesce(F.avg(F.when(at_risk, F.col("monetary"))), F.lit(0.0)).alias("avg_monetary"),
    )
    saved = F.col("at_risk") * 0.30 * F.col("avg_monetary") * margin
    spent = F.col("at_risk") * per_campaign
    parts = row.select(
        (daily * 0.15 / unit * unit * DAYS_PER_MONTH).alias("forecast_benefit"),
        F.lit(infra).alias("forecast_cost"),
        saved.alias("churn_benefit"),
        spent.alias("churn_cost"),
    )
    benefit = F.col("forecast_benefit") + F.col("churn_benefit")
    cost = F.col("forecast_cost") + F.col("churn_cost")
    return parts.select(
        "*",
        _pct(F.col("forecast_benefit") - F.col("forecast_cost"), F.col("forecast_cost")).alias("forecast_roi"),
        _pct(F.col("churn_benefit") - F.col("churn_cost"), F.col("churn_cost")).alias("churn_roi"),
        (benefit - cost).alias("combined_net"),
        _pct(benefit - cost, cost).alias("combined_roi"),
        F.when(benefit > 0, (infra / (benefit / DAYS_PER_MONTH)).cast("int"))
        .otherwise(F.lit(0)).alias("payback_days"),
    )
