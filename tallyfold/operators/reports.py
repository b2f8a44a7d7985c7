"""Queries behind the dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import numeric, temporal
from tallyfold.operators import demand
from tallyfold.operators.profiles import top_n


def revenue_timeseries(sales: DataFrame) -> DataFrame:
    """Daily revenue and its mean over seven sales days, NULL for the first six.

    The window sees one row per calendar day, whatever the number of sales.
    """
    daily = sales.groupBy(F.to_date("datetime").alias("date")).agg(F.sum("money").alias("revenue"))
    return demand.moving_average(daily, "revenue", strict=True, by=())


def sales_heatmap(sales: DataFrame) -> DataFrame:
    """Revenue by weekday (rows) and hour (columns ``h00`` to ``h23``); 0 where nothing was sold."""
    per_cell = sales.groupBy(
        F.weekday("datetime").alias("day_of_week"), F.hour("datetime").alias("hour")
    ).agg(F.sum("money").alias("revenue"))
    hours = range(24)
    wide = per_cell.groupBy("day_of_week").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("hour") == h, F.col("revenue"))), F.lit(0.0)).alias(f"h{h:02d}")
            for h in hours
        ]
    )
    return wide.withColumn("day_name", temporal.day_name(F.col("day_of_week"))).orderBy("day_of_week")


def forecast_view(daily: DataFrame, forecast: DataFrame, products: Sequence[str] | None = None) -> DataFrame:
    """Recent history and forecasts as one long table with a ``series`` column."""
    history = demand.recent_history(daily).select(
        F.lit("history").alias("series"), "product", "date", "revenue",
        F.lit(None).cast("double").alias("lower_bound"), F.lit(None).cast("double").alias("upper_bound"),
    )
    ahead = forecast.select(
        F.concat(F.lit("forecast_"), F.col("horizon").cast("string")).alias("series"), "product", "date",
        F.col("predicted_revenue").alias("revenue"), "lower_bound", "upper_bound",
    )
    both = history.unionByName(ahead)
    return both if products is None else both.where(F.col("product").isin(*products))


def demand_kpis(forecast: DataFrame, horizons: Sequence[int] = (7, 30)) -> DataFrame:
    return forecast.groupBy("product").agg(
        *[
            F.sum(F.when(F.col("horizon") == h, F.col("predicted_revenue"))).alias(f"forecast_{h}d")
            for h in horizons
        ]
    )


def demand_drop_alert(forecast: DataFrame, daily: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Products whose 7-day forecast falls below ``ratio`` of their usual week."""
    usual = daily.groupBy("product").agg(F.avg("revenue").alias("daily_mean"))
    week = F.col("daily_mean") * 7
    return (
        demand_kpis(forecast, (7,))
        .join(usual, "product")
        .withColumn("at_risk", (F.col("daily_mean") > 0) & (F.col("forecast_7d") < ratio * week))
    )


def churn_kpis(predictions: DataFrame) -> DataFrame:
    """One row: customers at risk, their revenue, and their share of the base."""
    at_risk = F.col("churn_label") == 1
    row = predictions.agg(
        F.count_if(at_risk).alias("at_risk"),
        F.coalesce(F.sum(F.when(at_risk, F.col("monetary"))), F.lit(0.0)).alias("revenue_at_risk"),
        F.count("*").alias("_n"),
    )
    return row.select(
        "at_risk",
        "revenue_at_risk",
        (numeric.safe_ratio(F.col("at_risk"), F.col("_n")) * 100).alias("pct_of_base"),
    )


def top_churn_risk(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The customers most likely to leave, with masked card and display rounding."""
    return top_n(predictions, "churn_probability", "card", n).select(
        numeric.masked_card(F.col("card")).alias("card"),
        numeric.as_percent(F.col("churn_probability")).alias("churn_pct"),
        "segment_name",
        numeric.half_even(F.col("monetary"), 2).alias("monetary"),
    )


def top_value_churners(predictions: DataFrame, n: int = 10) -> DataFrame:
    flagged = predictions.where(F.col("churn_label") == 1)
    return top_n(flagged, "monetary", "card", n).select(
        "card", "churn_probability", "segment_name", "monetary"
    )


def sorted_predictions(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy(F.col("churn_probability").desc(), "card")


def segment_scatter(segments: DataFrame) -> DataFrame:
    return segments.select(
        "segment_name", "card", "recency_days", "frequency", "monetary",
        numeric.bubble_size(F.col("monetary")).alias("size"),
    )
