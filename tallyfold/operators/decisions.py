"""Rule-based modelling decisions derived from the profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import numeric

CHURN_WINDOWS = (30, 60, 90)
MIN_ACTIVE_DAYS = 60
MIN_CUSTOMERS = 50
MINORITY_RANGE = (20.0, 50.0)
MINORITY_TARGET = 30.0
MIN_ACTIVE_SHARE = 0.30
SEASON_MIN_DAYS = {"weekly": 60, "quarterly": 182}

# Forecast candidates by situation.
CANDIDATES_NONE = ["lag_model"]
CANDIDATES_ALL = ["seasonal_regression", "lag_model", "seasonal_naive"]
CANDIDATES_MIXED = ["lag_model", "seasonal_naive", "seasonal_regression_long_series"]


def forecast_eligible(activity: DataFrame, min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """Products with enough days with sales."""
    return activity.where(F.col("n_active_days") >= min_days)


def ineligible_anti(products: DataFrame, eligible: DataFrame) -> DataFrame:
    """Products that are not in the eligible table."""
    return products.join(eligible.select("product"), "product", "left_anti")


def series_viability(activity: DataFrame, season: str = "weekly") -> DataFrame:
    """Whether a series is long and dense enough for a seasonal decomposition."""
    short = F.col("n_days") < SEASON_MIN_DAYS[season]
    sparse = F.col("n_active_days") < F.col("n_days") * MIN_ACTIVE_SHARE
    return activity.withColumns(
        {
            "status": F.when(short | sparse, "skipped").otherwise("ok"),
            "reason": F.when(short, "too_short").when(sparse, "too_many_empty_days"),
        }
    )


def churn_balance(stats: DataFrame, windows: Sequence[int] = CHURN_WINDOWS) -> DataFrame:
    """Class balance for each inactivity window, from one pass over the customers."""
    row = stats.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("recency_days") > w).alias(f"churned_{w}") for w in windows],
    )
    per_window = row.select(
        "n",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(w).alias("window_days"), F.col(f"churned_{w}").alias("churned"))
                    for w in windows
                ]
            )
        ),
    )
    active = F.col("n") - F.col("churned")
    return per_window.select(
        "window_days",
        "churned",
        active.alias("active"),
        numeric.as_percent(F.col("churned") / F.col("n")).alias("churn_rate_pct"),
        numeric.as_percent(F.least("churned", active) / F.col("n")).alias("minority_pct"),
    )


def choose_churn_window(balance: DataFrame) -> DataFrame:
    """One row: shortest balanced window, else the one nearest to 30 % minority."""
    balanced = F.col("minority_pct").between(*MINORITY_RANGE)
    choice = balance.agg(
        F.coalesce(
            F.min_by("window_days", F.when(balanced, F.col("window_days"))),
            F.min_by("window_days", F.struct(F.abs(F.col("minority_pct") - MINORITY_TARGET), "window_days")),
        ).alias("window_days"),
        F.map_from_entries(F.collect_list(F.struct("window_days", "minority_pct"))).alias("_pct"),
    )
    minority = F.col("_pct")[F.col("window_days")]
    return choice.select(
        "window_days",
        minority.alias("minority_pct"),
        F.when(minority >= MINORITY_RANGE[0], "classification")
        .otherwise("anomaly_detection").alias("approach"),
    )


def clustering_viable(stats: DataFrame, min_customers: int = MIN_CUSTOMERS) -> DataFrame:
    return stats.agg(F.count("*").alias("customers")).withColumn(
        "clustering_viable", F.col("customers") >= min_customers
    )


def _names(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def forecast_candidates(activity: DataFrame, season: str = "quarterly",
                        min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """One row: number of eligible products and the candidate models that follow."""
    row = series_viability(activity, season).agg(
        F.count_if(F.col("n_active_days") >= min_days).alias("n_eligible"),
        F.bool_and(F.col("status") == "ok").alias("_all_ok"),
    )
    return row.select(
        "n_eligible",
        F.when(F.col("n_eligible") == 0, _names(CANDIDATES_NONE))
        .when(F.col("_all_ok"), _names(CANDIDATES_ALL))
        .otherwise(_names(CANDIDATES_MIXED)).alias("candidates"),
    )


def decision_log(stats: DataFrame, activity: DataFrame) -> DataFrame:
    """One row that collects every decision. Both inputs should be stored tables."""
    window = choose_churn_window(churn_balance(stats)).select(F.struct("window_days", "approach")).scalar()
    models = forecast_candidates(activity).select("candidates").scalar()
    products = forecast_eligible(activity).agg(F.array_sort(F.collect_list("product"))).scalar()
    return clustering_viable(stats).select(
        window["window_days"].alias("churn_window_days"),
        window["approach"].alias("churn_approach"),
        products.alias("forecast_products"),
        models.alias("forecast_candidates"),
        F.col("customers").alias("identified_customers"),
        "clustering_viable",
    )
