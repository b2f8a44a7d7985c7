"""Logical tables the registered queries start from, built from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.operators import alerts, classification, customers, demand, forecasting
from tallyfold.scratch import materialise
from tallyfold.sources import adapters, runs

SEGMENT_NAMES = [name for _, name in customers.SEGMENT_FLOORS]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.order_sales(spark, sf_dir)


def stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales, joined once and stored, for tables that read them several times."""
    return materialise(sales(spark, sf_dir), "sales")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.event_sales(spark, sf_dir)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an unclean text source.

    Error events carry an unreadable time, sign-ups no product, views an unknown
    payment type; amounts are shifted so that some are not positive.
    """
    kind = F.col("event_type")
    return adapters.table(spark, sf_dir, "events").select(
        F.when(kind == "error", F.concat(F.lit("bad "), F.col("event_id").cast("string")))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("datetime"),
        F.when(kind == "view", "voucher").otherwise("card").alias("cash_type"),
        F.col("user_id").cast("string").alias("card"),
        (F.col("value") - 5).cast("string").alias("money"),
        F.when(kind != "signup", kind).alias("coffee_name"),
        F.col("event_id"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.daily_sales(sales(spark, sf_dir))


def demand_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.demand_features(sales(spark, sf_dir), adapters.FORECAST_TYPES)


def rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.rfm_features(sales(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.rfm_quintiles(rfm(spark, sf_dir))


def segments_of(scored_rfm: DataFrame) -> DataFrame:
    """Quintile segments as a segment table; the ladder position is the cluster id."""
    position = F.array_position(F.array(*[F.lit(n) for n in SEGMENT_NAMES]), F.col("segment_name"))
    return scored_rfm.select(
        "card", (position - 1).cast("int").alias("cluster_id"), "segment_name",
        "recency_days", "frequency", "monetary",
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments_of(scored(spark, sf_dir))


def churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn features from one pass over sales, which are joined and grouped once and not stored themselves."""
    bought = customers.stored_purchases(sales(spark, sf_dir), adapters.last_order(spark, sf_dir))
    scored_rfm = materialise(customers.rfm_quintiles(customers.rfm_of_purchases(bought)), "scored")
    return customers.join_churn_features(scored_rfm, segments_of(scored_rfm), customers.behaviour_of_purchases(bought))


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(stored_sales(spark, sf_dir))


def labelled(rows: DataFrame) -> DataFrame:
    """Customers with churn label and a rule score that stands for a model's probability.

    The rule only uses ratios of whole numbers, so SQL reproduces it exactly.
    """
    labels = customers.behaviour(rows).select("card", "churn")
    return customers.rfm_features(rows).join(labels, "card").withColumn("churn_probability", rule_score())


def rule_score():
    return 0.6 * (1 - F.col("recency_norm")) + 0.4 * (1 - F.col("frequency_norm"))


def predictions(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """``card, churn_probability, churn_label, segment_name, monetary`` from the rule score."""
    return churn_table(spark, sf_dir).withColumn("churn_probability", rule_score()).select(
        "card", "churn_probability",
        (F.col("churn_probability") >= threshold).cast("int").alias("churn_label"),
        "segment_name", "monetary",
    )


def monthly_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors_by_month(sales(spark, sf_dir))


def errors_by_month(rows: DataFrame) -> DataFrame:
    """Errors of the last-week forecast per month, one back-test run each."""
    table = demand.demand_features(rows, adapters.FORECAST_TYPES).withColumn("prediction", F.col("lag_7"))
    month = F.date_trunc("month", F.col("date")).cast("timestamp_ntz")
    return forecasting.forecast_metrics(table.withColumn("month", month), ["month"])


def month_pairs(errors: DataFrame) -> DataFrame:
    """Each month's MAPE against the month before; one row per calendar month."""
    before = F.lag("mape").over(Window.partitionBy().orderBy("month"))
    pairs = errors.select("month", F.col("mape").alias("current"), before.alias("baseline"))
    return pairs.where(F.col("baseline").isNotNull())


def nation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores_by_nation(spark, sf_dir, stored_sales(spark, sf_dir))


def scores_by_nation(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Classifier metrics of the rule score per nation."""
    people = adapters.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("card"), F.col("c_nationkey").alias("nation")
    )
    scored = labelled(rows).join(people, "card")
    return classification.classifier_metrics(scored, by=["nation"])


def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-test, churn and monitoring runs in the layout of the run store."""
    rows = stored_sales(spark, sf_dir)
    errors = materialise(errors_by_month(rows), "errors")
    month_id = F.date_format("month", "yyyy-MM")
    demand_runs = runs.as_runs(
        errors, "demand_forecasting", month_id, F.col("month"), ["mae", "rmse", "mape"]
    )
    checked = alerts.alert_forecast(month_pairs(errors)).withColumns(
        {
            "alerts_critical": (F.col("severity") == "critical").cast("int"),
            "alerts_warning": (F.col("severity") == "warning").cast("int"),
        }
    )
    monitor_runs = runs.as_runs(
        checked, "monitoring", month_id, F.col("month"), ["alerts_critical", "alerts_warning"]
    )
    nation_id = F.format_string("nation-%02d", F.col("nation").cast("int"))
    started = F.timestamp_add("DAY", F.col("nation"), F.lit("2001-01-01").cast("timestamp_ntz"))
    churn_runs = runs.as_runs(
        scores_by_nation(spark, sf_dir, rows), "churn_classification", nation_id, started,
        ["precision", "recall", "f1", "roc_auc", "pr_auc"],
        tags=F.create_map(F.lit("model_name"), F.lit("rule_score")),
    )
    return demand_runs.unionByName(monitor_runs).unionByName(churn_runs)
