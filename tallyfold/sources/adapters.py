"""Sales transactions derived from the star-schema and event tables.

Both adapters read whole tables. Orders of the lowest priority, and page views,
stand for cash sales, which carry no customer card.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CASH_PRIORITY = "5-LOW"
CASH_EVENT = "view"

# Forecast products: every part type but the promotional one.
FORECAST_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: ``datetime, cash_type, card, money, coffee_name``."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    cash = F.col("o_orderpriority") == CASH_PRIORITY
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("o_orderdate").alias("datetime"),
            F.when(cash, "cash").otherwise("card").alias("cash_type"),
            F.when(~cash, F.col("o_custkey").cast("string")).alias("card"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("money"),
            F.col("p_type").alias("coffee_name"),
        )
    )


def last_order(spark: SparkSession, sf_dir: str) -> Column:
    """Time of the last order with a customer card, whether or not it has lines: no such sale of ``order_sales`` is later."""
    carded = table(spark, sf_dir, "orders").where((F.col("o_orderpriority") != CASH_PRIORITY) & F.col("o_custkey").isNotNull())
    return carded.agg(F.max("o_orderdate")).scalar()


def event_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, with a real time of day."""
    events = table(spark, sf_dir, "events")
    cash = F.col("event_type") == CASH_EVENT
    return events.select(
        F.col("ts").alias("datetime"),
        F.when(cash, "cash").otherwise("card").alias("cash_type"),
        F.when(~cash, F.col("user_id").cast("string")).alias("card"),
        F.col("value").alias("money"),
        F.col("event_type").alias("coffee_name"),
    )


def sales_view(sales: DataFrame) -> DataFrame:
    """Transactions with the reporting columns ``date, hour, day_of_week, day_name``."""
    return sales.select(
        "*",
        F.to_date("datetime").alias("date"),
        F.hour("datetime").alias("hour"),
        F.weekday("datetime").alias("day_of_week"),
        F.date_format("datetime", "EEEE").alias("day_name"),
    )
