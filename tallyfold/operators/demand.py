"""Daily demand per product: dense calendar, lags, rolling means.

A dense series is made inside one window per product: every sales day also emits
the empty days up to the next one. Rows of one product number at most the days of
its calendar, so no group grows with the sales volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyfold.functions import temporal
from tallyfold.operators import cleaning
from tallyfold.operators.ordering import running_totals
from tallyfold.scratch import materialise

LAGS = (1, 7, 14)
ROLLING_WINDOWS = (7, 14)
LAG_FEATURES = ["lag_1", "lag_7", "lag_14", "rolling_mean_7", "rolling_mean_14"]
CALENDAR_FEATURES = ["day_of_week", "is_weekend", "month"]
MODEL_FEATURES = LAG_FEATURES + CALENDAR_FEATURES
DEMAND_COLUMNS = ["product", "date", "revenue", "n_transactions", *MODEL_FEATURES]


def by_date() -> WindowSpec:
    return Window.partitionBy("product").orderBy("date")


def daily_sales(sales: DataFrame) -> DataFrame:
    """``product, date, revenue, n_transactions`` on days with sales."""
    return (
        sales.where(F.col("coffee_name").isNotNull() & F.col("datetime").isNotNull())
        .groupBy(F.col("coffee_name").alias("product"), F.to_date("datetime").alias("date"))
        .agg(
            F.coalesce(F.sum("money"), F.lit(0.0)).alias("revenue"),
            F.count("money").alias("n_transactions"),
        )
    )


def _fill_days(daily: DataFrame, start: Column, end: Column, measures: Sequence[str]) -> DataFrame:
    """Emit each sales day and the empty days that follow it, up to ``end``.

    The first sales day of a product also emits the days from ``start``.
    """
    following = F.lead("date").over(by_date())
    spans = daily.select(
        "*",
        F.when(F.row_number().over(by_date()) == 1, start).otherwise(F.col("date")).alias("_from"),
        F.coalesce(F.date_sub(following, 1), end).alias("_to"),
    )
    days = spans.select("*", F.explode(F.sequence("_from", "_to")).alias("_day"))
    sold = F.col("_day") == F.col("date")
    kinds = dict(daily.dtypes)
    return days.select(
        "product",
        F.col("_day").alias("date"),
        *[F.when(sold, F.col(c)).otherwise(F.lit(0).cast(kinds[c])).alias(c) for c in measures],
    )


def cross_calendar(daily: DataFrame, measures: Sequence[str] = ("revenue", "n_transactions")) -> DataFrame:
    """Every product on every day of the common date range; missing days are 0."""
    stored = materialise(daily, "daily")
    span = stored.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    return _fill_days(stored, span["lo"], span["hi"], measures)


def own_range_calendar(daily: DataFrame, measures: Sequence[str] = ("revenue", "n_transactions")) -> DataFrame:
    """Every product on every day between its own first and last sales day."""
    return _fill_days(daily, F.col("date"), F.col("date"), measures)


def daily_demand(sales: DataFrame, products: Sequence[str] | DataFrame = cleaning.FORECAST_PRODUCTS) -> DataFrame:
    return cross_calendar(daily_sales(cleaning.product_whitelist(sales, products)))


def lag_features(demand: DataFrame) -> DataFrame:
    """Revenue 1, 7 and 14 days before; 0 where there is none. Needs a dense series."""
    return demand.withColumns(
        {f"lag_{k}": F.coalesce(F.lag("revenue", k).over(by_date()), F.lit(0.0)) for k in LAGS}
    )


def rolling_features(demand: DataFrame) -> DataFrame:
    """Mean revenue of up to 7 and 14 preceding days, the day itself excluded."""
    return demand.withColumns(
        {
            f"rolling_mean_{w}": F.coalesce(
                F.avg("revenue").over(by_date().rowsBetween(-w, -1)), F.lit(0.0)
            )
            for w in ROLLING_WINDOWS
        }
    )


def demand_features(sales: DataFrame, products: Sequence[str] | DataFrame = cleaning.FORECAST_PRODUCTS) -> DataFrame:
    """The demand feature table, one row per product and day."""
    return (
        daily_demand(sales, products)
        .transform(lag_features)
        .transform(rolling_features)
        .transform(cleaning.calendar_features)
        .select(*DEMAND_COLUMNS)
    )


def moving_average(series: DataFrame, value: str, window: int = 7, strict: bool = False,
                   by: Sequence[str] = ("product",), name: str = "ma7") -> DataFrame:
    """Mean of the last ``window`` rows, the current one included.

    ``strict`` leaves the mean NULL until that many rows exist.
    """
    frame = Window.partitionBy(*by).orderBy("date").rowsBetween(1 - window, Window.currentRow)
    mean = F.avg(value).over(frame)
    if strict:
        mean = F.when(F.count(F.lit(1)).over(frame) == window, mean)
    return series.withColumn(name, mean)


def positioned(features: DataFrame) -> DataFrame:
    """Add ``position`` (0-based) in product-then-date order, and ``n_rows``.

    Offsets come from the row count per product, so no task sorts the whole table.
    """
    counts = features.groupBy("product").agg(F.count("*").alias("n"))
    offsets = running_totals(counts, ["product"], ["n"]).select(
        "product", (F.col("n_upto") - F.col("n")).alias("_offset"), F.col("n_total").alias("n_rows")
    )
    return features.join(offsets, "product").select(
        *features.columns,
        (F.row_number().over(by_date()) - 1 + F.col("_offset")).alias("position"),
        "n_rows",
    )


def halves(features: DataFrame, mode: str = "position") -> DataFrame:
    """Mark each row ``reference`` (first half) or ``current``.

    ``position`` halves the rows in product-then-date order; ``time`` halves the
    calendar, which is what a drift check over time should compare.
    """
    if mode == "position":
        placed = positioned(features)
        first = F.col("position") < F.floor(F.col("n_rows") / 2)
        return placed.withColumn("side", F.when(first, "reference").otherwise("current")).drop(
            "position", "n_rows"
        )
    if mode == "time":
        span = features.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
        middle = F.date_add(span["lo"], F.floor((F.datediff(span["hi"], span["lo"]) + 1) / 2).cast("int"))
        return features.withColumn(
            "side", F.when(F.col("date") < middle, "reference").otherwise("current")
        )
    raise ValueError(f"unknown mode: {mode}")


def recent_history(daily: DataFrame, days: int = 60) -> DataFrame:
    """Rows of each product from ``days`` days before its last day on."""
    last = F.max("date").over(Window.partitionBy("product"))
    return daily.withColumn("_last", last).where(
        F.col("date") >= F.date_sub(F.col("_last"), days)
    ).drop("_last")


def recent_rows(daily: DataFrame, rows: int = 60) -> DataFrame:
    """The last ``rows`` rows of each product."""
    newest = Window.partitionBy("product").orderBy(F.col("date").desc())
    return daily.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= rows).drop("_r")


def day_label(column: str = "date") -> Column:
    return temporal.day_name(F.weekday(column))
