"""Validation, cleaning and row-level enrichment of sales transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import numeric, temporal
from tallyfold.operators.ordering import exact_quantiles
from tallyfold.schemas import SALES_TYPES, require_columns
from tallyfold.sources import files

ANONYMOUS = "anonymous"

# The products forecast by default.
FORECAST_PRODUCTS = [
    "Americano",
    "Americano with Milk",
    "Cappuccino",
    "Cocoa",
    "Cortado",
    "Espresso",
    "Hot Chocolate",
    "Latte",
]


class SchemaViolation(ValueError):
    """Raised with every broken rule and its number of rows."""


def coerce_types(df: DataFrame) -> DataFrame:
    """Cast the known columns; a value that does not convert, or is not a number, becomes NULL."""
    out = df
    for name, target in SALES_TYPES.items():
        if name in df.columns:
            out = out.withColumn(name, _coerced(df, name, target))
    return out


def _coerced(df: DataFrame, name: str, target: str) -> Column:
    if target == "timestamp_ntz" and dict(df.dtypes)[name] == "string":
        return F.try_to_timestamp(F.col(name)).cast("timestamp_ntz")
    cast = F.col(name).try_cast(target)
    return numeric.without_nan(cast) if target == "double" else cast


def schema_rules() -> dict[str, Column]:
    """Rule name to the condition that breaks it, on coerced columns."""
    return {
        "datetime_not_null": F.col("datetime").isNull(),
        "cash_type_not_null": F.col("cash_type").isNull(),
        "cash_type_known": ~F.col("cash_type").isin("card", "cash"),
        "money_not_null": F.col("money").isNull(),
        "money_positive": F.col("money") <= 0,
        "coffee_name_not_null": F.col("coffee_name").isNull(),
    }


def schema_violations(df: DataFrame) -> DataFrame:
    """``rule, n_bad`` for every rule, from one pass over the coerced rows."""
    require_columns(df, [c for c in SALES_TYPES if c != "card"])
    rules = schema_rules()
    counts = coerce_types(df).agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_bad")


def validate_schema(df: DataFrame) -> DataFrame:
    """Coerced rows, or one error that lists all broken rules. Extra columns pass."""
    broken = schema_violations(df).where("n_bad > 0").collect()  # one row per rule
    if broken:
        raise SchemaViolation(", ".join(f"{r.rule}: {r.n_bad}" for r in broken))
    return coerce_types(df)


def ingest(spark, out_path: str, source: str | None = None, raw_paths: Sequence[str] = ()) -> DataFrame:
    """Load one file or merge several, validate, store as CSV; returns the validated rows."""
    raw = files.scan_csv(spark, source) if source else files.scan_merge_sources(spark, raw_paths)
    validated = validate_schema(raw)
    files.sink_csv(validated, out_path)
    return validated


def parse_datetime(df: DataFrame) -> DataFrame:
    """Parse ``datetime``; rows that do not parse are dropped."""
    return df.withColumn("datetime", _coerced(df, "datetime", "timestamp_ntz")).where(
        F.col("datetime").isNotNull()
    )


def temporal_features(df: DataFrame) -> DataFrame:
    ts = F.col("datetime")
    hour = F.hour(ts)
    return df.withColumns(
        {
            "hour": hour.cast("tinyint"),
            "day_of_week": temporal.monday_first_weekday(ts).cast("tinyint"),
            "week_of_year": F.weekofyear(ts).cast("tinyint"),
            "month": F.month(ts).cast("tinyint"),
            "year": F.year(ts).cast("smallint"),
            "is_weekend": temporal.weekend(ts),
            "time_of_day_bucket": temporal.day_part(hour),
        }
    )


def remove_invalid_rows(df: DataFrame) -> DataFrame:
    # NaN is larger than any number in comparisons.
    money = numeric.without_nan(F.col("money").cast("double"))
    return df.where((money > 0) & F.col("coffee_name").isNotNull())


def iqr_bounds(df: DataFrame, value: str = "money", factor: float = 1.5) -> DataFrame:
    """One row ``lower, upper`` from the exact quartiles."""
    q = exact_quantiles(df, value, [0.25, 0.75]).select(
        F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("q3")
    )
    spread = F.col("q3") - F.col("q1")
    return q.select(
        (F.col("q1") - factor * spread).alias("lower"),
        (F.col("q3") + factor * spread).alias("upper"),
    )


def iqr_outlier_filter(df: DataFrame, value: str = "money", factor: float = 1.5) -> DataFrame:
    """Keep the rows within both fences."""
    fence = iqr_bounds(df, value, factor).select(F.struct("lower", "upper")).scalar()
    return df.where(F.col(value).between(fence["lower"], fence["upper"]))


def normalise_card(df: DataFrame) -> DataFrame:
    return df.withColumn("card", F.coalesce("card", F.lit(ANONYMOUS)))


def preprocess(df: DataFrame) -> DataFrame:
    """Parse, enrich, drop invalid rows and outliers, name anonymous customers."""
    return (
        df.transform(parse_datetime)
        .transform(temporal_features)
        .transform(remove_invalid_rows)
        .transform(iqr_outlier_filter)
        .transform(normalise_card)
    )


def identified(df: DataFrame) -> DataFrame:
    """Rows of known customers; this also removes the one oversized customer key."""
    return df.where(F.col("card").isNotNull() & (F.col("card") != ANONYMOUS))


def product_whitelist(df: DataFrame, products: Sequence[str] | DataFrame = FORECAST_PRODUCTS,
                      column: str = "coffee_name") -> DataFrame:
    """Keep listed products; the list is literal values or a table with the column."""
    if isinstance(products, DataFrame):
        return df.join(products.select(column).distinct(), column, "left_semi")
    return df.where(F.col(column).isin(*products))


def date_range(df: DataFrame, start: str | None, end: str | None, column: str = "date") -> DataFrame:
    """Both ends included; without both ends nothing is filtered."""
    if not (start and end):
        return df
    return df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def calendar_features(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumns(
        {
            "day_of_week": F.weekday(column).cast("tinyint"),
            "is_weekend": temporal.weekend(F.col(column)).cast("tinyint"),
            "month": F.month(column).cast("tinyint"),
        }
    )
