"""Schemas of the logical tables and the check used at operator boundaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw sales file; values arrive as text and are coerced by the validation step.
RAW_SALES = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("datetime", T.StringType()),
        T.StructField("cash_type", T.StringType()),
        T.StructField("card", T.StringType()),
        T.StructField("money", T.StringType()),
        T.StructField("coffee_name", T.StringType()),
    ]
)

# The raw columns that must be present, and what they are coerced to.
SALES_TYPES = {
    "datetime": "timestamp_ntz",
    "cash_type": "string",
    "card": "string",
    "money": "double",
    "coffee_name": "string",
}

RUN_METRICS = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise when a needed column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def available_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The requested columns that exist, in the requested order."""
    present = set(df.columns)
    return [c for c in columns if c in present]
