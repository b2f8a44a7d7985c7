"""Registry of queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(key: str, sql: str | None = None, doubles: str = "", digits: int = 4):
    """Register a query; its double columns are rounded alike on both sides.

    Rounding only hides the order in which floating-point values were added up.
    Amounts have four decimals, so sums are safe at four digits. A mean may fall
    halfway between two of those, hence ``name:8`` for a column with other digits.
    """
    places = {}
    for entry in doubles.split():
        name, _, own = entry.partition(":")
        places[name] = int(own or digits)

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"registered twice: {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            # Adding 0.0 turns a rounded -0.0 into 0.0.
            return out.withColumns({c: F.round(c, n) + F.lit(0.0) for c, n in places.items()})

        QUERIES[key] = run
        if sql is not None:
            CHECKS[key] = rounded_sql(sql, places)
        return fn

    return register


def rounded_sql(sql: str, places: dict[str, int]) -> str:
    if not places:
        return sql
    replaced = ", ".join(f"round({c}, {n}) + 0.0 AS {c}" for c, n in places.items())
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"
