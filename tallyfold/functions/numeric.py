"""Numeric and display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_at_zero(value: Column) -> Column:
    """At least 0; a missing value stays missing."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def without_nan(value: Column) -> Column:
    """NaN becomes NULL, which comparisons and aggregates leave out."""
    return F.nanvl(value, F.lit(None).cast("double"))


def minmax(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column becomes 0.5."""
    return F.when(high == low, F.lit(0.5)).otherwise((value - low) / (high - low))


def minmax_inverted(value: Column, low: Column, high: Column) -> Column:
    return F.lit(1.0) - minmax(value, low, high)


def safe_ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """``numerator / denominator``, or ``default`` when the denominator is 0 or NULL."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(default))


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def masked_card(card: Column) -> Column:
    return F.concat(F.lit("****"), F.right(card, F.lit(4)))


def as_percent(share: Column, digits: int = 1) -> Column:
    return half_even(share * 100, digits)


def bubble_size(monetary: Column) -> Column:
    return F.when(monetary.isNotNull(), F.pow(F.greatest(monetary, F.lit(1.0)), F.lit(0.4)))


def currency(value: Column) -> Column:
    return F.concat(F.lit("R$ "), F.format_number(value, 2))
