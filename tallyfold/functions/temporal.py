"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# Day names, Monday first.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded towards minus infinity.

    A purchase later on the reference day is therefore -1 days old.
    """
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(float(MICROS_PER_DAY))).cast("bigint")


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def monday_first_weekday(ts: Column) -> Column:
    """0 for Monday up to 6 for Sunday."""
    return F.weekday(ts)


def weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def day_name(weekday: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), weekday + 1)


def day_part(hour: Column) -> Column:
    """morning 6-11, afternoon 12-17, evening 18-20, night otherwise."""
    return (
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 20), "evening")
        .otherwise("night")
    )


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year.cast("int"), month.cast("int"))
