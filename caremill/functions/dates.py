"""Calendar arithmetic that counts crossed boundaries, as the care marts define it.

Timestamps are zone-free (``timestamp_ntz``) throughout, so no result depends on the session zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMESTAMP = "timestamp_ntz"


def timestamp(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(TIMESTAMP)


def day(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("date")


def years_between(start: Column, end: Column) -> Column:
    """New Year's days crossed, not full years elapsed."""
    return (F.year(end) - F.year(start)).cast("bigint")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed."""
    return F.datediff(day(end), day(start)).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Full minutes on the clock crossed, seconds ignored."""

    def of_day(column: Column) -> Column:
        return F.hour(column) * 60 + F.minute(column)

    return days_between(start, end) * 1440 + of_day(end) - of_day(start)


def month_start(column: Column) -> Column:
    return F.date_trunc("month", column).cast(TIMESTAMP)


def week_start(column: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", column).cast(TIMESTAMP)


def day_spine(df: DataFrame, first: date, last: Column, name: str = "calendar_date") -> DataFrame:
    """One row per day from ``first`` to the aggregate ``last`` of ``df``, both included."""
    start = F.lit(first).cast("date")
    return (
        df.agg(day(last).alias("_last"))
        .filter(F.col("_last") >= start)
        .select(F.explode(F.sequence(start, F.col("_last"))).alias(name))
    )
