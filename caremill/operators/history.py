"""Versioned history (valid_from, valid_to) from an event log, and looking into it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremill.operators.ordered import OrderedRows
from caremill.operators.skew import HotKeys


def history_from_events(
    sets: DataFrame,
    closes: DataFrame,
    key: str,
    state: str,
    at: str,
    tie: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One version per row of ``sets``: it lasts until the next one of its key; the last one
    lasts until the key's first row in ``closes``, or is current without any.

    A close before the last version's start yields a version that ends before it begins.
    """
    first_close = closes.groupBy(key).agg(F.min(at).alias("_closed"))
    versions = (
        OrderedRows(sets.select(key, state, at, tie), [key], [at, tie], hot)
        .neighbours(following={"_next": at}, number="version")
        .lookup(first_close)
        .frame()
    )
    return versions.select(
        key,
        state,
        "version",
        F.col(at).alias("valid_from"),
        F.coalesce("_next", "_closed").alias("valid_to"),
        (F.col("_next").isNull() & F.col("_closed").isNull()).alias("is_current"),
    )


def valid_at(start: str, end: str, moment: Column) -> Column:
    return (F.col(start) <= moment) & F.coalesce(F.col(end) > moment, F.lit(True))


def as_of(history: DataFrame, moment: date | datetime, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions in force at a moment."""
    return history.filter(valid_at(start, end, F.lit(moment).cast(history.schema[start].dataType)))
