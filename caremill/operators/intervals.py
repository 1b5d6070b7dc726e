"""Join rows to the intervals that cover them, within a key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremill.operators.history import valid_at


def join_covering(
    rows: DataFrame,
    periods: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    since: date,
    until: date,
    slice_days: int = 366,
) -> DataFrame:
    """``rows`` left-joined to all ``periods`` of the same key with start <= at < end (NULL end: open).

    Key and date range alone would compare each row with every period of its key. So time is cut
    into slices: a period is listed once for each slice it touches, and the join is on (key,
    slice) with the exact range checked behind it. Rows that lie by key already are not shuffled
    again (see ``session``); adaptive execution splits a key with a third of all rows.

    ``since`` and ``until`` say where most rows lie. What comes before or after falls into the
    first or last slice, so they bound the copies of a period and never change the result.
    ``start`` and ``end`` are not in the result.
    """

    def slice_of(column: Column) -> Column:
        clamped = F.least(F.greatest(column, F.lit(since)), F.lit(until))
        return F.floor(F.datediff(clamped, F.lit(since)) / slice_days)

    # An empty or inverted period covers nothing. An open one reaches the last slice.
    last_day = F.coalesce(F.date_sub(F.col(end), 1), F.greatest(F.col(start), F.lit(until)))
    sliced = (
        periods.filter(F.col(start) <= last_day)
        .withColumn("_slice", F.explode(F.sequence(slice_of(F.col(start)), slice_of(last_day))))
        .withColumnsRenamed({key: "_key", "_slice": "_period_slice", start: "_start", end: "_end"})
    )
    sliced_rows = rows.withColumn("_row_slice", slice_of(F.col(at)))
    covering = (
        (F.col(key) == F.col("_key"))
        & (F.col("_row_slice") == F.col("_period_slice"))
        & valid_at("_start", "_end", F.col(at))
    )
    return sliced_rows.join(sliced, covering, "left").drop("_row_slice", "_period_slice", "_key", "_start", "_end")
