"""Gaps and islands: fold consecutive intervals with the same value into one period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremill.functions.dates import days_between
from caremill.functions.values import row_key
from caremill.operators.ordered import OrderedRows
from caremill.operators.skew import HotKeys

FAR_FUTURE = "9999-12-31"


def fold_intervals(
    df: DataFrame,
    key: str,
    value: str,
    carried: str,
    start: str,
    end: str,
    gap_days: int = 0,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Periods of ``value`` per ``key`` over half-open intervals [start, end); a NULL end is open, and
    so is 9999-12-31 at the end of a period.

    A row opens a period when its value differs from the row before (or that one had none), or
    when more than ``gap_days`` lie between the end of the row before and its start. A row after
    an open interval of the same value joins it, and the period stays open. Only the row directly
    before counts, so an interval nested in an earlier, longer one may split a period.
    """
    rows = OrderedRows(df.select(key, value, carried, start, end), [key], [start, end, value, carried], hot)
    rows.neighbours(previous={"_value": value, "_end": end}, is_last="_is_last")
    gap = F.coalesce(days_between(F.col("_end"), F.col(start)), F.lit(0))
    opens = F.col("_value").isNull() | ~F.col("_value").eqNullSafe(F.col(value)) | (gap > gap_days)
    rows.with_columns({"_opens": opens.cast("bigint")})
    numbered = rows.running_sum("period_seq", "_opens").frame()

    # Ignore rows without a carried value when looking for the first and the last one.
    place = F.when(F.col(carried).isNotNull(), F.struct(start, carried))
    folded = numbered.groupBy(key, "period_seq", value).agg(
        F.min_by(carried, place).alias(f"first_{carried}"),
        F.max_by(carried, place).alias(f"last_{carried}"),
        F.count_distinct(carried).alias(f"distinct_{carried}s"),
        F.min(start).alias("_from"),
        # The far-future day stands for an open end.
        F.when(
            F.count(end) == F.count(F.lit(1)), F.nullif(F.max(end), F.lit(FAR_FUTURE).cast(df.schema[end].dataType))
        ).alias("_to"),
        F.count(F.lit(1)).alias("source_row_count"),
        # The period with the last row of its key is the latest one, open or not.
        F.bool_or("_is_last").alias("is_latest"),
    )
    return folded.select(
        row_key(key, "period_seq").alias("period_key"),
        key,
        "period_seq",
        value,
        f"first_{carried}",
        f"last_{carried}",
        f"distinct_{carried}s",
        F.col("_from").alias(start),
        F.col("_to").alias(end),
        days_between(F.col("_from"), F.col("_to")).alias("days"),
        "source_row_count",
        "is_latest",
    )
