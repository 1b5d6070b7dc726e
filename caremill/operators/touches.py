"""First and last touch per person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def touch_summary(touches: DataFrame, by: list[str], at: str, tie: str, cost: str, carried: list[str]) -> DataFrame:
    """Count, cost, first and last time, and what was carried by the first and the last touch.

    Plain aggregates, so each task shrinks its rows to one per group before the shuffle. A touch
    without a time comes after (first) or before (last) all others. Summaries can be merged
    with ``merge_summaries``.
    """
    what = F.struct(*carried)
    return touches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("touches"),
        F.sum(F.col(cost).cast("decimal(18,6)")).alias("cost"),
        F.min(_rank(at, tie, known_first=True, what=what)).alias("first"),
        F.max(_rank(at, tie, known_first=False, what=what)).alias("last"),
    )


def merge_summaries(summaries: DataFrame, by: list[str]) -> DataFrame:
    return summaries.groupBy(*by).agg(
        F.sum("touches").alias("touches"),
        F.sum("cost").alias("cost"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def _rank(at: str, tie: str, known_first: bool, what: Column) -> Column:
    known = F.col(at).isNull() if known_first else F.col(at).isNotNull()
    return F.struct(known.alias("known"), F.col(at).alias("at"), F.col(tie).alias("tie"), what.alias("what"))
