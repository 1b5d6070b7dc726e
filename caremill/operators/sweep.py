"""How many intervals, and how much of a measure, are active on each day.

Instead of joining days to all intervals that cover them, each interval adds itself on its first
day and takes itself off on its end day. The daily sums of these changes are pre-aggregated
before the shuffle; what is left to accumulate is one row per day and group.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_changes(
    df: DataFrame,
    start: Column,
    end: Column,
    measure: Column,
    by: tuple[str, ...] = (),
    first: Column | None = None,
    counted: Column | None = None,
) -> DataFrame:
    """Net change per day (and group) of active intervals, of intervals with a measure, and of
    the measure's sum, in the measure's own type. Only intervals where ``counted`` is not NULL are counted as
    active; their measure is summed all the same. Both ends are dates; a NULL end never comes off; empty and inverted
    intervals count nothing. What happens before ``first`` is counted on that day. Kept per day
    as well, over all intervals: the last start."""
    lasts = start < F.coalesce(end, F.date_add(start, 1))
    counts = F.when(lasts if counted is None else lasts & counted.isNotNull(), F.lit(1)).otherwise(F.lit(0))
    priced = F.when(lasts & measure.isNotNull(), F.lit(1)).otherwise(F.lit(0))
    amount = F.when(lasts & measure.isNotNull(), measure).otherwise(F.lit(0))
    no_date = F.lit(None).cast("date")

    def change(at: Column, sign: int, started: Column) -> Column:
        # greatest() would turn "no day" into ``first``.
        counted_on = at if first is None else F.when(at.isNotNull(), F.greatest(at, first))
        return F.struct(
            counted_on.alias("day"),
            (counts * sign).alias("n"),
            (priced * sign).alias("priced"),
            (amount * sign).alias("amount"),
            started.alias("started"),
        )

    both = F.array(change(start, 1, start), change(end, -1, no_date))
    return (
        df.select(*by, F.explode(both).alias("c"))
        .filter(F.col("c.day").isNotNull())
        .groupBy(*by, F.col("c.day").alias("day"))
        .agg(
            F.sum("c.n").alias("n"),
            F.sum("c.priced").alias("priced"),
            F.sum("c.amount").alias("amount"),
            F.max("c.started").alias("last_start"),
        )
    )


def active_by_day(
    df: DataFrame, start: Column, end: Column, measure: Column, first: date, day: str, counted: Column | None = None
) -> DataFrame:
    """Active, priced and amount for each day from ``first`` to the last start, 0 where nothing is
    active. The calendar is filled in between the daily changes, so the intervals are read once."""
    opening = F.lit(first)
    changes = daily_changes(df, start, end, measure, first=opening, counted=counted)
    # From here on: at most one row per calendar day, so a single task is enough.
    whole, by_day = Window.partitionBy(), Window.orderBy("day")
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"n": "active", "priced": "priced", "amount": "amount"}
    states = changes.select(
        F.col("day").alias("_day"),
        *[F.sum(name).over(running).alias(alias) for name, alias in sums.items()],
        F.lag("day").over(by_day).alias("_before"),
        F.date_sub(F.lead("day").over(by_day), 1).alias("_until"),
        F.max("last_start").over(whole).alias("_last"),
    )
    # The state of a day lasts until the next change; before the first change there is none.
    begin = F.when(F.col("_before").isNull(), opening).otherwise(F.col("_day"))
    until = F.least(F.coalesce("_until", "_last"), F.col("_last"))
    return (
        states.filter((F.col("_day") <= F.col("_last")) & (F.col("_last") >= opening))
        .withColumn(day, F.explode(F.sequence(begin, until)))
        .select(day, *[F.when(F.col(day) >= F.col("_day"), F.col(c)).otherwise(F.lit(0)).alias(c) for c in sums.values()])
    )


def active_by_group(
    df: DataFrame, start: Column, end: Column, measure: Column, days: DataFrame, day: str, by: str
) -> DataFrame:
    """(day, group) rows with at least one active interval, for those of ``days`` that the
    intervals reach: from the first start to the last known end or start. Each group's daily changes, at most
    one row per day, pass through one task."""
    changes = daily_changes(df, start, end, measure, by=(by,))
    reach = df.agg(F.max(F.when(start.isNotNull(), F.coalesce(end, start)))).scalar()
    in_group = Window.partitionBy(by).orderBy("day")
    running = in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = changes.select(
        by,
        "day",
        F.sum("n").over(running).alias("active"),
        F.sum("priced").over(running).alias("priced"),
        F.sum("amount").over(running).alias("amount"),
        F.date_sub(F.lead("day").over(in_group), 1).alias("_until"),
    )
    until = F.least(F.coalesce(F.col("_until"), reach), reach)
    return (
        states.filter((F.col("active") > 0) & (F.col("day") <= until))
        .select(by, F.explode(F.sequence("day", until)).alias(day), "active", "priced", "amount")
        .join(days.select(day), day)
    )
