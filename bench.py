"""Time the registered queries over whole tables and print one JSON line.

Each query runs twice into a sink that discards its rows: cold first, then warm. ``value`` is the
sum of the warm times of the headline queries, which all derive their raw tables from the test tables
within the measured time. For the daily revenue and plan-mix queries a plain range join is timed
as well, to compare the sweep with.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.operators.versions import cursor_of, rows_after
from caremill.plans.catalogue import QUERIES
from caremill.plans.models import Models
from caremill.session import local_session
from caremill.sources import bindings
from caremill.sources.bindings import RawTables

# Checks of all tables and stored or streamed syncs write and re-read tables: correctness, not speed.
NOT_TIMED = {
    "check_suite", "check_suite_raw", "check_banned_columns", "check_artifacts", "artifact_columns",
    "sync_merge_stored", "sync_replace", "snapshot_stored", "stream_append", "stream_merge",
    "sync_append_stored", "sync_append_recent", "sync_cursor_state", "sync_merge_lookback", "stream_append_lookback",
    "land_full_refresh", "land_registry",
}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def naive_mrr(spark: SparkSession, folder: str) -> DataFrame:
    """Daily revenue by joining each day to all subscriptions active on it."""
    m = Models(RawTables(spark, folder))
    ends = F.coalesce("cancelled_at", F.lit(bindings.ORDERS_AS_OF + timedelta(days=1)))
    on = (F.col("calendar_date") >= F.col("started_at")) & (F.col("calendar_date") < ends)
    return m.revenue_days.join(m.subscriptions, on, "left").groupBy("calendar_date").agg(
        F.count("subscription_id").alias("active_subscriptions"), F.sum("mrr_amount").alias("mrr")
    )


def naive_plan_mix(spark: SparkSession, folder: str) -> DataFrame:
    m = Models(
        RawTables(spark, folder, recent=True), bindings.EVENTS_AS_OF, revenue_start=bindings.RECENT_REVENUE_START
    )
    on = (F.col("calendar_date") >= F.col("valid_from").cast("date")) & (
        F.col("valid_to").isNull() | (F.col("calendar_date") < F.col("valid_to").cast("date"))
    )
    return m.revenue_days.join(m.plan_periods, on).groupBy("calendar_date", "plan_id").agg(
        F.count(F.lit(1)).alias("subscriptions"), F.sum("mrr_amount").alias("mrr")
    )


def rows_moved(spark: SparkSession, folder: str) -> dict[str, list[int]]:
    """Rows a run moves when all but the last day had been synced before, and all rows."""
    m = Models(RawTables(spark, folder))
    tables = {
        "patients": (m.patients, "updated_at"),
        "appointments": (m.appointments, "updated_at"),
        "subscriptions": (m.subscriptions, "updated_at"),
        "subscription_events": (m.subscription_events, "event_at"),
        "marketing_touchpoints": (m.touchpoints, "event_at"),
    }
    moved = {}
    for name, (df, cursor) in tables.items():
        last_day = F.date_trunc("day", cursor_of(df, cursor).scalar()).cast("timestamp_ntz")
        moved[name] = [rows_after(df, cursor, last_day - F.expr("INTERVAL '1' SECOND")).count(), df.count()]
    return moved


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    spark = local_session(cores)
    timed = {name: query for name, query in QUERIES.items() if name not in NOT_TIMED or name in only}
    naive = {"naive_range_join_mrr_daily": naive_mrr, "naive_range_join_plan_mix": naive_plan_mix}
    if only:
        timed = {name: query for name, query in {**timed, **naive}.items() if name in only}
        naive = {}
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    for name, query in {**timed, **naive}.items():
        for times in (cold, warm):
            begin = time.perf_counter()
            run(query(spark, folder))
            times[name] = round(time.perf_counter() - begin, 3)
    result = {
        "metric": "total seconds of all timed queries, warm",
        "value": round(sum(warm[name] for name in timed), 3),
        "unit": "sec",
        "queries": {name: warm[name] for name in timed},
        "cold": {name: cold[name] for name in timed},
        "compared": {name: warm[name] for name in naive},
        "rows_moved_daily_and_in_full": {} if only else rows_moved(spark, folder),
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "spark": spark.version,
        "master": spark.sparkContext.master,
        "cores": int(cores) if cores.isdigit() else cores,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
