"""The registered queries: every model, sync, check and dashboard answer by name.

Each takes a session and a folder of test tables and returns a DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.functions.privacy import BANNED_COLUMNS, direct_identifiers, read_registry
from caremill.operators import versions
from caremill.operators.history import as_of
from caremill.operators.ordered import OrderedRows
from caremill.plans import bi, care, clinical, quality
from caremill.plans.models import SCHEMAS, Models, publish_tables, report_view, served
from caremill.session import configure, scratch_path
from caremill.sources import bindings, landing, stored
from caremill.sources.artifacts import artifact_columns
from caremill.sources.bindings import RawTables
from caremill.streaming.sync import append_stream, arriving, merge_stream, once

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def _models(name: str, pick: Callable[[Models], DataFrame], **raw: bool) -> None:
    """Register a query over the models of the test tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        tables = RawTables(spark, folder, **raw)
        if raw.get("recent"):
            return pick(Models(tables, bindings.EVENTS_AS_OF, revenue_start=bindings.RECENT_REVENUE_START))
        return pick(Models(tables))

    QUERIES[name] = run


def _tile(name: str, pick: Callable[[Models], DataFrame], *reads: str) -> None:
    """Register a query that reads written serving tables and nothing else."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        return pick(served(RawTables(spark, folder), reads))

    QUERIES[name] = run


# -- staging, intermediate and marts --------------------------------------------------------

_models("mrr_daily", lambda m: m.fct_mrr_daily)
_models("stg_patients", lambda m: m.patients)
_models("stg_providers", lambda m: m.providers)
_models("stg_appointments", lambda m: m.appointments)
_models("stg_subscriptions", lambda m: m.subscriptions)
_models("stg_subscription_events", lambda m: m.subscription_events)
_models("stg_touchpoints", lambda m: m.touchpoints)
_models("stg_encounters", lambda m: m.encounters)
_models("stg_ehr_patients", lambda m: m.clinical_patients)
_models("stg_payer_transitions", lambda m: m.payer_transitions)
_models("int_appointments", lambda m: m.appointments_enriched)
_models("int_subscriptions", lambda m: m.subscriptions_enriched)
_models("int_attribution", lambda m: m.attribution)
_models("payer_periods", lambda m: m.payer_periods)
_models("payer_periods_gap3", lambda m: clinical.payer_periods(m.payer_transitions, 3, m.hot_patients))
_models("dim_patients", lambda m: m.dim_patients)
_models("dim_providers", lambda m: m.dim_providers)
_models("subscription_history", lambda m: m.subscription_history)
_models("history_as_of", lambda m: as_of(m.subscription_history, date(2024, 1, 15)))
_models("fct_appointments", lambda m: m.fct_appointments)
_models("fct_subscriptions", lambda m: m.fct_subscriptions)
_models("clinical_encounters", lambda m: m.clinical_encounters)
_models("marketing_attribution", lambda m: m.marketing)
_models("plan_mix", lambda m: m.plan_mix, recent=True)
_models("plan_transitions", lambda m: m.plan_transitions)

# -- dashboards -----------------------------------------------------------------------------

_tile(
    "bi_overview",
    lambda m: bi.overview(m.dim_patients, m.fct_mrr_daily, m.fct_appointments, m.marketing),
    "dim_patients", "fct_mrr_daily", "fct_appointments", "marketing",
)
_tile("bi_mrr_trend", lambda m: bi.mrr_trend(m.fct_mrr_daily), "fct_mrr_daily")
_tile("bi_mrr_headline_trend", lambda m: bi.mrr_headline_trend(m.fct_mrr_daily), "fct_mrr_daily")
_models("bi_sub_stats", lambda m: bi.subscription_stats(m.subscriptions))
_models("bi_plan_mix", lambda m: bi.active_plan_mix(m.subscriptions))
_tile("bi_appt_kpis", lambda m: bi.appointment_kpis(m.fct_appointments), "fct_appointments")
_tile("bi_appts_week", lambda m: bi.appointments_by_week(m.fct_appointments), "fct_appointments")
_tile("bi_noshow_specialty", lambda m: bi.no_show_by_specialty(m.fct_appointments), "fct_appointments")
_tile("bi_appts_type", lambda m: bi.appointments_by_type(m.fct_appointments), "fct_appointments")
_tile("bi_channels", lambda m: bi.channels(m.marketing), "marketing")
_tile("bi_mkt_kpis", lambda m: bi.marketing_kpis(m.marketing), "marketing")
_tile("bi_by_channel", lambda m: bi.marketing_by_channel(m.marketing), "marketing")
_tile("bi_by_channel_like", lambda m: bi.marketing_by_channel(m.marketing, "%i%"), "marketing")
_tile("bi_mkt_detail", lambda m: bi.marketing_detail(m.marketing), "marketing")
_tile("bi_enc_kpis", lambda m: bi.encounter_kpis(m.clinical_encounters), "clinical_encounters")
_tile("bi_enc_month", lambda m: bi.encounters_by_month(m.clinical_encounters), "clinical_encounters")
_tile("bi_enc_class", lambda m: bi.cost_by_class(m.clinical_encounters), "clinical_encounters")
_tile("bi_enc_demo", lambda m: bi.encounters_by_demographics(m.clinical_encounters), "clinical_encounters")
_models("bi_hist_headline", lambda m: bi.history_headline(m.plan_periods))
_models("bi_directions", lambda m: bi.plan_directions(m.plan_transitions))
_models("bi_mrr_compare", lambda m: bi.mrr_comparison(m.plan_mix, m.fct_mrr_daily), recent=True)
_models("bi_mrr_gap", lambda m: bi.mrr_gap(m.plan_mix, m.fct_mrr_daily), recent=True)
_models("bi_busiest", lambda m: bi.busiest_timelines(m.plan_periods))

# -- lean reports ---------------------------------------------------------------------------

_tile("view_patients", lambda m: report_view(m.serving_views(), "dim_patients"), "dim_patients")
_tile("view_appointments", lambda m: report_view(m.serving_views(), "fct_appointments"), "fct_appointments")
_tile("view_mrr", lambda m: report_view(m.serving_views(), "fct_mrr_daily"), "fct_mrr_daily")
_tile("view_marketing", lambda m: report_view(m.serving_views(), "mart_marketing_attribution"), "marketing")

# -- checks ---------------------------------------------------------------------------------

_models("check_unique", lambda m: quality.not_unique(m.subscriptions, "patient_id"))
_models(
    "check_unique_combo",
    lambda m: quality.not_unique(m.subscriptions, "patient_id", "started_at", ignore_nulls=False),
)
_models(
    "check_not_null",
    lambda m: quality.null_rows(m.touchpoints.select("touchpoint_id", "channel", "event_at"), "channel").drop("channel"),
)
_models(
    "check_accepted",
    lambda m: quality.unaccepted_values(m.subscription_events, "event_type", ("created", "plan_changed", "cancelled")),
)
_models(
    "check_relationship",
    lambda m: quality.orphans(
        m.appointments, "provider_id", m.providers.filter("specialty IS NOT NULL"), "provider_id"
    ),
)
_models("check_expression", lambda m: quality.false_rows(m.payer_transitions, "NOT is_invalid_interval"))
_models(
    "check_expression_where",
    lambda m: quality.false_rows(m.plan_periods, "valid_from <= valid_to", "valid_to IS NOT NULL").select(
        "subscription_id", "version", "valid_from", "valid_to"
    ),
)
_models("check_overlap", lambda m: quality.overlapping_periods(m.payer_periods, m.hot_patients))


@query
def check_overlap_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """The overlap check on something that does overlap: the subscriptions of a patient."""
    m = Models(RawTables(spark, folder))
    held = m.subscriptions.select(
        "patient_id",
        F.col("subscription_id").cast("bigint").alias("tie"),
        F.col("started_at").alias("valid_from"),
        F.col("cancelled_at").alias("valid_to"),
    )
    numbered = OrderedRows(held, ["patient_id"], ["valid_from", "tie"]).neighbours(number="payer_period_seq").frame()
    return quality.overlapping_periods(numbered)


_models("check_k_anonymity", lambda m: quality.small_cells(m.clinical_encounters))


@query
def check_suite(spark: SparkSession, folder: str) -> DataFrame:
    """All declared model checks, on tables written first as they would be in production."""
    m = Models(RawTables(spark, folder))
    m.publish(scratch_path(spark, "suite"))
    return quality.run_checks(quality.MODEL_CHECKS, {table: df for (_, table), df in m.tables().items()})


@query
def check_suite_raw(spark: SparkSession, folder: str) -> DataFrame:
    """All declared checks of the raw tables."""
    raw = RawTables(spark, folder)
    tables = {
        "raw.patients": raw.patients(),
        "raw.providers": raw.providers(),
        "raw.appointments": raw.appointments(),
        "raw.subscriptions": raw.subscriptions(),
        "raw.subscription_events": raw.subscription_events(),
        "raw.marketing_touchpoints": raw.marketing_touchpoints(),
        "raw.synthea_patients": raw.clinical_patients(),
        "raw.synthea_encounters": raw.encounters(),
        "raw.synthea_payer_transitions": raw.payer_transitions(raw.hot_patients()),
    }
    return quality.run_checks(quality.RAW_CHECKS, tables)


@query
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    raw = RawTables(spark, folder)
    return quality.freshness(
        {
            "patients": (raw.patients(), "updated_at"),
            "appointments": (raw.appointments(), "updated_at"),
            "subscriptions": (raw.subscriptions(), "updated_at"),
            "subscription_events": (raw.subscription_events(), "event_at"),
            "marketing_touchpoints": (raw.marketing_touchpoints(), "event_at"),
        },
        "2024-02-01 00:00:00",
    )


def _registry(spark: SparkSession) -> DataFrame:
    """The registry of columns, read from its file as a job would find it."""
    path = scratch_path(spark, "registry")
    rows = [(f" {name.upper()} ", str(tier), "") for name, tier in BANNED_COLUMNS.items()]
    spark.createDataFrame(rows, "column_name string, tier string, rationale string").coalesce(1).write.option(
        "header", True
    ).csv(path)
    return read_registry(spark, path)


def _published(spark: SparkSession, folder: str) -> tuple[str, dict[tuple[str, str], DataFrame]]:
    """Tables as a careless and a careful job would write them."""
    raw, m = RawTables(spark, folder), Models(RawTables(spark, folder))
    clinical_raw = raw.clinical_patients()
    tables = {
        (SCHEMAS["raw"], "synthea_patients"): landing.drop_identifiers(clinical_raw),
        (SCHEMAS["raw"], "synthea_patients_unfiltered"): clinical_raw,
        (SCHEMAS["marts"], "dim_patients"): m.dim_patients,
        (SCHEMAS["marts"], "dim_clinical_patients"): clinical_raw.select(F.col("Id").alias("patient_id"), "ZIP", "STATE"),
    }
    root = scratch_path(spark, "published")
    return root, publish_tables(spark, tables, root)


@query
def check_banned_columns(spark: SparkSession, folder: str) -> DataFrame:
    _, tables = _published(spark, folder)
    return quality.banned_columns(quality.column_catalogue(spark, tables), _registry(spark))


@query
def check_artifacts(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = _published(spark, folder)
    found = quality.banned_artifact_columns(artifact_columns(spark, root), _registry(spark))
    return found.select("artifact", "column_name", "rows")


@query
def artifact_column_list(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = _published(spark, folder)
    return artifact_columns(spark, root).select("artifact", "column_name", "rows")


QUERIES["artifact_columns"] = QUERIES.pop("artifact_column_list")

# -- landing --------------------------------------------------------------------------------


@query
def land_text(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV export read back as text and stamped."""
    path = scratch_path(spark, "export")
    RawTables(spark, folder).subscriptions().drop(landing.LOAD_STAMP).write.option("header", True).csv(path)
    columns = landing.CARE_TABLES["subscriptions"]
    return landing.stamp(landing.read_text_csv(spark, path, columns), bindings.LOADED_AT)


@query
def land_glob(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of CSV files read as one table; postal codes keep their leading zeros."""
    path = scratch_path(spark, "export")
    RawTables(spark, folder).clinical_patients().write.option("header", True).csv(path)
    return landing.read_text_csv(spark, path)


@query
def land_drop_tier1(spark: SparkSession, folder: str) -> DataFrame:
    """The same folder landed without direct identifiers."""
    path = scratch_path(spark, "export")
    RawTables(spark, folder).clinical_patients().write.option("header", True).csv(path)
    return landing.stamp(landing.drop_identifiers(landing.read_text_csv(spark, path)), bindings.LOADED_AT)


def _database(spark: SparkSession, name: str) -> str:
    """A database of its own in the shared folder."""
    place = scratch_path(spark, name)
    schema = place.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{place}'")
    return schema


@query
def land_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The providers after two full refreshes of the care exports; the second replaces what the first landed, and exports
    that are missing are skipped."""
    path, schema = scratch_path(spark, "exports"), _database(spark, "landed-care")
    providers = RawTables(spark, folder).providers().drop(landing.LOAD_STAMP)
    for state in (providers.withColumn("specialty", F.lit("old")).limit(1), providers):
        state.write.mode("overwrite").option("header", True).csv(f"{path}/providers.csv")
        landed = landing.land_care(spark, path, schema, bindings.LOADED_AT)
    return spark.table(f"{schema}.{landed[0]}")


@query
def land_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The clinical export landed twice without what the registry file names; an empty folder is skipped."""
    path, schema = scratch_path(spark, "exports"), _database(spark, "landed-clinical")
    RawTables(spark, folder).clinical_patients().write.option("header", True).csv(f"{path}/patients")
    spark.range(0).write.option("header", True).csv(f"{path}/payers")
    banned = direct_identifiers(_registry(spark))
    for _ in range(2):
        landed = landing.land_clinical(spark, path, schema, bindings.LOADED_AT, banned)
    return spark.table(f"{schema}.{landed[0]}")


# -- syncs ----------------------------------------------------------------------------------


def _subscriptions_on(subscriptions: DataFrame, day: str) -> DataFrame:
    """What the source showed at the start of a day: no later subscription, and no later end."""
    moment = F.lit(day).cast("date")
    ends_later = F.col("cancelled_at") >= moment
    return subscriptions.filter(F.col("started_at") < moment).withColumns(
        {
            "status": F.when(ends_later, F.lit("active")).otherwise(F.col("status")),
            "cancelled_at": F.when(~ends_later, F.col("cancelled_at")),
            "updated_at": F.when(ends_later, F.col("created_at")).otherwise(F.col("updated_at")),
        }
    )


def _two_states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(stored, source): the subscriptions as they were one day, and as they are in the end."""
    source = Models(RawTables(spark, folder)).subscriptions.drop("_loaded_at")
    return _subscriptions_on(source, "1999-01-01"), source


@query
def sync_replace(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table replaced by a new version of its source."""
    root = scratch_path(spark, "providers")
    providers = Models(RawTables(spark, folder)).providers
    stored.sync_replace(providers.withColumn("specialty", F.lit("old")), root)
    stored.sync_replace(providers, root)
    return stored.read_stored(spark, root)


@query
def sync_merge(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _two_states(spark, folder)
    return versions.refresh_incrementally(target, source, ["subscription_id"], "updated_at")


@query
def sync_merge_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a stored table, with a second run that finds nothing new."""
    root = scratch_path(spark, "subscriptions")
    target, source = _two_states(spark, folder)
    for state in (target, source, source):
        stored.sync_merge(state, root, ["subscription_id"], "updated_at")
    return stored.read_stored(spark, root, ["subscription_id"], "updated_at")


def _log_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(stored, source): the event log up to a day, and as a whole."""
    log = Models(RawTables(spark, folder)).subscription_events.drop("_loaded_at")
    return log.filter("event_at < DATE '2024-01-20'"), log


@query
def sync_merge_lookback(spark: SparkSession, folder: str) -> DataFrame:
    """The stored sync when some rows reach the source late, with a cursor the sync has passed: a later run reads the
    last 300 days again and takes each key's latest row once. What is later still is missed. Here the source shows paused
    subscriptions late."""
    root = scratch_path(spark, "late")
    source = Models(RawTables(spark, folder)).subscriptions.drop("_loaded_at")
    for state in (source.filter("status <> 'paused'"), source, source):
        stored.sync_merge(state, root, ["subscription_id"], "updated_at", lookback_days=300)
    return stored.read_stored(spark, root, ["subscription_id"], "updated_at")


def _log_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(stored, source): the event log up to a day, and as a whole."""
    log = Models(RawTables(spark, folder)).subscription_events.drop("_loaded_at")
    return log.filter("event_at < DATE '2024-01-20'"), log


@query
def sync_append(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _log_parts(spark, folder)
    return versions.append_after(target, source, "event_at")


@query
def sync_append_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a stored log: a run that dies before its log line is written, its retry, and a run that finds
    nothing new."""
    root = scratch_path(spark, "events")
    first, log = _log_parts(spark, folder)
    stored.sync_append(first, root, "event_at")
    # What a run leaves that died half-way.
    log.filter("event_at >= DATE '2024-01-20'").write.parquet(f"{root}/rows/_run=2")
    for _ in range(2):
        stored.sync_append(log, root, "event_at")
    return stored.read_appended(spark, root)


@query
def sync_append_recent(spark: SparkSession, folder: str) -> DataFrame:
    """What the stored log has past a day, from the files that hold any of it."""
    root = scratch_path(spark, "events")
    for part in _log_parts(spark, folder):
        stored.sync_append(part, root, "event_at")
    return stored.read_appended(spark, root, "event_at", datetime(2024, 1, 25))


@query
def sync_cursor_state(spark: SparkSession, folder: str) -> DataFrame:
    """Stored cursor of each incrementally synced table, from the logs of their syncs; no data file is opened."""
    m = Models(RawTables(spark, folder))
    merged = {"patients": (m.patients, "patient_id"), "appointments": (m.appointments, "appointment_id")}
    merged["subscriptions"] = (m.subscriptions, "subscription_id")
    appended = {"subscription_events": m.subscription_events, "marketing_touchpoints": m.touchpoints}
    appended["empty"] = m.touchpoints.filter("event_at IS NULL")
    root = scratch_path(spark, "cursors")
    for name, (df, key) in merged.items():
        stored.sync_merge(df, f"{root}/{name}", [key], "updated_at")
    for name, df in appended.items():
        stored.sync_append(df, f"{root}/{name}", "event_at")
    states = [
        stored.cursor_in_log(spark, f"{root}/{name}").select(F.lit(name).alias("table_name"), "last_value")
        for name in (*merged, *appended)
    ]
    return reduce(DataFrame.unionByName, states)


@query
def incremental_appointments(spark: SparkSession, folder: str) -> DataFrame:
    """The stored appointment fact as built one day, brought up to date by months, with a last run that finds nothing new.
    What was booked by then but not yet held was scheduled; what was booked later was not there."""
    m = Models(RawTables(spark, folder))
    # Derived once; the runs read it as written, as they would in production.
    m.publish(scratch_path(spark, "source"), ["fct_appointments"])
    fact = m.fct_appointments
    source = fact.withColumn("updated_at", F.greatest("created_at", "updated_at"))
    build_day = F.lit("2000-01-01").cast("timestamp_ntz")
    open_then = F.col("updated_at") > build_day
    first_build = source.filter(F.col("created_at") <= build_day).withColumns(
        {
            "status": F.when(open_then, F.lit("scheduled")).otherwise(F.col("status")),
            "updated_at": F.when(open_then, F.col("created_at")).otherwise(F.col("updated_at")),
        }
    )
    root = scratch_path(spark, "fct_appointments")
    for state in (first_build, source, source):
        stored.refresh_partitions(
            state, root, ["appointment_id"], "updated_at", "appointment_month", derived=care.booking_columns()
        )
    return stored.read_partitioned(spark, root)


WATCHED = ["plan_id", "mrr_amount", "status"]


def _subscription_states(spark: SparkSession, folder: str) -> list[tuple[DataFrame, str]]:
    """The subscriptions on three days, from a source that forgets them a year after they end."""
    subscriptions = Models(RawTables(spark, folder)).subscriptions
    states = []
    for day in ("1997-01-01", "1999-01-01", "2001-01-01"):
        kept = F.coalesce(F.col("cancelled_at") >= F.date_sub(F.lit(day).cast("date"), 365), F.lit(True))
        state = _subscriptions_on(subscriptions, day).filter(kept)
        states.append(
            (state.select("subscription_id", "patient_id", *WATCHED, "started_at", "cancelled_at"), f"{day} 00:00:00")
        )
    return states


@query
def snapshot_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Three snapshot runs in a row."""
    result = None
    for state, run_at in _subscription_states(spark, folder):
        result = versions.snapshot(state, result, "subscription_id", WATCHED, run_at)
    return result


@query
def snapshot_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same with each run's result stored, and the last run repeated."""
    root = scratch_path(spark, "snapshot")
    states = _subscription_states(spark, folder)
    for state, run_at in [*states, (states[-1][0], "2001-01-02 00:00:00")]:
        stored.take_snapshot(state, root, "subscription_id", WATCHED, run_at)
    return stored.read_snapshot(spark, root)


# -- streams --------------------------------------------------------------------------------


@query
def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """The event log taken in as a stream in two runs."""
    root = scratch_path(spark, "log")
    first, log = _log_parts(spark, folder)
    for part in (first, log.filter("event_at >= DATE '2024-01-20'")):
        part.write.mode("append").parquet(f"{root}/in")
        stream = arriving(spark, f"{root}/in", log.schema)
        append_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{root}/out")


@query
def stream_append_lookback(spark: SparkSession, folder: str) -> DataFrame:
    """The event log taken in as a stream whose second run brings the last days again: each event is taken once."""
    root = scratch_path(spark, "late-log")
    first, log = _log_parts(spark, folder)
    for part in (first, log.filter("event_at >= DATE '2024-01-17'")):
        part.write.mode("append").parquet(f"{root}/in")
        stream = once(arriving(spark, f"{root}/in", log.schema), ["event_id"], "event_at", lookback_days=5)
        append_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{root}/out")


@query
def stream_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Subscription changes merged as a stream in two runs."""
    root = scratch_path(spark, "changes")
    target, source = _two_states(spark, folder)
    for part in (target, source.filter("updated_at >= DATE '1999-01-01'")):
        part.write.mode("append").parquet(f"{root}/in")
        stream = arriving(spark, f"{root}/in", target.schema)
        merge_stream(stream, f"{root}/out", ["subscription_id"], "updated_at", f"{root}/checkpoint").awaitTermination()
    return stored.read_stored(spark, f"{root}/out", ["subscription_id"], "updated_at")
