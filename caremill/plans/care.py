"""Subscription, appointment and marketing models built on the staged care tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremill.functions.dates import day, day_spine, days_between, month_start, week_start
from caremill.functions.privacy import member_age_band
from caremill.functions.values import exact_ratio, lookup
from caremill.operators.history import history_from_events
from caremill.operators.ordered import OrderedRows
from caremill.operators.skew import HotKeys
from caremill.operators.sweep import active_by_day, active_by_group
from caremill.operators.touches import merge_summaries, touch_summary
from caremill.plans.staging import state_columns

# Monthly price and rank of each plan.
PLAN_PRICES = {"basic": 49, "plus": 99, "premium": 199}
PLAN_RANKS = {"basic": 1, "plus": 2, "premium": 3}

# Events that put a subscription on a plan, and the one that ends it.
PLAN_SETTING_EVENTS = ("created", "plan_changed")
CLOSING_EVENT = "cancelled"

# Fixed value: first day of the revenue calendar unless the caller says otherwise.
REVENUE_START = date(2024, 10, 1)


# -- appointments ---------------------------------------------------------------------------


def booking_columns() -> dict[str, Column]:
    """What follows from the other columns of an appointment."""
    slot = F.col("scheduled_at")
    return state_columns() | {
        "appointment_date": day(slot),
        "appointment_week": week_start(slot),
        "appointment_month": month_start(slot),
        "lead_time_days": days_between(F.col("created_at"), slot),
    }


def appointments_enriched(appointments: DataFrame, providers: DataFrame, patients: DataFrame) -> DataFrame:
    """Appointments with specialty, patient state and signup channel; one row each.

    Plain left joins: Spark broadcasts a side whose measured size allows it and otherwise splits
    a busy provider or patient at run time.
    """
    specialty = providers.select("provider_id", F.col("specialty").alias("provider_specialty"))
    origin = patients.select("patient_id", F.col("state").alias("patient_state"), "signup_channel")
    # Patients first: rows are dealt out by patient while they are narrow, and states follow behind.
    booked = appointments.drop(*state_columns())
    return (
        booked.join(origin, "patient_id", "left")
        .join(specialty, "provider_id", "left")
        .withColumns(booking_columns())
        .select(
            "appointment_id",
            "patient_id",
            "provider_id",
            "provider_specialty",
            "patient_state",
            "signup_channel",
            "appointment_type",
            "status",
            *state_columns(),
            "scheduled_at",
            "appointment_date",
            "appointment_week",
            "appointment_month",
            "lead_time_days",
            "created_at",
            "updated_at",
        )
    )


def fct_appointments(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "appointment_id",
        "patient_id",
        "provider_id",
        "provider_specialty",
        "patient_state",
        F.col("signup_channel").alias("patient_signup_channel"),
        "appointment_type",
        "status",
        "is_completed",
        "is_no_show",
        "is_cancelled",
        "lead_time_days",
        "appointment_date",
        "appointment_week",
        "appointment_month",
        "scheduled_at",
        "created_at",
        "updated_at",
    )


# -- subscriptions --------------------------------------------------------------------------


def subscriptions_enriched(subscriptions: DataFrame, events: DataFrame, as_of: date) -> DataFrame:
    """Current subscriptions with their number of plan changes and days of tenure."""
    # Only subscriptions that changed plan get a row here; the others count 0 below.
    changes = (
        events.filter(F.col("event_type") == "plan_changed")
        .groupBy("subscription_id")
        .agg(F.count(F.lit(1)).alias("changes"))
    )
    return subscriptions.join(changes, "subscription_id", "left").select(
        "subscription_id",
        "patient_id",
        "plan_id",
        "mrr_amount",
        "status",
        (F.col("status") == "active").alias("is_active"),
        "started_at",
        "cancelled_at",
        F.coalesce("changes", F.lit(0)).cast("bigint").alias("plan_change_count"),
        days_between(F.col("started_at"), F.coalesce("cancelled_at", F.lit(as_of))).alias("tenure_days"),
        "created_at",
        "updated_at",
    )


def fct_subscriptions(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "subscription_id",
        "patient_id",
        "plan_id",
        "mrr_amount",
        "status",
        "is_active",
        "started_at",
        "cancelled_at",
        F.trunc("started_at", "month").alias("start_cohort_month"),
        "tenure_days",
        "plan_change_count",
    )


def revenue_days(subscriptions: DataFrame, start: date = REVENUE_START) -> DataFrame:
    """Calendar of the revenue fact: from ``start`` to the last subscription start."""
    return day_spine(subscriptions, start, F.max("started_at"))


def fct_mrr_daily(subscriptions: DataFrame, as_of: date, start: date = REVENUE_START) -> DataFrame:
    """Active subscriptions and recurring revenue per day, at each subscription's current price."""
    runs_to = F.coalesce("cancelled_at", F.lit(as_of + timedelta(days=1)))
    daily = active_by_day(
        subscriptions,
        F.col("started_at"),
        runs_to,
        F.col("mrr_amount"),
        start,
        "calendar_date",
        # A row without an id is not counted, but its revenue is.
        counted=F.col("subscription_id"),
    )
    return daily.select(
        "calendar_date",
        F.col("active").alias("active_subscriptions"),
        F.col("amount").alias("mrr"),
        (F.col("amount") * 12).cast("double").alias("arr"),
        F.coalesce(exact_ratio(F.col("amount"), F.col("priced"), 2), F.lit(0.0)).alias("arpu"),
    ).orderBy("calendar_date")


def plan_periods(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Plan periods of each subscription, rebuilt from its event log.

    Activations and reactivations do not matter; a change after the first cancellation leaves a
    last period that ends before it begins.
    """
    sets = events.filter(F.col("event_type").isin(*PLAN_SETTING_EVENTS) & F.col("to_plan").isNotNull()).withColumn(
        "plan_id", F.lower("to_plan")
    )
    closes = events.filter(F.col("event_type") == CLOSING_EVENT)
    periods = history_from_events(sets, closes, "subscription_id", "plan_id", "event_at", "event_id", hot)
    return periods.withColumn("mrr_amount", lookup(F.col("plan_id"), PLAN_PRICES))


def subscription_history(periods: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Plan periods with the patient of each subscription."""
    return periods.join(subscriptions.select("subscription_id", "patient_id"), "subscription_id", "left").select(
        "subscription_id",
        "patient_id",
        "plan_id",
        "mrr_amount",
        "version",
        "valid_from",
        "valid_to",
        "is_current",
    )


def plan_mix_over_time(history: DataFrame, days: DataFrame) -> DataFrame:
    """Subscriptions and revenue per day and plan, with the plan in force on that day."""
    mix = active_by_group(
        history, day("valid_from"), day("valid_to"), F.col("mrr_amount"), days, "calendar_date", "plan_id"
    )
    return mix.select(
        "calendar_date",
        "plan_id",
        F.col("active").alias("subscriptions"),
        F.when(F.col("priced") > 0, F.col("amount")).alias("mrr"),
    ).orderBy("calendar_date", "plan_id")


def plan_transitions(history: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """How often subscriptions moved from one plan to the next, and whether upwards.

    Moves from or to a plan without a rank are not counted; staying on the plan counts as down.
    """
    moves = (
        OrderedRows(history.select("subscription_id", "version", "plan_id"), ["subscription_id"], ["version"], hot)
        .neighbours(previous={"old_plan": "plan_id"})
        .frame()
    )
    counted = moves.groupBy("old_plan", "plan_id").agg(F.count(F.lit(1)).alias("moves"))
    old, new = lookup(F.col("old_plan"), PLAN_RANKS), lookup(F.col("plan_id"), PLAN_RANKS)
    return (
        counted.filter(old.isNotNull() & new.isNotNull())
        .select(
            F.concat("old_plan", F.lit(" -> "), "plan_id").alias("transition"),
            F.when(new > old, F.lit("upgrade")).otherwise(F.lit("downgrade")).alias("direction"),
            F.col("moves").alias("changes"),
        )
        .orderBy(F.desc("changes"), "transition")
    )


# -- people and marketing -------------------------------------------------------------------


def attribution(touchpoints: DataFrame, patients: DataFrame) -> DataFrame:
    """Touches per patient, with channel and campaign of the first and the last one.

    A touch belongs to the patient it names, else to every patient with its anonymous id. Touches
    are summarised per pair of ids first, so what is joined and shuffled is one row per pair, and
    summaries of a patient are merged afterwards.
    """
    ids = touchpoints.withColumn("_named", F.col("patient_id"))
    per_pair = touch_summary(
        ids, ["_named", "anonymous_id"], "event_at", "touchpoint_id", "cost", ["channel", "campaign"]
    )
    bridge = patients.select(F.col("patient_id").alias("_bridged"), "anonymous_id")
    resolved = (
        per_pair.join(bridge, "anonymous_id", "left")
        .withColumn("patient_id", F.coalesce("_named", "_bridged"))
        .filter("patient_id IS NOT NULL")
    )
    return merge_summaries(resolved, ["patient_id"]).select(
        "patient_id",
        F.col("touches").alias("touch_count"),
        F.round("cost", 2).cast("double").alias("total_marketing_cost"),
        F.col("first.at").alias("first_touch_at"),
        F.col("last.at").alias("last_touch_at"),
        F.col("first.what.channel").alias("first_touch_channel"),
        F.col("first.what.campaign").alias("first_touch_campaign"),
        F.col("last.what.channel").alias("last_touch_channel"),
        F.col("last.what.campaign").alias("last_touch_campaign"),
    )


def dim_patients(patients: DataFrame, attributed: DataFrame) -> DataFrame:
    """Patient dimension without e-mail, names or birth date."""
    touched = attributed.select(
        "patient_id", "touch_count", "total_marketing_cost", "first_touch_channel", "last_touch_channel"
    )
    return patients.join(touched, "patient_id", "left").select(
        "patient_id",
        "state",
        "gender",
        member_age_band(F.col("age")).alias("age_band"),
        day("signed_up_at").alias("signup_date"),
        month_start(F.col("signed_up_at")).alias("signup_cohort_month"),
        "signup_channel",
        "first_touch_channel",
        "last_touch_channel",
        F.coalesce("touch_count", F.lit(0)).cast("bigint").alias("marketing_touch_count"),
        F.coalesce("total_marketing_cost", F.lit(0.0)).alias("acquisition_cost"),
    )


def dim_providers(providers: DataFrame) -> DataFrame:
    return providers.select("provider_id", "provider_name", "specialty", day("created_at").alias("onboarded_date"))


def mart_marketing_attribution(attributed: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Signups, subscribers, spend and acquisition cost by first-touch channel and campaign.

    A patient with several subscriptions counts, and costs, once for each of them. They are
    counted per patient before the join, so it never multiplies rows.
    """
    paying = F.when(F.col("is_active"), F.coalesce("mrr_amount", F.lit(0)))
    held = (
        subscriptions.filter("patient_id IS NOT NULL")
        .groupBy("patient_id")
        .agg(
            F.count(F.lit(1)).alias("subs"),
            F.count_if(F.col("is_active")).alias("active"),
            F.sum(paying).alias("active_mrr"),
        )
    )
    times = F.greatest(F.coalesce("subs", F.lit(0)), F.lit(1))
    totals = (
        attributed.filter("first_touch_channel IS NOT NULL")
        .join(held, "patient_id", "left")
        .groupBy(F.col("first_touch_channel").alias("channel"), F.col("first_touch_campaign").alias("campaign"))
        .agg(
            F.sum(times).cast("bigint").alias("signups"),
            F.coalesce(F.sum("subs"), F.lit(0)).cast("bigint").alias("subscribers"),
            F.coalesce(F.sum("active"), F.lit(0)).cast("bigint").alias("active_subscribers"),
            F.sum(F.col("total_marketing_cost").cast("decimal(18,2)") * times).alias("spend"),
            F.sum("active_mrr").cast("bigint").alias("active_mrr"),
        )
    )
    spend = F.col("spend")
    return totals.select(
        "channel",
        "campaign",
        "signups",
        "subscribers",
        "active_subscribers",
        F.round(spend, 2).cast("double").alias("total_spend"),
        exact_ratio(spend, F.col("signups"), 2).alias("cac_per_signup"),
        exact_ratio(spend, F.col("subscribers"), 2).alias("cac_per_subscriber"),
        "active_mrr",
    ).orderBy(F.desc("signups"), "channel", "campaign")
