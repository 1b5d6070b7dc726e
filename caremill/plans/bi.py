"""Dashboard answers over the serving tables. Each takes the tables it reads and sorts its result,
which is small, for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremill.functions.dates import month_start
from caremill.functions.values import share

ALL_CHANNELS = "%"


def _rows() -> Column:
    return F.count(F.lit(1))


def _held(appointments: DataFrame) -> DataFrame:
    """Appointments whose slot has passed; a missing status drops out as well."""
    return appointments.filter(F.col("status") != "scheduled")


# -- executive ------------------------------------------------------------------------------


def overview(dim_patients: DataFrame, mrr_daily: DataFrame, appointments: DataFrame, marketing: DataFrame) -> DataFrame:
    """One row of headline numbers, each a scalar subquery over its own table."""
    latest = mrr_daily.agg(F.max_by(F.struct("active_subscriptions", "mrr", "arr"), "calendar_date")).scalar()
    spend = F.sum(F.col("total_spend").cast("decimal(18,2)"))
    return dim_patients.agg(_rows().alias("total_patients")).select(
        "total_patients",
        latest["active_subscriptions"].alias("active_subs"),
        latest["mrr"].alias("mrr"),
        latest["arr"].alias("arr"),
        _held(appointments).agg(share(F.count_if("is_no_show"), _rows())).scalar().alias("no_show_rate"),
        marketing.agg(share(spend, F.sum("signups"))).scalar().alias("blended_cac"),
    )


def mrr_trend(mrr_daily: DataFrame) -> DataFrame:
    return mrr_daily.select("calendar_date", "mrr", "arr", "active_subscriptions", "arpu").orderBy("calendar_date")


def mrr_headline_trend(mrr_daily: DataFrame) -> DataFrame:
    return mrr_daily.select("calendar_date", "mrr", "active_subscriptions").orderBy("calendar_date")


# -- subscriptions --------------------------------------------------------------------------


def subscription_stats(subscriptions: DataFrame) -> DataFrame:
    active, churned = F.col("status") == "active", F.col("status") == "cancelled"
    return subscriptions.agg(
        F.count_if(active).alias("active_subs"),
        F.count_if(churned).alias("churned_subs"),
        share(F.count_if(churned), _rows()).alias("churn_rate"),
        F.sum(F.when(active, F.col("mrr_amount"))).alias("active_mrr"),
    )


def active_plan_mix(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.filter(F.col("status") == "active")
        .groupBy("plan_id")
        .agg(_rows().alias("subscriptions"), F.sum("mrr_amount").alias("mrr"))
        .orderBy(F.desc("mrr"), "plan_id")
    )


# -- appointments ---------------------------------------------------------------------------


def appointment_kpis(appointments: DataFrame) -> DataFrame:
    return _held(appointments).agg(
        _rows().alias("total_appointments"),
        share(F.count_if("is_no_show"), _rows()).alias("no_show_rate"),
        share(F.count_if("is_completed"), _rows()).alias("completion_rate"),
        share(F.sum("lead_time_days"), F.count("lead_time_days")).alias("avg_lead_time_days"),
    )


def appointments_by_week(appointments: DataFrame) -> DataFrame:
    return (
        _held(appointments)
        .groupBy("appointment_week")
        .agg(_rows().alias("appointments"), F.count_if("is_no_show").alias("no_shows"))
        .orderBy("appointment_week")
    )


def no_show_by_specialty(appointments: DataFrame) -> DataFrame:
    return (
        _held(appointments)
        .filter("provider_specialty IS NOT NULL")
        .groupBy("provider_specialty")
        .agg(_rows().alias("appointments"), share(F.count_if("is_no_show"), _rows()).alias("no_show_rate"))
        .orderBy(F.desc("no_show_rate"), "provider_specialty")
    )


def appointments_by_type(appointments: DataFrame) -> DataFrame:
    return (
        _held(appointments)
        .groupBy("appointment_month", "appointment_type")
        .agg(_rows().alias("appointments"))
        .orderBy("appointment_month", "appointment_type")
    )


# -- marketing ------------------------------------------------------------------------------


def _spend() -> Column:
    return F.sum(F.col("total_spend").cast("decimal(18,2)"))


def channels(marketing: DataFrame) -> DataFrame:
    return marketing.select("channel").distinct().orderBy("channel")


def marketing_kpis(marketing: DataFrame, channel: str = ALL_CHANNELS) -> DataFrame:
    """Totals over the channels that match a LIKE pattern."""
    return marketing.filter(F.col("channel").like(channel)).agg(
        F.sum("signups").alias("signups"),
        F.sum("subscribers").alias("subscribers"),
        _spend().cast("double").alias("total_spend"),
        share(_spend(), F.sum("signups")).alias("blended_cac"),
        F.sum("active_mrr").alias("active_mrr"),
    )


def marketing_by_channel(marketing: DataFrame, channel: str = ALL_CHANNELS) -> DataFrame:
    return (
        marketing.filter(F.col("channel").like(channel))
        .groupBy("channel")
        .agg(
            F.sum("signups").alias("signups"),
            F.sum("subscribers").alias("subscribers"),
            _spend().cast("double").alias("spend"),
            share(_spend(), F.sum("signups")).alias("cac_per_signup"),
            F.sum("active_mrr").alias("active_mrr"),
        )
        .orderBy(F.desc("signups"), "channel")
    )


def marketing_detail(marketing: DataFrame, channel: str = ALL_CHANNELS) -> DataFrame:
    return marketing.filter(F.col("channel").like(channel)).orderBy(F.desc("signups"), "channel", "campaign")


# -- encounters -----------------------------------------------------------------------------


def encounter_kpis(encounters: DataFrame) -> DataFrame:
    minutes = F.sum("duration_minutes"), F.count("duration_minutes")
    return encounters.agg(
        F.count("encounter_id").alias("total_encounters"),
        F.count_distinct("patient_id").alias("unique_patients"),
        F.round(F.sum("total_claim_cost"), 0).cast("double").alias("total_costs"),
        F.round(minutes[0].cast("decimal(20,0)") / F.nullif(minutes[1].cast("decimal(20,0)"), F.lit(0)), 1)
        .cast("double")
        .alias("avg_duration_minutes"),
    )


def encounters_by_month(encounters: DataFrame) -> DataFrame:
    month = F.trunc("encounter_date", "month").alias("encounter_month")
    return encounters.groupBy(month).agg(F.count("encounter_id").alias("encounters")).orderBy("encounter_month")


def cost_by_class(encounters: DataFrame) -> DataFrame:
    costs = F.sum("total_claim_cost")
    average = costs / F.nullif(F.count("total_claim_cost").cast("decimal(18,0)"), F.lit(0))
    return (
        encounters.groupBy("encounter_class")
        .agg(
            _rows().alias("encounters"),
            F.round(costs, 0).cast("double").alias("total_cost"),
            F.round(average, 0).cast("double").alias("avg_cost"),
        )
        .orderBy(F.desc("total_cost"), "encounter_class")
    )


def encounters_by_demographics(encounters: DataFrame) -> DataFrame:
    return (
        encounters.filter("age_band IS NOT NULL")
        .groupBy("age_band", "gender")
        .agg(F.count("encounter_id").alias("encounters"))
        .orderBy("age_band", "gender")
    )


# -- plan history ---------------------------------------------------------------------------


def history_headline(history: DataFrame) -> DataFrame:
    """How many subscriptions ever changed plan. Counted per subscription first, so one pass
    answers all distinct counts."""
    later = F.col("version") > 1
    per_subscription = history.groupBy("subscription_id").agg(F.count_if(later).alias("changes"))
    known = F.col("subscription_id").isNotNull()
    changed = F.count_if(known & (F.col("changes") > 0))
    return per_subscription.agg(
        F.count_if(known).alias("subscriptions"),
        changed.alias("subs_changed"),
        F.sum("changes").alias("plan_changes"),
        share(changed, F.count_if(known)).alias("pct_changed"),
    )


def plan_directions(transitions: DataFrame) -> DataFrame:
    def total(direction: str) -> Column:
        return F.sum(F.when(F.col("direction") == direction, F.col("changes")))

    return transitions.agg(total("upgrade").alias("upgrades"), total("downgrade").alias("downgrades"))


def mrr_comparison(mix: DataFrame, mrr_daily: DataFrame) -> DataFrame:
    """Revenue at the plans of the day next to revenue at current plans."""
    current = mrr_daily.groupBy("calendar_date").agg(F.max("mrr").alias("mrr_current_plan"))
    return (
        mix.groupBy("calendar_date")
        .agg(F.sum("mrr").alias("mrr_point_in_time"))
        .join(current, "calendar_date")
        .orderBy("calendar_date")
    )


def mrr_gap(mix: DataFrame, mrr_daily: DataFrame) -> DataFrame:
    gap = F.abs(F.col("mrr_current_plan") - F.col("mrr_point_in_time"))
    return mrr_comparison(mix, mrr_daily).agg(
        F.max(gap).alias("max_gap"),
        F.max(share(gap, F.col("mrr_point_in_time"))).alias("max_gap_pct"),
    )


def busiest_timelines(history: DataFrame, top: int = 4) -> DataFrame:
    """All versions of the subscriptions with the most versions; ties go to the lower id."""
    busiest = (
        history.groupBy("subscription_id")
        .agg(_rows().alias("versions"))
        .orderBy(F.desc("versions"), "subscription_id")
        .limit(top)
    )
    # ``top`` rows at most.
    return (
        history.join(F.broadcast(busiest), "subscription_id", "left_semi")
        .select("subscription_id", "version", "plan_id", "mrr_amount", "valid_from", "valid_to", "is_current")
        .orderBy("subscription_id", "version")
    )
