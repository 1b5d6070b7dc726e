"""Insurance coverage periods and the encounter fact."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremill.operators.fold import fold_intervals
from caremill.operators.intervals import join_covering
from caremill.operators.skew import HotKeys
from caremill.plans.staging import visit_columns

# Fixed value: days without cover that do not yet end a period.
GAP_DAYS = 0


def payer_periods(transitions: DataFrame, gap_days: int = GAP_DAYS, hot: HotKeys | None = None) -> DataFrame:
    """Unbroken stretches of cover by one payer, from the yearly rows; inverted ones are left out."""
    usable = transitions.filter("valid_from IS NOT NULL AND NOT is_invalid_interval")
    folded = fold_intervals(
        usable, "patient_id", "payer_id", "member_id", "valid_from", "valid_to", gap_days, hot
    )
    return folded.select(
        F.col("period_key").alias("payer_period_key"),
        "patient_id",
        F.col("period_seq").alias("payer_period_seq"),
        "payer_id",
        "first_member_id",
        "last_member_id",
        F.col("distinct_member_ids"),
        (F.col("distinct_member_ids") > 1).alias("member_id_was_reissued"),
        "valid_from",
        "valid_to",
        F.col("days").alias("coverage_days"),
        "source_row_count",
        F.col("is_latest").alias("is_current_period"),
    )


def mart_clinical_encounters(
    encounters: DataFrame, patients: DataFrame, periods: DataFrame, as_of: date, years: int = 30
) -> DataFrame:
    """Visits with de-identified patient attributes and the payer in force on the day.

    Cover comes from folded periods: yearly rows would match many times. The lifetime amounts of
    a patient stay out, as they do not add up over visits. Most visits are expected in the
    ``years`` before ``as_of``; others are matched as well.
    """
    people = patients.select(
        "patient_id", "age_band", "gender", "race", "ethnicity", "marital_status", "state", "zip3"
    )
    cover = periods.select(
        "patient_id", F.col("payer_id").alias("coverage_payer_id"), "payer_period_key", "valid_from", "valid_to"
    )
    # Only what visits cannot do without is dealt out by patient, once for both joins and at any size; the rest follows
    # behind. The hint bounds nothing but the patients of one partition.
    derived = visit_columns()
    visits = encounters.drop(*derived).join(people.hint("shuffle_hash"), "patient_id", "left").withColumns(derived)
    covered = join_covering(
        visits,
        cover,
        "patient_id",
        "encounter_date",
        "valid_from",
        "valid_to",
        since=as_of - timedelta(days=366 * years),
        until=as_of,
    )
    return covered.select(
        "encounter_id",
        "patient_id",
        "encounter_date",
        "started_at",
        "stopped_at",
        "duration_minutes",
        "encounter_class",
        "is_virtual",
        "encounter_code",
        "encounter_description",
        "reason_code",
        "reason_description",
        "age_band",
        "gender",
        "race",
        "ethnicity",
        "marital_status",
        "state",
        "zip3",
        "encounter_payer_id",
        "coverage_payer_id",
        "payer_period_key",
        (~F.col("encounter_payer_id").eqNullSafe(F.col("coverage_payer_id"))).alias("has_payer_mismatch"),
        F.col("payer_period_key").isNull().alias("has_no_coverage_period"),
        "base_encounter_cost",
        "total_claim_cost",
        "payer_coverage",
        "patient_responsibility",
    )
