"""Raw tables to typed, normalised ones: one output row per raw row, no shuffles.

Raw care tables are all text; an empty text means no value. Each care table keeps its load stamp.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremill.functions.dates import day, minutes_between, timestamp, years_between
from caremill.functions.privacy import clinical_age_band, zip3
from caremill.functions.values import blank_to_null

MONEY = "decimal(18,2)"


def _lower(*names: str) -> list[Column]:
    return [F.lower(name).alias(name) for name in names]


def _times(*names: str) -> list[Column]:
    return [timestamp(name).alias(name) for name in names]


def patients(raw: DataFrame, as_of: date) -> DataFrame:
    """The only table with direct identifiers; nothing downstream may select them."""
    email = F.lower("email")
    return raw.select(
        "patient_id",
        "anonymous_id",
        email.alias("email"),
        "first_name",
        "last_name",
        day("date_of_birth").alias("date_of_birth"),
        F.split_part(email, F.lit("@"), F.lit(2)).alias("email_domain"),
        years_between(day("date_of_birth"), F.lit(as_of)).alias("age"),
        *_lower("gender"),
        F.upper("state").alias("state"),
        *_lower("signup_channel"),
        timestamp("created_at").alias("signed_up_at"),
        *_times("updated_at", "_loaded_at"),
    )


def providers(raw: DataFrame) -> DataFrame:
    return raw.select("provider_id", "provider_name", "specialty", *_times("created_at", "_loaded_at"))


def state_columns() -> dict[str, Column]:
    """Whether an appointment is in each final state, from its status."""
    return {f"is_{state}": F.col("status") == state for state in ("completed", "no_show", "cancelled")}


def appointment_states() -> list[Column]:
    return [column.alias(name) for name, column in state_columns().items()]


def appointments(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        "appointment_id",
        "patient_id",
        "provider_id",
        *_lower("appointment_type", "status"),
        *_times("scheduled_at", "created_at", "updated_at", "_loaded_at"),
    )
    return typed.select(*[c for c in typed.columns if c != "_loaded_at"], *appointment_states(), "_loaded_at")


def subscriptions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "subscription_id",
        "patient_id",
        *_lower("plan_id"),
        F.col("mrr_amount").cast("int").alias("mrr_amount"),
        *_lower("status"),
        day("started_at").alias("started_at"),
        blank_to_null("cancelled_at").try_cast("date").alias("cancelled_at"),
        *_times("created_at", "updated_at", "_loaded_at"),
    )


def subscription_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "subscription_id",
        *_lower("event_type"),
        blank_to_null("from_plan").alias("from_plan"),
        blank_to_null("to_plan").alias("to_plan"),
        F.col("mrr_delta").cast("int").alias("mrr_delta"),
        *_times("event_at", "_loaded_at"),
    )


def touchpoints(raw: DataFrame) -> DataFrame:
    return raw.select(
        "touchpoint_id",
        "anonymous_id",
        blank_to_null("patient_id").alias("patient_id"),
        *_lower("channel", "utm_medium", "campaign", "event_type"),
        F.col("cost").cast("double").alias("cost"),
        *_times("event_at", "_loaded_at"),
    )


def visit_columns() -> dict[str, Column]:
    """What follows from the other columns of a staged visit."""
    return {
        "encounter_date": day(F.col("started_at")),
        "duration_minutes": minutes_between(F.col("started_at"), F.col("stopped_at")),
        "is_virtual": F.col("encounter_class") == "virtual",
        "patient_responsibility": F.col("total_claim_cost") - F.col("payer_coverage"),
    }


def encounters(raw: DataFrame) -> DataFrame:
    """Completed visits. Costs are claim economics, unrelated to subscription revenue."""
    typed = raw.select(
        F.col("Id").alias("encounter_id"),
        F.col("PATIENT").alias("patient_id"),
        F.col("ORGANIZATION").alias("organization_id"),
        F.col("PROVIDER").alias("provider_id"),
        F.col("PAYER").alias("encounter_payer_id"),
        timestamp("START").alias("started_at"),
        timestamp("STOP").alias("stopped_at"),
        F.lower("ENCOUNTERCLASS").alias("encounter_class"),
        F.col("CODE").alias("encounter_code"),
        F.col("DESCRIPTION").alias("encounter_description"),
        F.col("REASONCODE").alias("reason_code"),
        F.col("REASONDESCRIPTION").alias("reason_description"),
        F.col("BASE_ENCOUNTER_COST").cast(MONEY).alias("base_encounter_cost"),
        F.col("TOTAL_CLAIM_COST").cast(MONEY).alias("total_claim_cost"),
        F.col("PAYER_COVERAGE").cast(MONEY).alias("payer_coverage"),
    )
    return typed.withColumns(visit_columns()).select(
        "encounter_id",
        "patient_id",
        "organization_id",
        "provider_id",
        "encounter_payer_id",
        "started_at",
        "stopped_at",
        "encounter_date",
        "duration_minutes",
        "encounter_class",
        "is_virtual",
        "encounter_code",
        "encounter_description",
        "reason_code",
        "reason_description",
        "base_encounter_cost",
        "total_claim_cost",
        "payer_coverage",
        "patient_responsibility",
    )


def clinical_patients(raw: DataFrame, as_of: date) -> DataFrame:
    """De-identified: years instead of dates, age bands, three-digit postal areas.

    Age is taken at death or at a fixed ``as_of``, never at the wall clock. The lifetime amounts
    belong to the patient only and must not be joined onto visits and summed.
    """
    born, died = day("BIRTHDATE"), day("DEATHDATE")
    age = years_between(born, F.coalesce(died, F.lit(as_of)))
    return raw.select(
        F.col("Id").alias("patient_id"),
        F.year(born).cast("bigint").alias("birth_year"),
        F.year(died).cast("bigint").alias("death_year"),
        died.isNotNull().alias("is_deceased"),
        clinical_age_band(age).alias("age_band"),
        zip3(F.col("ZIP")).alias("zip3"),
        F.col("STATE").alias("state"),
        F.col("MARITAL").alias("marital_status"),
        F.col("RACE").alias("race"),
        F.col("ETHNICITY").alias("ethnicity"),
        F.col("GENDER").alias("gender"),
        F.col("HEALTHCARE_EXPENSES").cast(MONEY).alias("lifetime_healthcare_expenses"),
        F.col("HEALTHCARE_COVERAGE").cast(MONEY).alias("lifetime_healthcare_coverage"),
        F.col("INCOME").cast(MONEY).alias("annual_income"),
    )


def payer_transitions(raw: DataFrame) -> DataFrame:
    """One row per patient and insurance year; inverted intervals are marked, not removed."""
    starts, ends = day("START_DATE"), day("END_DATE")
    return raw.select(
        F.col("PATIENT").alias("patient_id"),
        F.col("PAYER").alias("payer_id"),
        F.col("SECONDARY_PAYER").alias("secondary_payer_id"),
        F.col("MEMBERID").alias("member_id"),
        F.col("PLAN_OWNERSHIP").alias("plan_ownership"),
        starts.alias("valid_from"),
        ends.alias("valid_to"),
        # FALSE for an open end, NULL for a closed interval without a start.
        F.when(ends.isNull(), F.lit(False)).otherwise(ends < starts).alias("is_invalid_interval"),
    )
