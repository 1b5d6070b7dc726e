"""The declared checks as the expected results take them: table, name, kind, columns, severity and details.

Written out here, so that a declaration that is lost or altered in the library shows as a difference."""

from __future__ import annotations

from typing import NamedTuple


class Expected(NamedTuple):
    table: str
    label: str
    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    accepted: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    expression: str = ""
    where: str = "TRUE"


# The checks every table must meet.
RAW = (
    Expected("raw.patients", "unique(patient_id)", "unique", ("patient_id",)),
    Expected("raw.patients", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("raw.providers", "unique(provider_id)", "unique", ("provider_id",)),
    Expected("raw.providers", "not_null(provider_id)", "not_null", ("provider_id",)),
    Expected("raw.appointments", "unique(appointment_id)", "unique", ("appointment_id",)),
    Expected("raw.appointments", "not_null(appointment_id)", "not_null", ("appointment_id",)),
    Expected("raw.appointments", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("raw.appointments", "relationship(patient_id)", "relationship", ("patient_id",), parent="raw.patients",
             parent_column="patient_id"),
    Expected("raw.subscriptions", "unique(subscription_id)", "unique", ("subscription_id",)),
    Expected("raw.subscriptions", "not_null(subscription_id)", "not_null", ("subscription_id",)),
    Expected("raw.subscriptions", "relationship(patient_id)", "relationship", ("patient_id",), parent="raw.patients",
             parent_column="patient_id"),
    Expected("raw.subscription_events", "unique(event_id)", "unique", ("event_id",)),
    Expected("raw.subscription_events", "not_null(event_id)", "not_null", ("event_id",)),
    Expected("raw.marketing_touchpoints", "unique(touchpoint_id)", "unique", ("touchpoint_id",)),
    Expected("raw.marketing_touchpoints", "not_null(touchpoint_id)", "not_null", ("touchpoint_id",)),
    Expected("raw.synthea_patients", "unique(Id)", "unique", ("Id",)),
    Expected("raw.synthea_patients", "not_null(Id)", "not_null", ("Id",)),
    Expected("raw.synthea_encounters", "unique(Id)", "unique", ("Id",)),
    Expected("raw.synthea_encounters", "not_null(Id)", "not_null", ("Id",)),
    Expected("raw.synthea_encounters", "not_null(PATIENT)", "not_null", ("PATIENT",)),
    Expected("raw.synthea_encounters", "relationship(PATIENT)", "relationship", ("PATIENT",),
             parent="raw.synthea_patients", parent_column="Id"),
    Expected("raw.synthea_payer_transitions", "not_null(PATIENT)", "not_null", ("PATIENT",)),
    Expected("raw.synthea_payer_transitions", "relationship(PATIENT)", "relationship", ("PATIENT",),
             parent="raw.synthea_patients", parent_column="Id"),
)


# The checks every table must meet.
MODELS = (
    Expected("stg_patients", "unique(patient_id)", "unique", ("patient_id",)),
    Expected("stg_patients", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("stg_providers", "unique(provider_id)", "unique", ("provider_id",)),
    Expected("stg_providers", "not_null(provider_id)", "not_null", ("provider_id",)),
    Expected("stg_appointments", "unique(appointment_id)", "unique", ("appointment_id",)),
    Expected("stg_appointments", "not_null(appointment_id)", "not_null", ("appointment_id",)),
    Expected("stg_appointments", "accepted_values(status)", "accepted_values", ("status",), accepted=("completed",
             "no_show", "cancelled", "scheduled")),
    Expected("stg_appointments", "accepted_values(appointment_type)", "accepted_values", ("appointment_type",),
             accepted=("video", "phone", "message")),
    Expected("stg_appointments", "relationship(patient_id)", "relationship", ("patient_id",), parent="stg_patients",
             parent_column="patient_id"),
    Expected("stg_subscriptions", "unique(subscription_id)", "unique", ("subscription_id",)),
    Expected("stg_subscriptions", "not_null(subscription_id)", "not_null", ("subscription_id",)),
    Expected("stg_subscriptions", "accepted_values(status)", "accepted_values", ("status",), accepted=("active",
             "cancelled", "paused")),
    Expected("stg_subscriptions", "not_null(mrr_amount)", "not_null", ("mrr_amount",)),
    Expected("stg_subscription_events", "unique(event_id)", "unique", ("event_id",)),
    Expected("stg_subscription_events", "not_null(event_id)", "not_null", ("event_id",)),
    Expected("stg_subscription_events", "accepted_values(event_type)", "accepted_values", ("event_type",),
             accepted=("created", "activated", "plan_changed", "cancelled", "reactivated")),
    Expected("stg_marketing_touchpoints", "unique(touchpoint_id)", "unique", ("touchpoint_id",)),
    Expected("stg_marketing_touchpoints", "not_null(touchpoint_id)", "not_null", ("touchpoint_id",)),
    Expected("stg_ehr__patients", "unique(patient_id)", "unique", ("patient_id",)),
    Expected("stg_ehr__patients", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("stg_ehr__patients", "expression(length(zip3) = 3)", "expression", (), expression="length(zip3) = 3"),
    Expected("stg_ehr__patients", "not_null(age_band)", "not_null", ("age_band",)),
    Expected("stg_ehr__patients", "accepted_values(age_band)", "accepted_values", ("age_band",), accepted=("0-17",
             "18-34", "35-49", "50-64", "65-74", "75-89", "90+")),
    Expected("stg_ehr__encounters", "unique(encounter_id)", "unique", ("encounter_id",)),
    Expected("stg_ehr__encounters", "not_null(encounter_id)", "not_null", ("encounter_id",)),
    Expected("stg_ehr__encounters", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("stg_ehr__encounters", "relationship(patient_id)", "relationship", ("patient_id",),
             parent="stg_ehr__patients", parent_column="patient_id"),
    Expected("stg_ehr__encounters", "expression(duration_minutes >= 0)", "expression", (),
             expression="duration_minutes >= 0"),
    Expected("stg_ehr__encounters", "not_null(encounter_class)", "not_null", ("encounter_class",)),
    Expected("stg_ehr__payer_transitions", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("stg_ehr__payer_transitions", "not_null(valid_from)", "not_null", ("valid_from",)),
    Expected("stg_ehr__payer_transitions", "expression(NOT is_invalid_interval)", "expression", (), severity="warn",
             expression="NOT is_invalid_interval"),
    Expected("int_ehr__payer_periods_folded", "unique(payer_period_key)", "unique", ("payer_period_key",)),
    Expected("int_ehr__payer_periods_folded", "not_null(payer_period_key)", "not_null", ("payer_period_key",)),
    Expected("int_ehr__payer_periods_folded", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("int_ehr__payer_periods_folded", "unique_combination(patient_id, valid_from)", "unique_combination",
             ("patient_id", "valid_from")),
    Expected("int_ehr__payer_periods_folded", "relationship(patient_id)", "relationship", ("patient_id",),
             parent="stg_ehr__patients", parent_column="patient_id"),
    Expected("int_ehr__payer_periods_folded", "expression(source_row_count >= 1)", "expression", (),
             expression="source_row_count >= 1"),
    Expected("int_ehr__payer_periods_folded", "expression(coverage_days >= 0)", "expression", (),
             expression="coverage_days >= 0", where="valid_to IS NOT NULL"),
    Expected("mart_clinical_encounters", "unique(encounter_id)", "unique", ("encounter_id",)),
    Expected("mart_clinical_encounters", "not_null(encounter_id)", "not_null", ("encounter_id",)),
    Expected("mart_clinical_encounters", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("mart_clinical_encounters", "not_null(age_band)", "not_null", ("age_band",)),
    Expected("dim_patients", "unique(patient_id)", "unique", ("patient_id",)),
    Expected("dim_patients", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("dim_patients", "accepted_values(age_band)", "accepted_values", ("age_band",), accepted=("18-24", "25-34",
             "35-44", "45-54", "55-64", "65+")),
    Expected("dim_providers", "unique(provider_id)", "unique", ("provider_id",)),
    Expected("dim_providers", "not_null(provider_id)", "not_null", ("provider_id",)),
    Expected("fct_appointments", "unique(appointment_id)", "unique", ("appointment_id",)),
    Expected("fct_appointments", "not_null(appointment_id)", "not_null", ("appointment_id",)),
    Expected("fct_appointments", "not_null(patient_id)", "not_null", ("patient_id",)),
    Expected("fct_appointments", "relationship(patient_id)", "relationship", ("patient_id",), parent="dim_patients",
             parent_column="patient_id"),
    Expected("fct_appointments", "accepted_values(status)", "accepted_values", ("status",), accepted=("completed",
             "no_show", "cancelled", "scheduled")),
    Expected("fct_mrr_daily", "unique(calendar_date)", "unique", ("calendar_date",)),
    Expected("fct_mrr_daily", "not_null(calendar_date)", "not_null", ("calendar_date",)),
    Expected("fct_mrr_daily", "not_null(mrr)", "not_null", ("mrr",)),
    Expected("fct_subscriptions", "unique(subscription_id)", "unique", ("subscription_id",)),
    Expected("fct_subscriptions", "not_null(subscription_id)", "not_null", ("subscription_id",)),
    Expected("fct_subscriptions", "relationship(patient_id)", "relationship", ("patient_id",), parent="dim_patients",
             parent_column="patient_id"),
    Expected("fct_subscriptions", "accepted_values(plan_id)", "accepted_values", ("plan_id",), accepted=("basic",
             "plus", "premium")),
    Expected("fct_subscriptions", "accepted_values(status)", "accepted_values", ("status",), accepted=("active",
             "cancelled", "paused")),
    Expected("mart_marketing_attribution", "not_null(signups)", "not_null", ("signups",)),
    Expected("dim_subscription_history", "not_null(subscription_id)", "not_null", ("subscription_id",)),
    Expected("dim_subscription_history", "relationship(subscription_id)", "relationship", ("subscription_id",),
             parent="stg_subscriptions", parent_column="subscription_id"),
    Expected("dim_subscription_history", "relationship(patient_id)", "relationship", ("patient_id",),
             parent="dim_patients", parent_column="patient_id"),
    Expected("dim_subscription_history", "accepted_values(plan_id)", "accepted_values", ("plan_id",),
             accepted=("basic", "plus", "premium")),
    Expected("dim_subscription_history", "not_null(valid_from)", "not_null", ("valid_from",)),
    Expected("dim_subscription_history", "not_null(is_current)", "not_null", ("is_current",)),
    Expected("dim_subscription_history", "unique_combination(subscription_id, valid_from)", "unique_combination",
             ("subscription_id", "valid_from")),
)
