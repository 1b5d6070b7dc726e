"""All models wired together over one set of raw tables.

Each property is a DataFrame that nothing has computed yet, so a query over one of them is planned
as a whole: only the columns it needs are read. ``publish`` writes tables layer by layer, each read back by the next;
dashboards read serving tables from where ``served`` has written them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from caremill.operators.skew import HotKeys, find_hot_keys
from caremill.plans import care, clinical, staging
from caremill.session import released, scratch_path
from caremill.sources.bindings import EVENTS_AS_OF, ORDERS_AS_OF, REVENUE_START, RawTables

# Schema of each layer's tables.
SCHEMAS = {
    "raw": "raw",
    "staging": "staging",
    "intermediate": "intermediate",
    "marts": "marts",
    "clinical_internal": "ehr_internal",
    "clinical_marts": "ehr_marts",
}

# Schema and table of each model that is written, every one after those it is built on. The tables of visits come
# first: what a step shuffles is on disk beside all that is written before it.
TABLES = {
    "clinical_patients": (SCHEMAS["clinical_internal"], "stg_ehr__patients"),
    "encounters": (SCHEMAS["clinical_internal"], "stg_ehr__encounters"),
    "payer_transitions": (SCHEMAS["clinical_internal"], "stg_ehr__payer_transitions"),
    "payer_periods": (SCHEMAS["clinical_internal"], "int_ehr__payer_periods_folded"),
    "clinical_encounters": (SCHEMAS["clinical_marts"], "mart_clinical_encounters"),
    "patients": (SCHEMAS["staging"], "stg_patients"),
    "providers": (SCHEMAS["staging"], "stg_providers"),
    "appointments": (SCHEMAS["staging"], "stg_appointments"),
    "fct_appointments": (SCHEMAS["marts"], "fct_appointments"),
    "subscriptions": (SCHEMAS["staging"], "stg_subscriptions"),
    "subscription_events": (SCHEMAS["staging"], "stg_subscription_events"),
    "touchpoints": (SCHEMAS["staging"], "stg_marketing_touchpoints"),
    "dim_patients": (SCHEMAS["marts"], "dim_patients"),
    "dim_providers": (SCHEMAS["marts"], "dim_providers"),
    "subscription_history": (SCHEMAS["marts"], "dim_subscription_history"),
    "fct_mrr_daily": (SCHEMAS["marts"], "fct_mrr_daily"),
    "fct_subscriptions": (SCHEMAS["marts"], "fct_subscriptions"),
    "marketing": (SCHEMAS["marts"], "mart_marketing_attribution"),
}

# Tables with a row for each visit are written in order of its id, by a writer that stores differences from the row
# before. Neighbouring ids share most of what they say, so files get smaller, and so do later shuffles of them. Others stay as
# they are: joins judge by the size of a file whether to broadcast it.
SORTED = {
    "appointments": "appointment_id",
    "encounters": "encounter_id",
    "fct_appointments": "appointment_id",
    "clinical_encounters": "encounter_id",
}


class Models:
    def __init__(
        self,
        raw: RawTables,
        as_of: date = ORDERS_AS_OF,
        members_as_of: date = EVENTS_AS_OF,
        revenue_start: date = REVENUE_START,
        gap_days: int = clinical.GAP_DAYS,
    ) -> None:
        self.raw, self.as_of, self.members_as_of = raw, as_of, members_as_of
        self.revenue_start, self.gap_days = revenue_start, gap_days

    # -- staging ------------------------------------------------------------------------

    @cached_property
    def patients(self) -> DataFrame:
        return staging.patients(self.raw.patients(), self.members_as_of)

    @cached_property
    def providers(self) -> DataFrame:
        return staging.providers(self.raw.providers())

    @cached_property
    def appointments(self) -> DataFrame:
        return staging.appointments(self.raw.appointments())

    @cached_property
    def subscriptions(self) -> DataFrame:
        return staging.subscriptions(self.raw.subscriptions())

    @cached_property
    def subscription_events(self) -> DataFrame:
        return staging.subscription_events(self.raw.subscription_events())

    @cached_property
    def touchpoints(self) -> DataFrame:
        return staging.touchpoints(self.raw.marketing_touchpoints())

    @cached_property
    def encounters(self) -> DataFrame:
        return staging.encounters(self.raw.encounters())

    @cached_property
    def clinical_patients(self) -> DataFrame:
        return staging.clinical_patients(self.raw.clinical_patients(), self.as_of)

    @cached_property
    def payer_transitions(self) -> DataFrame:
        return staging.payer_transitions(self.raw.payer_transitions(self.hot_patients))

    # -- keys too big for one task, found once ------------------------------------------

    @cached_property
    def hot_patients(self) -> HotKeys:
        return self.raw.hot_patients()

    @cached_property
    def hot_subscriptions(self) -> HotKeys:
        return find_hot_keys(self.subscription_events, ["subscription_id"])

    # -- intermediate -------------------------------------------------------------------

    @cached_property
    def appointments_enriched(self) -> DataFrame:
        return care.appointments_enriched(self.appointments, self.providers, self.patients)

    @cached_property
    def subscriptions_enriched(self) -> DataFrame:
        return care.subscriptions_enriched(self.subscriptions, self.subscription_events, self.as_of)

    @cached_property
    def attribution(self) -> DataFrame:
        return care.attribution(self.touchpoints, self.patients)

    @cached_property
    def plan_periods(self) -> DataFrame:
        """The history without patients, for what does not need them."""
        return care.plan_periods(self.subscription_events, self.hot_subscriptions)

    @cached_property
    def payer_periods(self) -> DataFrame:
        return clinical.payer_periods(self.payer_transitions, self.gap_days, self.hot_patients)

    # -- marts --------------------------------------------------------------------------

    @cached_property
    def dim_patients(self) -> DataFrame:
        return care.dim_patients(self.patients, self.attribution)

    @cached_property
    def dim_providers(self) -> DataFrame:
        return care.dim_providers(self.providers)

    @cached_property
    def fct_appointments(self) -> DataFrame:
        return care.fct_appointments(self.appointments_enriched)

    @cached_property
    def fct_subscriptions(self) -> DataFrame:
        return care.fct_subscriptions(self.subscriptions_enriched)

    @cached_property
    def fct_mrr_daily(self) -> DataFrame:
        # The number of plan changes is not needed here: staged subscriptions will do.
        return care.fct_mrr_daily(self.subscriptions, self.as_of, self.revenue_start)

    @cached_property
    def revenue_days(self) -> DataFrame:
        return care.revenue_days(self.subscriptions, self.revenue_start)

    @cached_property
    def subscription_history(self) -> DataFrame:
        return care.subscription_history(self.plan_periods, self.subscriptions)

    @cached_property
    def marketing(self) -> DataFrame:
        return care.mart_marketing_attribution(self.attribution, self.subscriptions_enriched)

    @cached_property
    def clinical_encounters(self) -> DataFrame:
        return clinical.mart_clinical_encounters(
            self.encounters, self.clinical_patients, self.payer_periods, self.as_of
        )

    @cached_property
    def plan_mix(self) -> DataFrame:
        return care.plan_mix_over_time(self.plan_periods, self.revenue_days)

    @cached_property
    def plan_transitions(self) -> DataFrame:
        return care.plan_transitions(self.plan_periods, self.hot_subscriptions)

    def tables(self) -> dict[tuple[str, str], DataFrame]:
        """Staged and serving tables by (schema, table)."""
        return {place: getattr(self, model) for model, place in TABLES.items()}

    def publish(self, root: str, models: Sequence[str] | None = None) -> None:
        """Write models (all that are tables, unless given) to ``root/schema/table``, and take each from there from
        then on, so that what is built on it reads the written rows instead of deriving them again."""
        for model, place in TABLES.items():
            if models is None or model in models:
                written = publish_tables(self.raw.spark, {place: getattr(self, model)}, root, SORTED.get(model))
                self.read_back(model, written[place])

    def read_back(self, model: str, written: DataFrame) -> None:
        """Take a model from its written table."""
        self.__dict__[model] = written

    def serving_views(self) -> dict[str, DataFrame]:
        """What dashboards may read, by view name. Current subscriptions are a view of the fact."""
        views = {
            table: df for (schema, table), df in self.tables().items()
            if schema in (SCHEMAS["marts"], SCHEMAS["clinical_marts"])
        }
        return views | {
            "subscriptions": self.fct_subscriptions,
            "plan_mix_over_time": self.plan_mix,
            "plan_transitions": self.plan_transitions,
        }


# The columns that the lean reports read of each serving table.
REPORT_COLUMNS = {
    "dim_patients": (
        "patient_id", "state", "gender", "age_band", "signup_date", "signup_cohort_month", "signup_channel",
        "first_touch_channel", "acquisition_cost",
    ),
    "fct_appointments": (
        "appointment_id", "provider_specialty", "patient_state", "patient_signup_channel", "appointment_type", "status",
        "is_completed", "is_no_show", "is_cancelled", "lead_time_days", "appointment_date", "appointment_week",
        "appointment_month",
    ),
    "fct_mrr_daily": ("calendar_date", "active_subscriptions", "mrr", "arr", "arpu"),
    "mart_marketing_attribution": (
        "channel", "campaign", "signups", "subscribers", "active_subscribers", "total_spend", "cac_per_signup",
        "cac_per_subscriber", "active_mrr",
    ),
}


def report_view(views: dict[str, DataFrame], table: str) -> DataFrame:
    """The columns of a serving table that the lean reports read; the daily revenue in order of days."""
    view = views[table].select(*REPORT_COLUMNS[table])
    return view.orderBy("calendar_date") if table == "fct_mrr_daily" else view


def register_views(views: dict[str, DataFrame]) -> None:
    """Make serving tables available to SQL by name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def publish_tables(
    spark: SparkSession, tables: dict[tuple[str, str], DataFrame], root: str, by: str | None = None
) -> dict[tuple[str, str], DataFrame]:
    """Write each table to ``root/schema/table``, its files in order of ``by``, and return them as read back. No shuffle files
    outlast their table."""
    for (schema, table), df in tables.items():
        rows = df.sortWithinPartitions(by) if by else df
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        with released(spark):
            (writer.option("parquet.writer.version", "v2") if by else writer).parquet(f"{root}/{schema}/{table}")
    return {name: spark.read.parquet(f"{root}/{name[0]}/{name[1]}") for name in tables}


# Where this driver has written serving tables: by application, folder, state of its files, and model.
_SERVED: dict[tuple, str] = {}


def served(raw: RawTables, models: Sequence[str]) -> Models:
    """Models of which the named ones are read from written tables. Each is written once for a state of the raw files (their
    number, size and last change), by whoever asks first; a table that failed half-way is written anew elsewhere."""
    spark, state = raw.spark, raw.state()
    m = Models(raw)
    for model in models:
        key = spark.sparkContext.applicationId, raw.folder, state, model
        if key not in _SERVED:
            root = scratch_path(spark, "serving")
            m.publish(root, [model])
            _SERVED[key] = "/".join((root, *TABLES[model]))
        m.read_back(model, spark.read.parquet(_SERVED[key]))
    return m
