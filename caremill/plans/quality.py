"""Data-quality, privacy and freshness checks.

A check is a DataFrame of violations: it passes when there are none. ``run_checks`` judges many
checks of a table at once and computes all row-wise ones in a single pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.functions.privacy import SERVING_PREFIXES
from caremill.operators.ordered import OrderedRows
from caremill.operators.skew import HotKeys
from caremill.session import released

# -- violations -----------------------------------------------------------------------------


def not_unique(df: DataFrame, *columns: str, ignore_nulls: bool = True) -> DataFrame:
    """Key values that occur more than once. A single key ignores NULLs; a combination of
    columns compares them like values (``ignore_nulls=False``)."""
    rows = df.dropna(subset=list(columns)) if ignore_nulls else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside a list and how often they occur; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent and how many rows have them; NULL passes. The child's keys are
    counted before the join, so a frequent key is one row there."""
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    known = parent.select(F.col(parent_column).alias(column))
    return used.join(known, column, "left_anti")


def false_rows(df: DataFrame, expression: str, where: str = "true") -> DataFrame:
    """Rows (among those matching ``where``) for which the expression is false; NULL passes."""
    return df.filter(F.expr(where)).filter(~F.expr(expression))


def overlapping_periods(periods: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Periods that end after the next one of the patient begins; touching ones are fine."""
    columns = ["patient_id", "payer_period_seq", "valid_from", "valid_to"]
    return (
        OrderedRows(periods.select(*columns), ["patient_id"], ["payer_period_seq"], hot)
        .neighbours(following={"next_valid_from": "valid_from"})
        .frame()
        .filter("valid_to > next_valid_from")
        .select("patient_id", "payer_period_seq", "valid_to", "next_valid_from")
    )


QUASI_IDENTIFIERS = ("age_band", "gender", "race", "ethnicity", "state", "zip3")


def small_cells(encounters: DataFrame, k: int = 5, by: Sequence[str] = QUASI_IDENTIFIERS) -> DataFrame:
    """Combinations of quasi-identifiers shared by fewer than ``k`` patients (a warning). Spark
    reduces to distinct patients per cell before it counts, so a frequent patient is one row."""
    return encounters.groupBy(*by).agg(F.count_distinct("patient_id").alias("k")).filter(F.col("k") < k)


# -- privacy --------------------------------------------------------------------------------


def column_catalogue(spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """(schema, table, column) rows of the given tables; only their schemas are looked at."""
    rows = [(schema, table, column) for (schema, table), df in tables.items() for column in df.columns]
    return spark.createDataFrame(rows, "table_schema string, table_name string, column_name string")


def warehouse_catalogue(spark: SparkSession, schemas: Iterable[str]) -> DataFrame:
    """The catalogue of tables saved in the named schemas."""
    tables = {
        (schema, table.name): spark.table(f"{schema}.{table.name}")
        for schema in schemas
        for table in spark.catalog.listTables(schema)
        if not table.isTemporary
    }
    return column_catalogue(spark, tables)


def banned_columns(catalogue: DataFrame, registry: DataFrame) -> DataFrame:
    """Direct identifiers anywhere, and inputs of de-identification in serving tables. Names must
    match exactly (in any case): a hash of an identifier is allowed."""
    serving = reduce(Column.__or__, [F.lower("table_name").startswith(p) for p in SERVING_PREFIXES])
    direct = F.col("tier") == 1
    listed = registry.select(F.lower(F.trim("column_name")).alias("column_name"), F.col("tier").cast("int"))
    return (
        catalogue.withColumn("column_name", F.lower("column_name"))
        .join(listed, "column_name")
        .filter(direct | ((F.col("tier") == 2) & serving))
        .select(
            F.when(direct, F.lit("direct_identifier_present"))
            .otherwise(F.lit("quasi_identifier_in_serving_layer"))
            .alias("violation"),
            "table_schema",
            "table_name",
            "column_name",
        )
    )


def banned_artifact_columns(artifact_columns: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered names of either tier in published files."""
    listed = registry.select(F.lower(F.trim("column_name")).alias("column_name")).distinct()
    return artifact_columns.withColumn("column_name", F.lower("column_name")).join(listed, "column_name", "left_semi")


# -- freshness ------------------------------------------------------------------------------


def freshness(tables: Mapping[str, tuple[DataFrame, str]], now: str, warn_hours: int = 36, error_hours: int = 72) -> DataFrame:
    """Age of the newest row of each table (name → table and timestamp column). A table without
    any timestamp has no age and is an error."""
    moment = F.lit(now).cast("timestamp_ntz")
    newest = [
        df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("newest")).select(F.lit(name).alias("table_name"), "newest")
        for name, (df, column) in tables.items()
    ]
    age = F.timestamp_diff("SECOND", F.col("newest"), moment) / F.lit(3600.0)
    return reduce(DataFrame.unionByName, newest).select(
        "table_name",
        "newest",
        age.alias("age_hours"),
        F.when(F.col("newest").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
        .alias("status"),
    )


# -- declared checks ------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared check of a table.

    ``kind``: unique, unique_combination, not_null, accepted_values, relationship or expression.
    """

    kind: str
    columns: tuple[str, ...] = ()
    accepted: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    expression: str | None = None
    where: str = "true"
    severity: str = "error"
    name: str = field(default="")

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}({', '.join(self.columns) or self.expression})"

    def failing_row(self) -> Column | None:
        """Row-wise condition of a failure, or None when the check has to compare rows."""
        if self.kind == "not_null":
            return F.col(self.columns[0]).isNull()
        if self.kind == "accepted_values":
            return ~F.col(self.columns[0]).isin(*self.accepted)
        if self.kind == "expression":
            return F.expr(self.where) & ~F.expr(self.expression)
        return None


UNIQUE_KINDS = ("unique", "unique_combination")


def run_checks(checks: Mapping[str, Sequence[Check]], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failures per check: (table_name, check_name, severity, failures, status).

    The row-wise checks of a table share one scan and one aggregate; relationship checks each need their own shuffle of
    pre-counted keys. Uniqueness is judged by hashes first, at once: keys no hash of which occurs twice do not repeat.
    Only where one does are the keys themselves shuffled and counted.
    """
    suspect = _repeated_hashes(checks, tables)
    counted: list[DataFrame] = []
    for table, declared in checks.items():
        df = tables[table]
        rowwise = [(c, c.failing_row()) for c in declared if c.failing_row() is not None]
        if rowwise:
            one = df.agg(*[F.count_if(failing).alias(f"c{i}") for i, (_, failing) in enumerate(rowwise)])
            parts = F.array(*[_finding(table, c, F.col(f"c{i}")) for i, (c, _) in enumerate(rowwise)])
            counted.append(one.select(F.inline(parts)))
        unique = [c for c in declared if c.kind in UNIQUE_KINDS and (table, c) not in suspect]
        if unique:
            none = F.array(*[_finding(table, c, F.lit(0)) for c in unique])
            counted.append(df.sparkSession.range(1).select(F.inline(none)))
        for check in declared:
            if (table, check) in suspect:
                failing = not_unique(df, *check.columns, ignore_nulls=check.kind == "unique").agg(F.count(F.lit(1)).alias("n"))
            elif check.kind == "relationship":
                missing = orphans(df, check.columns[0], tables[check.parent], check.parent_column)
                failing = missing.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n"))
            else:
                continue
            counted.append(failing.select(F.inline(F.array(_finding(table, check, F.col("n"))))))
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.col("severity"))
    return reduce(DataFrame.unionByName, counted).withColumn("status", status)


def _repeated_hashes(checks: Mapping[str, Sequence[Check]], tables: Mapping[str, DataFrame]) -> set[tuple[str, Check]]:
    """The uniqueness checks, by table, with keys of which two rows have the same hash. One job looks at all of them."""
    declared = [(table, c) for table, some in checks.items() for c in some if c.kind in UNIQUE_KINDS]
    parts = []
    for i, (table, check) in enumerate(declared):
        rows = tables[table].dropna(subset=list(check.columns)) if check.kind == "unique" else tables[table]
        hashes = not_unique(rows.select(F.xxhash64(*check.columns).alias("hash")), "hash")
        parts.append(hashes.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n"))
    if not parts:
        return set()
    with released(parts[0].sparkSession):
        found = reduce(DataFrame.unionByName, parts).filter("n > 0").collect()
    return {declared[row["i"]] for row in found}


def _finding(table: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.label).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def _key(*names: str) -> tuple[Check, ...]:
    return tuple(Check(kind, (name,)) for name in names for kind in ("unique", "not_null"))


def _child(column: str, parent: str, parent_column: str) -> Check:
    return Check("relationship", (column,), parent=parent, parent_column=parent_column)


# Value lists and rules each table must meet.
APPOINTMENT_STATUSES = ("completed", "no_show", "cancelled", "scheduled")
APPOINTMENT_TYPES = ("video", "phone", "message")
SUBSCRIPTION_STATUSES = ("active", "cancelled", "paused")
EVENT_TYPES = ("created", "activated", "plan_changed", "cancelled", "reactivated")
PLANS = ("basic", "plus", "premium")
CLINICAL_BANDS = ("0-17", "18-34", "35-49", "50-64", "65-74", "75-89", "90+")
MEMBER_BANDS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")

RAW_CHECKS: dict[str, tuple[Check, ...]] = {
    "raw.patients": _key("patient_id"),
    "raw.providers": _key("provider_id"),
    "raw.appointments": (
        *_key("appointment_id"),
        Check("not_null", ("patient_id",)),
        _child("patient_id", "raw.patients", "patient_id"),
    ),
    "raw.subscriptions": (*_key("subscription_id"), _child("patient_id", "raw.patients", "patient_id")),
    "raw.subscription_events": _key("event_id"),
    "raw.marketing_touchpoints": _key("touchpoint_id"),
    "raw.synthea_patients": _key("Id"),
    "raw.synthea_encounters": (
        *_key("Id"),
        Check("not_null", ("PATIENT",)),
        _child("PATIENT", "raw.synthea_patients", "Id"),
    ),
    "raw.synthea_payer_transitions": (
        Check("not_null", ("PATIENT",)),
        _child("PATIENT", "raw.synthea_patients", "Id"),
    ),
}

MODEL_CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_patients": _key("patient_id"),
    "stg_providers": _key("provider_id"),
    "stg_appointments": (
        *_key("appointment_id"),
        Check("accepted_values", ("status",), APPOINTMENT_STATUSES),
        Check("accepted_values", ("appointment_type",), APPOINTMENT_TYPES),
        _child("patient_id", "stg_patients", "patient_id"),
    ),
    "stg_subscriptions": (
        *_key("subscription_id"),
        Check("accepted_values", ("status",), SUBSCRIPTION_STATUSES),
        Check("not_null", ("mrr_amount",)),
    ),
    "stg_subscription_events": (
        *_key("event_id"),
        Check("accepted_values", ("event_type",), EVENT_TYPES),
    ),
    "stg_marketing_touchpoints": _key("touchpoint_id"),
    "stg_ehr__patients": (
        *_key("patient_id"),
        Check("expression", expression="length(zip3) = 3"),
        Check("not_null", ("age_band",)),
        Check("accepted_values", ("age_band",), CLINICAL_BANDS),
    ),
    "stg_ehr__encounters": (
        *_key("encounter_id"),
        Check("not_null", ("patient_id",)),
        _child("patient_id", "stg_ehr__patients", "patient_id"),
        Check("expression", expression="duration_minutes >= 0"),
        Check("not_null", ("encounter_class",)),
    ),
    "stg_ehr__payer_transitions": (
        Check("not_null", ("patient_id",)),
        Check("not_null", ("valid_from",)),
        Check("expression", expression="NOT is_invalid_interval", severity="warn"),
    ),
    "int_ehr__payer_periods_folded": (
        *_key("payer_period_key"),
        Check("not_null", ("patient_id",)),
        Check("unique_combination", ("patient_id", "valid_from")),
        _child("patient_id", "stg_ehr__patients", "patient_id"),
        Check("expression", expression="source_row_count >= 1"),
        Check("expression", expression="coverage_days >= 0", where="valid_to IS NOT NULL"),
    ),
    "mart_clinical_encounters": (
        *_key("encounter_id"),
        Check("not_null", ("patient_id",)),
        Check("not_null", ("age_band",)),
    ),
    "dim_patients": (*_key("patient_id"), Check("accepted_values", ("age_band",), MEMBER_BANDS)),
    "dim_providers": _key("provider_id"),
    "fct_appointments": (
        *_key("appointment_id"),
        Check("not_null", ("patient_id",)),
        _child("patient_id", "dim_patients", "patient_id"),
        Check("accepted_values", ("status",), APPOINTMENT_STATUSES),
    ),
    "fct_mrr_daily": (*_key("calendar_date"), Check("not_null", ("mrr",))),
    "fct_subscriptions": (
        *_key("subscription_id"),
        _child("patient_id", "dim_patients", "patient_id"),
        Check("accepted_values", ("plan_id",), PLANS),
        Check("accepted_values", ("status",), SUBSCRIPTION_STATUSES),
    ),
    "mart_marketing_attribution": (Check("not_null", ("signups",)),),
    "dim_subscription_history": (
        Check("not_null", ("subscription_id",)),
        _child("subscription_id", "stg_subscriptions", "subscription_id"),
        _child("patient_id", "dim_patients", "patient_id"),
        Check("accepted_values", ("plan_id",), PLANS),
        Check("not_null", ("valid_from",)),
        Check("not_null", ("is_current",)),
        Check("unique_combination", ("subscription_id", "valid_from")),
    ),
}
