"""Land raw files: all columns as text, direct identifiers never written, every row stamped."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.functions.dates import TIMESTAMP
from caremill.functions.privacy import direct_identifiers

LOAD_STAMP = "_loaded_at"

# Columns of the care exports.
CARE_TABLES = {
    "providers": ("provider_id", "provider_name", "specialty", "created_at"),
    "patients": (
        "patient_id", "anonymous_id", "email", "first_name", "last_name", "date_of_birth",
        "gender", "state", "signup_channel", "created_at", "updated_at",
    ),
    "appointments": (
        "appointment_id", "patient_id", "provider_id", "appointment_type", "status",
        "scheduled_at", "created_at", "updated_at",
    ),
    "subscriptions": (
        "subscription_id", "patient_id", "plan_id", "mrr_amount", "status",
        "started_at", "cancelled_at", "created_at", "updated_at",
    ),
    "subscription_events": (
        "event_id", "subscription_id", "event_type", "from_plan", "to_plan", "mrr_delta", "event_at",
    ),
    "marketing_touchpoints": (
        "touchpoint_id", "anonymous_id", "patient_id", "channel", "utm_medium", "campaign",
        "event_type", "cost", "event_at",
    ),
}

# Raw table of each folder of the clinical export.
CLINICAL_FOLDERS = {
    "patients": "synthea_patients",
    "encounters": "synthea_encounters",
    "payer_transitions": "synthea_payer_transitions",
    "payers": "synthea_payers",
    "providers": "synthea_providers",
    "organizations": "synthea_organizations",
}


def text_schema(columns: Iterable[str]) -> str:
    return ", ".join(f"`{name}` string" for name in columns)


def read_text_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, line_breaks: bool = False
) -> DataFrame | None:
    """A headered CSV file, or all ``*.csv`` files of a folder, as text; None when there are none.

    No types are inferred: that would be a second pass, and would turn a postal code into a
    number. With ``columns`` the headers are checked against them. Rows of another length are
    refused. Quoted fields may hold ``line_breaks`` when asked for: such files cannot be split.
    """
    reader = (
        spark.read.option("header", True)
        .option("pathGlobFilter", "*.csv")
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", line_breaks)
    )
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    try:
        df = reader.csv(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df if df.columns else None


def drop_identifiers(df: DataFrame, banned: Iterable[str] | None = None) -> DataFrame:
    """Without the direct identifiers, whatever the case of their names. Dropped before the
    write, so Spark does not even parse them."""
    names = {name.lower() for name in (direct_identifiers() if banned is None else banned)}
    return df.drop(*[column for column in df.columns if column.lower() in names])


def stamp(df: DataFrame, loaded_at: str) -> DataFrame:
    return df.withColumn(LOAD_STAMP, F.lit(loaded_at).cast(TIMESTAMP))


def replace_table(df: DataFrame, table: str) -> None:
    """Full refresh: create the table or replace it as a whole."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def land_care(spark: SparkSession, folder: str, schema: str, loaded_at: str) -> list[str]:
    """Land one CSV file per care table; missing ones are skipped. Returns the landed tables."""
    landed = []
    for table in CARE_TABLES:
        df = read_text_csv(spark, f"{folder}/{table}.csv")
        if df is not None:
            replace_table(stamp(df, loaded_at), f"{schema}.{table}")
            landed.append(table)
    return landed


def land_clinical(
    spark: SparkSession, folder: str, schema: str, loaded_at: str, banned: Iterable[str] | None = None
) -> list[str]:
    """Land a folder of CSV files per clinical table without direct identifiers; missing or empty
    folders are skipped. Returns the landed tables."""
    landed = []
    for name, table in CLINICAL_FOLDERS.items():
        df = read_text_csv(spark, f"{folder}/{name}")
        if df is not None:
            replace_table(stamp(drop_identifiers(df, banned), loaded_at), f"{schema}.{table}")
            landed.append(table)
    return landed
