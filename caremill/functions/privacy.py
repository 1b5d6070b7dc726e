"""De-identification rules and the registry of columns that must not be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.functions.values import band

# Columns by privacy tier. Tier 1 names are direct identifiers and are never
# landed; tier 2 names feed de-identification and never reach a serving table.
BANNED_COLUMNS = {
    "ssn": 1,
    "drivers": 1,
    "passport": 1,
    "prefix": 1,
    "first": 1,
    "middle": 1,
    "last": 1,
    "suffix": 1,
    "maiden": 1,
    "address": 1,
    "lat": 1,
    "lon": 1,
    "birthplace": 1,
    "owner_name": 1,
    "phone": 1,
    "fax": 1,
    "birthdate": 2,
    "zip": 2,
}

# Three-digit postal prefixes of areas with at most 20,000 people.
SPARSE_ZIP3 = (
    "036", "059", "063", "102", "203", "556", "692", "790", "821",
    "823", "830", "831", "878", "879", "884", "890", "893",
)

# Lower ends of the age bands.
CLINICAL_AGE_BANDS = {0: "0-17", 18: "18-34", 35: "35-49", 50: "50-64", 65: "65-74", 75: "75-89", 90: "90+"}
MEMBER_AGE_BANDS = {25: "25-34", 35: "35-44", 45: "45-54", 55: "55-64", 65: "65+"}
YOUNGEST_MEMBER_BAND = "18-24"

# Names of tables that dashboards may read start with one of these.
SERVING_PREFIXES = ("dim_", "fct_", "mart_")


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(BANNED_COLUMNS.items()), "column_name string, tier int"
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry kept as a headered CSV; names are trimmed and compared in lower case."""
    rows = spark.read.schema("column_name string, tier string, rationale string").option("header", True).csv(path)
    return rows.select(
        F.lower(F.trim("column_name")).alias("column_name"),
        F.coalesce(F.trim("tier"), F.lit("1")).cast("int").alias("tier"),
    ).filter("column_name <> ''")


def direct_identifiers(registry_df: DataFrame | None = None) -> frozenset[str]:
    """Tier-1 names in lower case. The registry is a short hand-kept list, so it is collected."""
    if registry_df is None:
        return frozenset(name for name, tier in BANNED_COLUMNS.items() if tier == 1)
    return frozenset(row.column_name.lower() for row in registry_df.filter("tier = 1").collect())


def clinical_age_band(age: Column) -> Column:
    return band(age, CLINICAL_AGE_BANDS)


def member_age_band(age: Column) -> Column:
    """Everybody below 25 is in the youngest band; an unknown age counts as the oldest one."""
    known = F.coalesce(band(age, MEMBER_AGE_BANDS), F.lit(YOUNGEST_MEMBER_BAND))
    return F.when(age.isNull(), F.lit(MEMBER_AGE_BANDS[65])).otherwise(known)


def zip3(postal_code: Column) -> Column:
    prefix = F.left(postal_code, F.lit(3))
    return F.when(prefix.isin(*SPARSE_ZIP3), F.lit("000")).otherwise(prefix)
