"""Raw care and clinical tables derived from the TPC-H-like test tables.

Every column is text, as the landed files would have it. The derivations are plain column
arithmetic, so that a SQL engine can repeat them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.functions.values import lookup
from caremill.operators.ordered import OrderedRows
from caremill.operators.skew import HotKeys, find_hot_keys
from caremill.sources.landing import stamp

# "Today" of the entities whose dates come from orders, and of those whose dates come from events.
ORDERS_AS_OF = date(2002, 6, 30)
EVENTS_AS_OF = date(2024, 2, 1)
REVENUE_START = date(1995, 1, 1)
RECENT_REVENUE_START = date(2023, 12, 25)
LOADED_AT = "2024-02-01 00:00:00"


# Columns of the test tables. Stating them saves Spark from opening files to find out.
GIVEN = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _plus_days(first: str, days: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), days.cast("int"))


def _midnight(day: Column) -> Column:
    return _text(day.cast("timestamp_ntz"))


def _plus_seconds(moment: Column, seconds: Column) -> Column:
    return moment + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


class RawTables:
    """The raw tables over one folder of test tables; nothing is read until used.

    Test orders and test events lie decades apart. ``recent`` moves the start of subscriptions
    into the month of the events, for queries that compare the two.
    """

    def __init__(self, spark: SparkSession, folder: str, recent: bool = False) -> None:
        self.spark, self.folder, self.recent = spark, folder.rstrip("/"), recent

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    def state(self) -> tuple:
        """Number, size and last change of the files, from their listing; none is opened."""
        files = self.spark.read.format("binaryFile").load([f"{self.folder}/{name}.parquet" for name in GIVEN])
        return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first())

    # -- care ---------------------------------------------------------------------------

    def patients(self) -> DataFrame:
        key = F.col("c_custkey")
        created = _midnight(_plus_days("2024-01-01", key % 30))
        customers = self.given("customer").join(
            self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        raw = customers.select(
            _text(key).alias("patient_id"),
            F.concat(F.lit("anon_"), _text(key)).alias("anonymous_id"),
            F.concat(
                F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")
            ).alias("email"),
            F.lit("Given").alias("first_name"),
            F.col("c_name").alias("last_name"),
            _text(_plus_days("1935-01-01", key * 37 % 25000)).alias("date_of_birth"),
            lookup(_text(key % 4), {"0": "Female", "1": "Male", "2": "Nonbinary", "3": "Undisclosed"}).alias("gender"),
            F.lower("n_name").alias("state"),
            F.col("c_mktsegment").alias("signup_channel"),
            created.alias("created_at"),
            created.alias("updated_at"),
        )
        return stamp(raw, LOADED_AT)

    def providers(self) -> DataFrame:
        key = F.col("s_suppkey")
        specialties = {"0": "Primary Care", "1": "Behavioral Health", "2": "Dermatology", "3": "Endocrinology"}
        raw = self.given("supplier").select(
            _text(key).alias("provider_id"),
            F.col("s_name").alias("provider_name"),
            # One in five has none.
            lookup(_text(key % 5), specialties).alias("specialty"),
            _midnight(_plus_days("2024-01-01", key % 30)).alias("created_at"),
        )
        return stamp(raw, LOADED_AT)

    def _lines(self) -> DataFrame:
        # The raw columns are shuffled once on the key of the join, which computes the rows' expressions behind it:
        # few input files do not mean few tasks, and large orders meet the lines where they are.
        lines = self.given("lineitem").repartition("l_orderkey").withColumn(
            "line_id",
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date")),
        )
        return lines.join(self.given("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def appointments(self) -> DataFrame:
        scheduled = _plus_seconds(F.col("l_shipdate"), F.col("l_partkey") % 24 * 3600)
        booked = _plus_seconds(F.col("o_orderdate"), F.col("l_orderkey") % 24 * 3600)
        happened = lookup(F.col("l_returnflag"), {"A": "Completed", "N": "No_Show", "R": "Cancelled"})
        raw = self._lines().select(
            F.col("line_id").alias("appointment_id"),
            _text("o_custkey").alias("patient_id"),
            _text("l_suppkey").alias("provider_id"),
            lookup(_text(F.col("l_linenumber") % 3), {"0": "Video", "1": "Phone", "2": "Message"}).alias("appointment_type"),
            F.when(F.col("o_orderstatus") == "P", F.lit("Scheduled")).otherwise(happened).alias("status"),
            _text(scheduled).alias("scheduled_at"),
            _text(booked).alias("created_at"),
            _text(scheduled).alias("updated_at"),
        )
        return stamp(raw, LOADED_AT)

    def subscriptions(self) -> DataFrame:
        key = F.col("o_orderkey")
        started = _plus_days("2024-01-01", key % 30) if self.recent else F.col("o_orderdate").cast("date")
        tier = F.left("o_orderpriority", F.lit(1))
        ended = F.date_add(started, (key % 400).cast("int"))
        finished = F.col("o_orderstatus") == "F"
        raw = self.given("orders").select(
            _text(key).alias("subscription_id"),
            _text("o_custkey").alias("patient_id"),
            lookup(tier, {"1": "Premium", "2": "Premium", "3": "Plus", "4": "Basic", "5": "Basic"}).alias("plan_id"),
            lookup(tier, {"1": "199", "2": "199", "3": "99", "4": "49", "5": "49"}).alias("mrr_amount"),
            lookup(F.col("o_orderstatus"), {"F": "Cancelled", "O": "Active", "P": "Paused"}).alias("status"),
            _text(started).alias("started_at"),
            F.when(finished, _text(ended)).otherwise(F.lit("")).alias("cancelled_at"),
            _midnight(started).alias("created_at"),
            _midnight(F.when(finished, ended).otherwise(started)).alias("updated_at"),
        )
        return stamp(raw, LOADED_AT)

    def subscription_events(self) -> DataFrame:
        error = F.when(F.col("user_id") % 4 == 0, F.lit("Cancelled")).otherwise(F.lit("Activated"))
        kind = F.coalesce(
            lookup(
                F.col("event_type"),
                {"signup": "Created", "purchase": "Plan_Changed", "view": "Activated", "click": "Reactivated"},
            ),
            error,
        )
        plan = lookup(_text(F.col("event_id") % 3), {"0": "Basic", "1": "Plus", "2": "Premium"})
        raw = self.given("events").select(
            _text("event_id").alias("event_id"),
            _text("user_id").alias("subscription_id"),
            kind.alias("event_type"),
            F.lit("").alias("from_plan"),
            F.when(F.col("event_type").isin("signup", "purchase"), plan).otherwise(F.lit("")).alias("to_plan"),
            _text(F.col("event_id") % 3 * 50).alias("mrr_delta"),
            _text("ts").alias("event_at"),
        )
        return stamp(raw, LOADED_AT)

    def marketing_touchpoints(self) -> DataFrame:
        user = _text("user_id")
        raw = self.given("events").select(
            _text("event_id").alias("touchpoint_id"),
            F.concat(F.lit("anon_"), user).alias("anonymous_id"),
            F.when(F.col("event_type") == "signup", user).otherwise(F.lit("")).alias("patient_id"),
            # A few touches have no channel.
            F.when(F.col("event_id") % 89 != 0, F.upper("event_type")).alias("channel"),
            F.concat(F.lit("Medium"), _text(F.col("event_id") % 3)).alias("utm_medium"),
            F.concat(F.lit("C"), _text(F.col("event_id") % 5)).alias("campaign"),
            F.upper("event_type").alias("event_type"),
            _text("value").alias("cost"),
            _text("ts").alias("event_at"),
        )
        return stamp(raw, LOADED_AT)

    # -- clinical -----------------------------------------------------------------------

    def clinical_patients(self) -> DataFrame:
        key = F.col("c_custkey")
        born = _plus_days("1935-01-01", key * 37 % 25000)
        balance = F.col("c_acctbal").cast("decimal(18,2)")
        return self.given("customer").select(
            _text(key).alias("Id"),
            _text(born).alias("BIRTHDATE"),
            F.when(key % 9 == 0, _text(F.date_add(born, 20000))).alias("DEATHDATE"),
            F.lpad(_text(key * 7 % 100000), 5, "0").alias("ZIP"),
            F.concat(F.lit("S"), _text("c_nationkey")).alias("STATE"),
            F.when(key % 3 == 0, F.lit("M")).when(key % 3 == 1, F.lit("S")).alias("MARITAL"),
            F.concat(F.lit("race"), _text(key % 4)).alias("RACE"),
            F.concat(F.lit("eth"), _text(key % 2)).alias("ETHNICITY"),
            F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("GENDER"),
            _text(balance).alias("HEALTHCARE_EXPENSES"),
            _text((balance / 2).cast("decimal(18,2)")).alias("HEALTHCARE_COVERAGE"),
            _text(key * 13 % 90000).alias("INCOME"),
            # Identifiers that must not be landed.
            F.concat(F.lit("999-"), _text(key)).alias("SSN"),
            F.col("c_name").alias("LAST"),
        )

    def encounters(self) -> DataFrame:
        started = _plus_seconds(F.col("l_shipdate"), F.col("l_partkey") * 61 % 86400)
        stopped = _plus_seconds(started, (F.col("l_quantity") * 97).cast("bigint"))
        cost = F.col("l_extendedprice").cast("decimal(18,2)")
        claim = (cost * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(18,2)")
        covered = (cost * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")
        part = F.col("l_partkey")
        return self._lines().select(
            F.col("line_id").alias("Id"),
            _text("o_custkey").alias("PATIENT"),
            _text("l_suppkey").alias("PROVIDER"),
            F.concat(F.lit("org"), _text(F.col("l_suppkey") % 10)).alias("ORGANIZATION"),
            F.when(part % 11 != 0, F.col("o_orderstatus")).alias("PAYER"),
            F.concat(_text(started), F.lit("Z")).alias("START"),
            F.concat(_text(stopped), F.lit("Z")).alias("STOP"),
            F.when(part % 97 == 0, F.lit("Virtual"))
            .otherwise(F.concat("l_returnflag", "l_linestatus"))
            .alias("ENCOUNTERCLASS"),
            F.concat(F.lit("code"), _text(part % 50)).alias("CODE"),
            F.concat(F.lit("visit "), _text(part % 50)).alias("DESCRIPTION"),
            F.when(part % 3 == 0, F.concat(F.lit("r"), _text(part % 20))).alias("REASONCODE"),
            F.when(part % 3 == 0, F.concat(F.lit("reason "), _text(part % 20))).alias("REASONDESCRIPTION"),
            _text(cost).alias("BASE_ENCOUNTER_COST"),
            _text(claim).alias("TOTAL_CLAIM_COST"),
            _text(covered).alias("PAYER_COVERAGE"),
        )

    def hot_patients(self) -> HotKeys:
        """Patients with more coverage rows than one task should sort."""
        return find_hot_keys(self.given("orders").select(_text("o_custkey").alias("PATIENT")), ["PATIENT"])

    def payer_transitions(self, hot: HotKeys) -> DataFrame:
        """One row per customer and order day; it ends when the next begins, or three days before."""
        # Key and one-letter status in one number: Spark aggregates numbers without sorting.
        packed = F.col("o_orderkey") * 256 + F.ascii("o_orderstatus")
        days = (
            self.given("orders")
            .groupBy(_text("o_custkey").alias("PATIENT"), F.col("o_orderdate").cast("date").alias("starts"))
            .agg(F.min(packed).alias("packed"))
            .select("PATIENT", "starts", F.shiftright("packed", 8).alias("key"), F.char(F.col("packed") % 256).alias("payer"))
        )
        linked = OrderedRows(days, ["PATIENT"], ["starts"], hot).neighbours(following={"next": "starts"}).frame()
        early = F.when(F.col("key") % 7 == 0, F.lit(3)).otherwise(F.lit(0))
        return linked.select(
            "PATIENT",
            F.col("payer").alias("PAYER"),
            F.lit(None).cast("string").alias("SECONDARY_PAYER"),
            F.concat(F.lit("M"), _text(F.col("key") % 3)).alias("MEMBERID"),
            F.when(F.col("key") % 2 == 0, F.lit("Self")).otherwise(F.lit("Guardian")).alias("PLAN_OWNERSHIP"),
            _text("starts").alias("START_DATE"),
            _text(F.date_sub("next", early)).alias("END_DATE"),
        )
