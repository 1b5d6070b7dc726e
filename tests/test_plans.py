"""The physical plans stay as designed."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from caremill.operators.versions import latest_per_key, rows_after
from caremill.plans import bi
from caremill.plans.catalogue import QUERIES
from caremill.plans.models import Models
from caremill.session import configure
from caremill.sources.bindings import GIVEN, RawTables
from compare import plan_of

WRITES = {
    "check_suite", "check_suite_raw", "check_banned_columns", "check_artifacts", "artifact_columns", "land_text",
    "land_glob", "land_drop_tier1", "sync_replace", "sync_merge_stored", "snapshot_stored", "stream_append", "stream_merge",
    "incremental_appointments", "sync_append_stored", "sync_append_recent", "sync_cursor_state", "sync_merge_lookback",
    "stream_append_lookback", "land_full_refresh", "land_registry",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_loops_and_no_python(name, spark, folder):
    plan = plan_of(QUERIES[name](spark, folder))
    assert not re.search(r"NestedLoop|CartesianProduct|Python|Pandas|ArrowEval", plan)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("bi_enc_month", {"l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"}),
        ("bi_sub_stats", {"o_orderstatus", "o_orderpriority"}),
        ("mrr_daily", {"o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"}),
    ],
)
def test_scans_read_only_what_is_needed(name, columns, spark, folder):
    # The tile reads a written table; here it is planned down to the raw ones.
    m = Models(RawTables(spark, folder))
    df = bi.encounters_by_month(m.clinical_encounters) if name == "bi_enc_month" else QUERIES[name](spark, folder)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(df, "formatted"))
    read = [{field.split(":")[0] for field in schema.split(",")} for schema in schemas]
    big = [s for s in read if any(c.startswith(("l_", "o_")) for c in s)]
    allowed = columns | {"o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"}
    assert big and all(s <= allowed for s in big), read


def test_cursor_reaches_the_scan(spark, folder):
    events = RawTables(spark, folder).given("events")
    plan = plan_of(rows_after(events, "ts", F.lit("2024-01-20").cast("timestamp_ntz")), "formatted")
    assert re.search(r"PushedFilters: .*GreaterThan\(ts,", plan)


def test_latest_row_is_chosen_before_the_shuffle(spark, folder):
    events = RawTables(spark, folder).given("events")
    plan = plan_of(latest_per_key(events, ["user_id"], "ts"))
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[:shuffle] and "Partial" in plan[shuffle:]


def test_daily_counts_are_summed_before_the_shuffle_and_read_once(spark, folder):
    plan = plan_of(Models(RawTables(spark, folder)).fct_mrr_daily)
    assert "partial_sum" in plan and plan.count("FileScan") == 1 and "Join" not in plan


def test_folding_shuffles_rows_once(spark, folder):
    m = Models(RawTables(spark, folder))
    staged = m.payer_transitions
    before, after = plan_of(staged).count("Exchange"), plan_of(m.payer_periods).count("Exchange")
    assert after == before


@pytest.fixture
def no_broadcast(spark):
    """Joins are planned as for tables too big to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_visits_are_dealt_out_by_patient_once_and_narrow(spark, folder, no_broadcast):
    configure(spark)
    plan = plan_of(Models(RawTables(spark, folder)).clinical_encounters)
    assert not re.search(r"hashpartitioning\([^)]*(_row_slice|_period_slice)", plan)
    behind = plan[plan.index("Exchange hashpartitioning(patient_id") :]
    assert "AS duration_minutes" in plan and "AS duration_minutes" not in behind


def test_appointments_are_dealt_out_by_patient_while_narrow(spark, folder, no_broadcast):
    configure(spark)
    plan = plan_of(Models(RawTables(spark, folder)).fct_appointments)
    behind = plan[plan.index("Exchange hashpartitioning(patient_id") :]
    assert "AS is_completed" in plan and "AS is_completed" not in behind


def test_distinct_patients_are_reduced_per_cell_first(spark, folder):
    plan = plan_of(QUERIES["check_k_anonymity"](spark, folder))
    assert "partial_count(distinct" in plan


TILES = {
    "dim_patients": ["view_patients"],
    "fct_mrr_daily": ["bi_mrr_trend", "bi_mrr_headline_trend", "view_mrr"],
    "fct_appointments": ["bi_appt_kpis", "bi_appts_week", "bi_noshow_specialty", "bi_appts_type", "view_appointments"],
    "mart_marketing_attribution": [
        "bi_channels", "bi_mkt_kpis", "bi_by_channel", "bi_by_channel_like", "bi_mkt_detail", "view_marketing",
    ],
    "mart_clinical_encounters": ["bi_enc_kpis", "bi_enc_month", "bi_enc_class", "bi_enc_demo"],
}


@pytest.mark.parametrize(("table", "name"), [(table, name) for table, names in TILES.items() for name in names])
def test_a_tile_scans_only_its_serving_table(table, name, spark, folder):
    plan = plan_of(QUERIES[name](spark, folder), "formatted")
    assert plan.count("Location:") == 1 and f"/{table}]" in plan and "Join" not in plan


def test_the_overview_scans_four_serving_tables(spark, folder):
    plan = plan_of(QUERIES["bi_overview"](spark, folder), "formatted")
    places = set(re.findall(r"Location: .*/(\w+)\]", plan))
    assert places == {"dim_patients", "fct_mrr_daily", "fct_appointments", "mart_marketing_attribution"}


def test_changed_raw_files_are_served_anew(spark, folder, tmp_path):
    own = str(tmp_path / "raw")
    for name in GIVEN:
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{own}/{name}.parquet")
    before = QUERIES["view_patients"](spark, own).count()
    assert QUERIES["view_patients"](spark, own).count() == before
    more = spark.read.parquet(f"{own}/customer.parquet").withColumn("c_custkey", F.col("c_custkey") + 1_000_000)
    more.limit(5).write.mode("append").parquet(f"{own}/customer.parquet")
    assert QUERIES["view_patients"](spark, own).count() == before + 5


def test_layers_are_published_from_written_tables(spark, folder, tmp_path):
    m = Models(RawTables(spark, folder))
    m.publish(str(tmp_path / "all"), ["appointments", "providers", "patients"])
    plan = plan_of(m.fct_appointments, "formatted")
    assert "/stg_appointments]" in plan and "orders.parquet" not in plan
