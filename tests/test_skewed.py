"""The same results when one key holds a third of all rows and cannot be sorted by one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from caremill.plans.models import Models, register_views
from caremill.sources.bindings import RawTables
from compare import TABLES, connect, difference, plan_of

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

# What one third of the rows of a table is moved to.
MOVED = {"orders": ("o_orderkey", "o_custkey", 7), "events": ("event_id", "user_id", 8), "lineitem": ("l_partkey", "l_suppkey", 3)}


def _skew(spark, folder: str, target: str) -> str:
    for table in TABLES:
        df = spark.read.parquet(f"{folder}/{table}.parquet")
        if table in MOVED:
            row, key, hot = MOVED[table]
            df = df.withColumn(key, F.when(F.col(row) % 3 == 0, F.lit(hot).cast(df.schema[key].dataType)).otherwise(F.col(key)))
        # A folder named like a file: both engines read all files in it.
        df.coalesce(1).write.parquet(f"{target}/{table}.parquet")
    return target


@pytest.fixture(scope="module")
def skewed(spark, folder, tmp_path_factory):
    return _skew(spark, folder, str(tmp_path_factory.mktemp("skewed")))


@pytest.fixture(scope="module")
def skewed_duck(skewed):
    con = connect(skewed)
    for table in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize(
    "name",
    [
        "payer_periods", "clinical_encounters", "subscription_history", "plan_mix", "plan_transitions", "mrr_daily",
        "int_attribution", "marketing_attribution", "int_appointments", "check_k_anonymity", "check_relationship",
        "check_overlap_subscriptions", "bi_busiest", "bi_hist_headline", "snapshot_subscriptions", "sync_merge",
    ],
)
def test_same_rows_on_skewed_tables(name, spark, skewed, skewed_duck, tiny_tasks):
    assert difference(QUERIES[name](spark, skewed), skewed_duck, ORACLES[name]) is None


def test_serving_views_answer_sql_with_parameters(spark, folder):
    register_views(Models(RawTables(spark, folder)).serving_views())
    by_view = "SELECT sum(signups) AS signups FROM mart_marketing_attribution WHERE channel LIKE :channel"
    every, one, none = [spark.sql(by_view, args={"channel": c}).first().signups for c in ("%", "click", "no such%")]
    assert every > one > 0 and none is None
    assert spark.sql("SELECT count(*) FROM subscriptions").first()[0] == spark.table("fct_subscriptions").count()


@pytest.mark.parametrize("name", ["int_appointments", "subscription_history"])
def test_joins_on_a_hot_key_are_split(name, spark, tmp_path):
    """With the sizes at which adaptive execution acts scaled down to the size of the tables."""
    settings = {
        "spark.caremill.rowsPerTask": "500",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        # A partition is split by the tasks that wrote it; small tables must not have just one.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    models = Models(RawTables(spark, _skew(spark, "/root/testdata/sf0.01", str(tmp_path))))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = models.appointments_enriched if name == "int_appointments" else models.subscription_history
        df.collect()
        assert "skew=true" in plan_of(df).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
