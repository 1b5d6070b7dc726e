"""Rows that must not get lost: revenue without an id, fractions, late rows, far-future ends, repeated log lines."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from unittest.mock import Mock

import pytest

from caremill import session
from caremill.operators.fold import fold_intervals
from caremill.operators.versions import merge_by_key, snapshot
from caremill.plans.care import fct_mrr_daily
from caremill.sources import stored
from caremill.sources.artifacts import artifact_columns


def test_revenue_keeps_fractions_and_rows_without_id(spark):
    schema = "subscription_id string, started_at date, cancelled_at date, mrr_amount decimal(18,2)"
    rows = [("a", date(2024, 1, 1), None, Decimal("49.50")), (None, date(2024, 1, 1), None, Decimal("99.25"))]
    day = fct_mrr_daily(spark.createDataFrame(rows, schema), date(2024, 1, 5), date(2024, 1, 1)).first()
    assert (day.active_subscriptions, day.mrr) == (1, Decimal("148.75"))


def _row(key, value, day):
    return (key, value, datetime(2024, 1, day))


SCHEMA = "id string, value string, updated_at timestamp_ntz"


def test_a_late_older_row_changes_nothing(spark):
    target = spark.createDataFrame([_row("a", "new", 5), _row("b", "old", 1)], SCHEMA)
    delta = spark.createDataFrame([_row("a", "OLD", 3), _row("b", "newer", 2), _row("c", "first", 1)], SCHEMA)
    merged = merge_by_key(target, delta, ["id"], "updated_at")
    assert {r.id: r.value for r in merged.collect()} == {"a": "new", "b": "newer", "c": "first"}
    assert sorted(merge_by_key(merged, delta, ["id"], "updated_at").collect()) == sorted(merged.collect())


def test_a_late_older_row_changes_nothing_in_a_stored_table(spark, tmp_path):
    root = str(tmp_path / "t")
    stored.sync_merge(spark.createDataFrame([_row("a", "new", 5), _row("b", "one", 5)], SCHEMA), root, ["id"], "updated_at")
    late = spark.createDataFrame([_row("a", "OLD", 3), _row("b", "two", 6)], SCHEMA)
    for _ in range(2):
        stored.sync_merge(late, root, ["id"], "updated_at", lookback_days=9)
    rows = stored.read_stored(spark, root, ["id"], "updated_at").collect()
    assert {r.id: r.value for r in rows} == {"a": "new", "b": "two"}


def test_a_republished_base_counts_as_a_whole_line(spark, tmp_path):
    root = str(tmp_path / "t")
    stored.publish(spark.createDataFrame([_row("a", "x", 5)], SCHEMA), root, "updated_at")
    stored.publish(spark.createDataFrame([_row("a", "x", 3)], SCHEMA), root, "updated_at")
    stored.sync_merge(spark.createDataFrame([_row("b", "y", 4)], SCHEMA), root, ["id"], "updated_at")
    assert {r.id for r in stored.read_stored(spark, root, ["id"], "updated_at").collect()} == {"a", "b"}


def test_a_null_key_keeps_its_snapshot_version(spark):
    current = spark.createDataFrame([(None, "active"), ("a", "active")], "id string, status string")
    one = snapshot(current, None, "id", ["status"], "2024-01-01 00:00:00")
    two = snapshot(current, one, "id", ["status"], "2024-01-02 00:00:00")
    assert two.count() == 2 and two.filter("valid_to IS NOT NULL").count() == 0


def test_a_far_future_end_is_open(spark):
    rows = [("p", "x", "m", date(2024, 1, 1), date(2024, 2, 1)), ("p", "x", "m", date(2024, 2, 1), date(9999, 12, 31))]
    df = spark.createDataFrame(rows, "p string, payer string, member string, valid_from date, valid_to date")
    period = fold_intervals(df, "p", "payer", "member", "valid_from", "valid_to").first()
    assert (period.valid_to, period.days, period.source_row_count) == (None, None, 2)


def test_partition_columns_are_published_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "02139", "MA"), (2, "10001", "NY")], "id int, zip string, state string")
    rows.write.partitionBy("state", "zip").parquet(str(tmp_path / "nested" / "patients"))
    rows.select("id").write.parquet(str(tmp_path / "plain"))
    found = {(r.artifact, r.column_name) for r in artifact_columns(spark, str(tmp_path)).collect()}
    assert found == {("patients", "id"), ("patients", "state"), ("patients", "zip"), ("plain", "id")}


def test_a_cluster_has_to_name_the_shared_folder():
    spark = Mock()
    spark.conf.get.return_value = None
    spark.sparkContext.getCheckpointDir.return_value = None
    spark.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(spark)
