"""Neighbours, numbers and running sums against brute force in Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from compare import plan_of

from caremill.operators import skew
from caremill.operators.ordered import OrderedRows
from caremill.operators.skew import find_hot_keys


def _rows(seed: int) -> list[tuple]:
    """A third of the rows under one key, a NULL key, NULL order values and copies of one row."""
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None, f"k{i}"])
        at = rng.choice([None, *range(30)]) if key != "hot" else rng.choice([None, *range(200)])
        rows.append((key, at, i % 7, i))
    rows += [("copies", 5, 1, 1000)] * 150
    return rows


def _expected(rows: list[tuple]) -> list[tuple]:
    result = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[3]))
        total = 0
        for i, row in enumerate(mine):
            total += row[2]
            before = mine[i - 1][2] if i else None
            after = mine[i + 1][1] if i + 1 < len(mine) else None
            result.append((*row, before, after, i + 1, i + 1 == len(mine), total))
    return result


def _actual(spark, rows, hot) -> list[tuple]:
    df = spark.createDataFrame(rows, "key string, at int, v int, id int").repartition(5)
    ordered = OrderedRows(df, ["key"], ["at", "id"], hot(df))
    ordered.neighbours(previous={"before": "v"}, following={"after": "at"}, number="n", is_last="last")
    ordered.running_sum("total", "v")
    return [tuple(r) for r in ordered.frame().select("key", "at", "v", "id", "before", "after", "n", "last", "total").collect()]


def _sorted(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("rows_per_task", [3, 40, 100, 10_000])
def test_same_as_brute_force(spark, rows_per_task):
    rows = _rows(rows_per_task)
    actual = _actual(spark, rows, lambda df: find_hot_keys(df, ["key"], rows_per_task))
    assert _sorted(actual) == _sorted(_expected(rows))


def test_same_with_too_many_hot_keys_to_list(spark, monkeypatch):
    monkeypatch.setattr(skew, "LISTED_KEYS", 2)
    rows = _rows(1)

    def hot(df):
        found = find_hot_keys(df, ["key"], 5)
        assert found.unlisted
        return found

    assert _sorted(_actual(spark, rows, hot)) == _sorted(_expected(rows))


@pytest.mark.parametrize("rows_per_task", [3, 10_000])
def test_lookup_keeps_all_rows(spark, rows_per_task):
    df = spark.createDataFrame(_rows(2), "key string, at int, v int, id int")
    per_key = spark.createDataFrame([("hot", 1), ("a", 2), ("unused", 3)], "key string, w int")
    found = OrderedRows(df, ["key"], ["at", "id"], find_hot_keys(df, ["key"], rows_per_task)).lookup(per_key).frame()
    expected = [(r[0], r[3], {"hot": 1, "a": 2}.get(r[0])) for r in _rows(2)]
    assert _sorted(tuple(r) for r in found.select("key", "id", "w").collect()) == _sorted(expected)


def test_hot_key_is_spread_over_chunks(spark):
    df = spark.range(10_000).select(F.lit("one").alias("key"), F.col("id").alias("at"))
    ordered = OrderedRows(df, ["key"], ["at"], find_hot_keys(df, ["key"], 1000))
    sizes = [r["count"] for r in ordered._chunked.groupBy("_chunk").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 2000


def test_copies_of_one_row_are_spread_too(spark):
    df = spark.range(10_000).select(F.lit("one").alias("key"), F.lit(1).alias("at"))
    ordered = OrderedRows(df, ["key"], ["at"], find_hot_keys(df, ["key"], 1000)).neighbours(number="n")
    sizes = [r["count"] for r in ordered._chunked.groupBy("_chunk").count().collect()]
    assert max(sizes) < 2000
    assert sorted(r.n for r in ordered.frame().collect()) == list(range(1, 10_001))


def test_ordinary_keys_take_one_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("key"), F.col("id").alias("at"))
    frame = OrderedRows(df, ["key"], ["at"]).neighbours(previous={"p": "at"}).running_sum("s", "at").frame()
    assert plan_of(frame).count("Exchange") == 1
