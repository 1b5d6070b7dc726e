"""Edge cases on hand-written rows, with results worked out by hand."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caremill.functions import dates, privacy, values
from caremill.operators import versions
from caremill.operators.fold import fold_intervals
from caremill.operators.history import as_of
from caremill.operators.intervals import join_covering
from caremill.operators.sweep import active_by_day, active_by_group
from caremill.plans import bi, care, clinical, quality, staging


def day(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def moment(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


# -- expressions ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("start", "end", "years", "days", "minutes"),
    [
        ("2000-12-31 23:59:59", "2001-01-01 00:00:01", 1, 1, 1),
        ("2000-01-01 00:00:00", "2000-12-31 23:59:59", 0, 365, 527039),
        ("2024-02-28 12:00:30", "2024-03-01 11:59:29", 0, 2, 2879),
        ("2024-05-01 10:00:59", "2024-05-01 10:00:00", 0, 0, 0),
        ("2024-05-01 10:01:00", "2024-05-01 10:00:59", 0, 0, -1),
    ],
)
def test_boundaries_are_counted(spark, start, end, years, days, minutes):
    df = spark.createDataFrame([(moment(start), moment(end))], "a timestamp_ntz, b timestamp_ntz")
    a, b = F.col("a"), F.col("b")
    row = df.select(dates.years_between(a, b), dates.days_between(a, b), dates.minutes_between(a, b)).first()
    assert tuple(row) == (years, days, minutes)


def test_zone_suffix_and_weeks(spark):
    row = spark.sql("SELECT '2024-01-03T10:20:30Z' AS t").select(
        dates.timestamp("t"), dates.week_start(dates.timestamp("t")), dates.month_start(dates.timestamp("t"))
    ).first()
    assert tuple(row) == (datetime(2024, 1, 3, 10, 20, 30), datetime(2024, 1, 1), datetime(2024, 1, 1))


def test_age_bands(spark):
    df = spark.createDataFrame([(a,) for a in (None, -1, 0, 17, 18, 24, 25, 64, 65, 89, 90)], "age int")
    rows = df.select("age", privacy.clinical_age_band(F.col("age")), privacy.member_age_band(F.col("age"))).collect()
    assert [tuple(r) for r in rows] == [
        (None, None, "65+"), (-1, None, "18-24"), (0, "0-17", "18-24"), (17, "0-17", "18-24"),
        (18, "18-34", "18-24"), (24, "18-34", "18-24"), (25, "18-34", "25-34"), (64, "50-64", "55-64"),
        (65, "65-74", "65+"), (89, "75-89", "65+"), (90, "90+", "65+"),
    ]


def test_postal_areas(spark):
    df = spark.createDataFrame([("03601",), ("02139",), (None,), ("89",)], "z string")
    assert [r[0] for r in df.select(privacy.zip3(F.col("z"))).collect()] == ["000", "021", None, "89"]


def test_ratios(spark):
    df = spark.createDataFrame([(201, 200), (1, 0), (None, 3)], "a long, b long")
    rows = df.select(values.exact_ratio(F.col("a"), F.col("b"), 2), values.share(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [(1.01, 1.005), (None, None), (None, None)]


# -- folding --------------------------------------------------------------------------------


def _fold(spark, rows, gap=0):
    df = spark.createDataFrame(
        [("p", payer, member, day(a), day(b)) for payer, member, a, b in rows],
        "patient_id string, payer_id string, member_id string, valid_from date, valid_to date",
    )
    folded = fold_intervals(df, "patient_id", "payer_id", "member_id", "valid_from", "valid_to", gap)
    return [
        (r.payer_id, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.source_row_count, r.is_latest)
        for r in folded.orderBy("period_seq").collect()
    ]


def test_touching_rows_fold_and_gaps_split(spark):
    rows = [("A", "1", "2001-01-01", "2002-01-01"), ("A", "1", "2002-01-01", "2003-01-01"), ("A", "1", "2003-01-02", "2004-01-01")]
    assert _fold(spark, rows) == [("A", "2001-01-01", "2003-01-01", 2, False), ("A", "2003-01-02", "2004-01-01", 1, True)]
    assert _fold(spark, rows, gap=1) == [("A", "2001-01-01", "2004-01-01", 3, True)]


def test_returning_to_a_payer_is_a_new_period(spark):
    rows = [("A", "1", "2001-01-01", "2002-01-01"), ("B", "1", "2002-01-01", "2003-01-01"), ("A", "1", "2003-01-01", "2004-01-01")]
    assert [r[0] for r in _fold(spark, rows)] == ["A", "B", "A"]


def test_row_after_an_open_one_joins_it_and_stays_open(spark):
    rows = [("A", "1", "2001-01-01", None), ("A", "1", "2009-01-01", "2010-01-01")]
    assert _fold(spark, rows) == [("A", "2001-01-01", None, 2, True)]


def test_rows_without_a_payer_never_fold(spark):
    rows = [(None, "1", "2001-01-01", "2002-01-01"), (None, "1", "2002-01-01", "2003-01-01"), ("A", "1", "2003-01-01", None)]
    assert [r[3] for r in _fold(spark, rows)] == [1, 1, 1]


def test_only_the_row_before_counts(spark):
    # Nested in the first row, the second ends long before the third begins.
    rows = [("A", "1", "2001-01-01", "2005-01-01"), ("A", "1", "2001-06-01", "2001-07-01"), ("A", "1", "2004-01-01", "2006-01-01")]
    assert _fold(spark, rows) == [("A", "2001-01-01", "2005-01-01", 2, False), ("A", "2004-01-01", "2006-01-01", 1, True)]


def test_members_and_inverted_rows(spark):
    raw = spark.createDataFrame(
        [
            ("p", "A", None, None, None, "2001-01-01", "2002-01-01"),
            ("p", "A", None, "m1", None, "2002-01-01", "2003-01-01"),
            ("p", "A", None, "m2", None, "2003-01-01", "2003-06-01"),
            ("p", "B", None, "x", None, "2009-01-01", "2008-01-01"),
            ("p", "B", None, "x", None, None, "2008-01-01"),
            (None, "C", None, "y", None, "2001-01-01", None),
        ],
        "PATIENT string, PAYER string, SECONDARY_PAYER string, MEMBERID string, PLAN_OWNERSHIP string, START_DATE string, END_DATE string",
    )
    staged = staging.payer_transitions(raw)
    assert [r.is_invalid_interval for r in staged.collect()] == [False, False, False, True, None, False]
    known, nobody = clinical.payer_periods(staged).orderBy(F.col("patient_id").asc_nulls_last()).collect()
    assert (known.first_member_id, known.last_member_id, known.distinct_member_ids) == ("m1", "m2", 2)
    assert known.member_id_was_reissued and known.is_current_period and known.coverage_days == 881
    assert (nobody.patient_id, nobody.valid_to, nobody.coverage_days) == (None, None, None)


def test_folding_keeps_all_rows_and_periods_of_touching_rows_do_not_overlap(spark):
    rng = random.Random(7)
    rows = []
    for patient in range(30):
        at = date(2000, 1, 1)
        for _ in range(rng.randint(1, 40)):
            end = at + timedelta(days=rng.randint(1, 400))
            rows.append((str(patient), rng.choice("AB"), rng.choice("xyz"), at, end))
            at = end + timedelta(days=rng.choice([0, 0, 3]))
    df = spark.createDataFrame(rows, "patient_id string, payer_id string, member_id string, valid_from date, valid_to date")
    folded = fold_intervals(df, "patient_id", "payer_id", "member_id", "valid_from", "valid_to")
    assert folded.agg(F.sum("source_row_count")).first()[0] == len(rows)
    periods = folded.withColumnRenamed("period_seq", "payer_period_seq")
    assert quality.overlapping_periods(periods).count() == 0


# -- history --------------------------------------------------------------------------------


def _history(spark, events):
    staged = spark.createDataFrame(
        [(str(i), "s", kind, plan, moment(at)) for i, (kind, plan, at) in enumerate(events)],
        "event_id string, subscription_id string, event_type string, to_plan string, event_at timestamp_ntz",
    )
    subs = spark.createDataFrame([("s", "p")], "subscription_id string, patient_id string")
    return care.subscription_history(care.plan_periods(staged), subs)


def test_history_of_changes_cancellation_and_reactivation(spark):
    history = _history(
        spark,
        [
            ("created", "Basic", "2024-01-01 10:00:00"),
            ("activated", None, "2024-01-01 11:00:00"),
            ("plan_changed", "Plus", "2024-02-01 09:00:00"),
            ("plan_changed", "Premium", "2024-02-01 12:00:00"),
            ("plan_changed", None, "2024-02-02 00:00:00"),
            ("cancelled", None, "2024-03-01 00:00:00"),
            ("reactivated", None, "2024-03-02 00:00:00"),
            ("cancelled", None, "2024-04-01 00:00:00"),
        ],
    ).orderBy("version").collect()
    assert [(r.plan_id, r.mrr_amount, str(r.valid_to), r.is_current) for r in history] == [
        ("basic", 49, "2024-02-01 09:00:00", False),
        ("plus", 99, "2024-02-01 12:00:00", False),
        ("premium", 199, "2024-03-01 00:00:00", False),
    ]


def test_change_after_cancellation_gives_an_inverted_period(spark):
    history = _history(
        spark,
        [("created", "basic", "2024-01-01 00:00:00"), ("cancelled", None, "2024-02-01 00:00:00"), ("plan_changed", "gold", "2024-03-01 00:00:00")],
    )
    last = history.filter("version = 2").first()
    assert (last.valid_to, last.is_current, last.mrr_amount) == (moment("2024-02-01 00:00:00"), False, None)
    assert quality.false_rows(history, "valid_from <= valid_to", "valid_to IS NOT NULL").count() == 1


def test_as_of_is_half_open(spark):
    history = _history(spark, [("created", "basic", "2024-01-01 00:00:00"), ("plan_changed", "plus", "2024-02-01 00:00:00")])
    assert [as_of(history, datetime(2024, m, d)).count() for m, d in ((1, 1), (2, 1))] == [1, 1]
    assert as_of(history, datetime(2024, 2, 1)).first().plan_id == "plus"
    assert as_of(history, date(2023, 12, 31)).count() == 0


def test_transitions_skip_unranked_plans_and_count_staying_as_down(spark):
    history = spark.createDataFrame(
        [("s", i, plan) for i, plan in enumerate(["basic", "basic", "premium", "gold", "plus"], 1)],
        "subscription_id string, version long, plan_id string",
    )
    rows = {(r.transition, r.direction, r.changes) for r in care.plan_transitions(history).collect()}
    assert rows == {("basic -> basic", "downgrade", 1), ("basic -> premium", "upgrade", 1)}


# -- intervals and sweeps -------------------------------------------------------------------


def _random_intervals(rng, n):
    start = date(2020, 1, 1)
    rows = []
    for i in range(n):
        a = start + timedelta(days=rng.randint(-60, 500))
        b = rng.choice([None, a + timedelta(days=rng.randint(-5, 200))])
        rows.append((i, rng.choice("ab"), a, b, rng.choice([None, 49, 99])))
    return rows


INTERVALS = "id int, g string, a date, b date, m int"


def test_sweep_equals_looking_at_each_day(spark):
    rows = _random_intervals(random.Random(3), 300)
    df = spark.createDataFrame(rows, INTERVALS)
    first, last, today = date(2020, 1, 1), max(r[2] for r in rows), date(2021, 6, 1)
    ends = F.coalesce("b", F.lit(today))
    swept = active_by_day(df, F.col("a"), ends, F.col("m"), first, "d")
    expected = set()
    for i in range((last - first).days + 1):
        d = first + timedelta(days=i)
        on = [r for r in rows if r[2] <= d < (r[3] or today)]
        priced = [r[4] for r in on if r[4] is not None]
        expected.add((d, len(on), len(priced), sum(priced)))
    assert {tuple(r) for r in swept.collect()} == expected


def test_grouped_sweep_equals_looking_at_each_day(spark):
    rows = _random_intervals(random.Random(4), 200)
    df = spark.createDataFrame(rows, INTERVALS)
    days_list = [date(2019, 12, 1) + timedelta(days=i) for i in range(0, 700) if i % 10]
    days = spark.createDataFrame([(d,) for d in days_list], "d date")
    swept = active_by_group(df, F.col("a"), F.col("b"), F.col("m"), days, "d", "g")
    low, high = min(r[2] for r in rows), max(r[3] or r[2] for r in rows)
    expected = set()
    for d in days_list:
        for g in "ab":
            on = [r for r in rows if r[1] == g and r[2] <= d and (r[3] is None or d < r[3])]
            if on and low <= d <= high:
                priced = [r[4] for r in on if r[4] is not None]
                expected.add((d, g, len(on), len(priced), sum(priced)))
    assert {(r.d, r.g, r.active, r.priced, r.amount) for r in swept.collect()} == expected


@pytest.mark.parametrize(("since", "until"), [("2020-01-01", "2021-06-01"), ("2020-06-01", "2020-07-01"), ("1950-01-01", "1960-01-01")])
def test_covering_periods_whatever_the_slices(spark, since, until):
    rng = random.Random(5)
    periods = [(*r[:4], None) for r in _random_intervals(rng, 80)]
    points = [(i, rng.choice(["a", "b", "c", None]), date(2019, 10, 1) + timedelta(days=rng.randint(0, 900))) for i in range(200)]
    joined = join_covering(
        spark.createDataFrame(points, "row int, g string, at date"),
        spark.createDataFrame(periods, INTERVALS).drop("m").withColumnRenamed("id", "period"),
        "g", "at", "a", "b", since=day(since), until=day(until), slice_days=50,
    )
    expected = set()
    for row, g, at in points:
        hits = {p[0] for p in periods if g and p[1] == g and p[2] <= at and (p[3] is None or at < p[3])}
        expected |= {(row, h) for h in hits or {None}}
    actual = joined.select("row", "period").collect()
    assert {tuple(r) for r in actual} == expected and len(actual) == len(expected)


def test_revenue_with_no_active_day_and_days_before_the_calendar(spark):
    subs = spark.createDataFrame(
        [("1", day("2023-12-01"), day("2024-01-02"), 100), ("2", day("2024-01-05"), day("2024-01-05"), 50), ("3", day("2024-01-04"), None, 99)],
        "subscription_id string, started_at date, cancelled_at date, mrr_amount int",
    )
    rows = care.fct_mrr_daily(subs, date(2024, 6, 1), date(2024, 1, 1)).collect()
    assert [(r.calendar_date.day, r.active_subscriptions, r.mrr, r.arr, r.arpu) for r in rows] == [
        (1, 1, 100, 1200.0, 100.0), (2, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0), (4, 1, 99, 1188.0, 99.0), (5, 1, 99, 1188.0, 99.0),
    ]


# -- attribution ----------------------------------------------------------------------------


def test_touches_resolve_by_name_then_by_anonymous_id(spark):
    touches = spark.createDataFrame(
        [
            ("1", "x", None, "ads", "c1", 1.255, moment("2024-01-02 00:00:00")),
            ("2", "x", "p1", "mail", "c2", 2.0, moment("2024-01-03 00:00:00")),
            ("3", "unknown", None, "lost", "c3", 9.0, moment("2024-01-01 00:00:00")),
            ("4", "shared", None, "web", "c4", 4.0, moment("2024-01-01 00:00:00")),
            ("5", None, "p4", None, None, None, None),
            ("6", "x", None, "late", "c6", 0.0, None),
        ],
        "touchpoint_id string, anonymous_id string, patient_id string, channel string, campaign string, cost double, event_at timestamp_ntz",
    )
    patients = spark.createDataFrame(
        [("p1", "x"), ("p2", "shared"), ("p3", "shared"), ("p4", "q")], "patient_id string, anonymous_id string"
    )
    rows = {r.patient_id: r for r in care.attribution(touches, patients).collect()}
    assert set(rows) == {"p1", "p2", "p3", "p4"}
    one = rows["p1"]
    assert (one.touch_count, one.first_touch_channel, one.last_touch_channel) == (3, "ads", "mail")
    assert one.total_marketing_cost == 3.26
    assert rows["p2"].touch_count == rows["p3"].touch_count == 1
    assert (rows["p4"].first_touch_at, rows["p4"].touch_count) == (None, 1)


def test_cost_counts_once_per_subscription(spark):
    attributed = spark.createDataFrame(
        [("p1", 10.0, "ads", "c"), ("p2", 5.0, "ads", "c"), ("p3", 7.0, None, "c")],
        "patient_id string, total_marketing_cost double, first_touch_channel string, first_touch_campaign string",
    )
    subs = spark.createDataFrame(
        [("p1", True, 49), ("p1", False, 99), (None, True, 199)], "patient_id string, is_active boolean, mrr_amount int"
    )
    (row,) = care.mart_marketing_attribution(attributed, subs).collect()
    assert (row.signups, row.subscribers, row.active_subscribers, row.total_spend) == (3, 2, 1, 25.0)
    assert (row.cac_per_signup, row.cac_per_subscriber, row.active_mrr) == (8.33, 12.5, 49)


# -- merging and snapshots ------------------------------------------------------------------

STATE = "id string, v string, updated_at timestamp_ntz"


def _state(spark, *rows):
    return spark.createDataFrame([(i, v, moment(f"2024-01-{d:02} 00:00:00") if d else None) for i, v, d in rows], STATE)


def _pairs(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_merge_takes_the_latest_copy_and_repeats_safely(spark):
    target = _state(spark, ("a", "old", 1), ("b", "old", 1))
    delta = _state(spark, ("b", "mid", 2), ("b", "new", 3), ("c", "new", 2), ("c", "none", None))
    once = versions.merge_by_key(target, delta, ["id"], "updated_at")
    assert _pairs(once) == [("a", "old"), ("b", "new"), ("c", "new")]
    assert _pairs(versions.merge_by_key(once, delta, ["id"], "updated_at")) == _pairs(once)


def test_cursor_is_strict_unless_looking_back(spark):
    target = _state(spark, ("a", "old", 5))
    source = _state(spark, ("a", "same cursor", 5), ("b", "late", 4), ("c", "new", 6))
    assert _pairs(versions.refresh_incrementally(target, source, ["id"], "updated_at")) == [("a", "old"), ("c", "new")]
    since = versions.cursor_of(target, "updated_at").scalar()
    assert _pairs(versions.rows_after(source, "updated_at", since, lookback_days=2)) == [("a", "same cursor"), ("b", "late"), ("c", "new")]


def test_first_run_takes_all_and_text_cursors_order_as_times(spark):
    empty = _state(spark).withColumn("updated_at", F.col("updated_at").cast("string"))
    source = spark.createDataFrame([("a", "x", "2024-01-10 00:00:00"), ("a", "y", "2024-1-9 00:00:00")], "id string, v string, updated_at string")
    assert _pairs(versions.refresh_incrementally(empty, source, ["id"], "updated_at")) == [("a", "x")]


def test_batches_by_cursor_equal_one_full_build(spark):
    source = _state(spark, *[(f"k{i % 7}", f"v{i}", i) for i in range(1, 29)])
    stored = _state(spark)
    for until in (9, 9, 15, 28):
        arrived = source.filter(F.col("updated_at") <= F.lit(moment(f"2024-01-{until:02} 00:00:00")))
        stored = versions.refresh_incrementally(stored, arrived, ["id"], "updated_at")
    assert _pairs(stored) == _pairs(versions.latest_per_key(source, ["id"], "updated_at"))


SUBS = "id string, plan string, price int, note string"


def _take(spark, previous, rows, day_of_month):
    return versions.snapshot(spark.createDataFrame(rows, SUBS), previous, "id", ["plan", "price"], f"2024-01-{day_of_month:02} 00:00:00")


def _versions(df):
    return sorted((r.id, r.plan, r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in df.collect())


def test_snapshot_over_four_runs(spark):
    s = _take(spark, None, [("a", "x", 1, "n"), ("b", "x", None, "n"), ("c", "x", 1, "n")], 1)
    # a changes, b stays NULL, c goes, d is new; the note is not watched.
    s = _take(spark, s, [("a", "y", 1, "n"), ("b", "x", None, "other"), ("d", "x", 1, "n")], 2)
    # c comes back, b gets a price.
    s = _take(spark, s, [("a", "y", 1, "n"), ("b", "x", 5, "n"), ("c", "x", 1, "n"), ("d", "x", 1, "n")], 3)
    expected = [
        ("a", "x", 1, 2), ("a", "y", 2, None), ("b", "x", 1, 3), ("b", "x", 3, None),
        ("c", "x", 1, 2), ("c", "x", 3, None), ("d", "x", 2, None),
    ]
    assert _versions(s) == expected
    again = _take(spark, s, [("a", "y", 1, "n"), ("b", "x", 5, "n"), ("c", "x", 1, "n"), ("d", "x", 1, "n")], 4)
    assert _versions(again) == expected
    ids = [r.version_id for r in again.collect()]
    assert len(ids) == len(set(ids))


# -- checks ---------------------------------------------------------------------------------


def test_checks_and_nulls(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), (None, "y"), ("b", "z")], "k string, v string")
    assert [tuple(r) for r in quality.not_unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.not_unique(df, "k", "v", ignore_nulls=False).collect()] == [(None, "y", 2)]
    assert quality.null_rows(df, "k").count() == 2
    assert {tuple(r) for r in quality.unaccepted_values(df, "v", ["x"]).collect()} == {("y", 2), ("z", 1)}
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert [tuple(r) for r in quality.orphans(df, "k", parent, "p").collect()] == [("b", 1)]
    # An expression that is NULL passes.
    assert quality.false_rows(df, "v < 'y'").count() == 3
    assert quality.false_rows(df, "v < 'y'", "k IS NOT NULL").count() == 1


def test_cells_of_four_and_five_patients(spark):
    def cell(zip3, n):
        return [("p%d" % i, "18-34", "F", None, "e", "S", zip3) for i in range(n)] * 2

    df = spark.createDataFrame(cell("021", 4) + cell("022", 5), "patient_id string, age_band string, gender string, race string, ethnicity string, state string, zip3 string")
    assert [(r.zip3, r.k) for r in quality.small_cells(df).collect()] == [("021", 4)]


def test_overlaps_and_touching_periods(spark):
    df = spark.createDataFrame(
        [("p", 1, day("2001-01-01"), day("2002-01-01")), ("p", 2, day("2002-01-01"), day("2003-01-02")), ("p", 3, day("2003-01-01"), None), ("p", 4, day("2000-01-01"), None)],
        "patient_id string, payer_period_seq long, valid_from date, valid_to date",
    )
    assert [r.payer_period_seq for r in quality.overlapping_periods(df).collect()] == [2]


def test_freshness_levels(spark):
    def table(text):
        return spark.createDataFrame([(text,)], "t string"), "t"

    rows = quality.freshness(
        {"new": table("2024-01-02 12:00:00"), "edge": table("2024-01-02 00:00:00"), "old": table("2024-01-01 00:00:00"), "older": table("2023-12-31 11:59:59"), "empty": table(None)},
        "2024-01-03 12:00:00",
    ).collect()
    assert [(r.table_name, r.status) for r in rows] == [("new", "pass"), ("edge", "pass"), ("old", "warn"), ("older", "error"), ("empty", "error")]


def test_banned_columns_match_exactly(spark):
    catalogue = spark.createDataFrame(
        [("raw", "t", "SSN"), ("raw", "t", "ssn_hash"), ("raw", "t", "zip"), ("marts", "Dim_x", "ZIP"), ("marts", "fct_x", "email"), ("x", "mart_y", "first")],
        "table_schema string, table_name string, column_name string",
    )
    found = quality.banned_columns(catalogue, privacy.registry(spark)).collect()
    assert {(r.violation, r.table_name, r.column_name) for r in found} == {
        ("direct_identifier_present", "t", "ssn"),
        ("quasi_identifier_in_serving_layer", "Dim_x", "zip"),
        ("direct_identifier_present", "mart_y", "first"),
    }


def test_declared_checks_report_severity(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1)], "k string, v int")
    checks = {
        "t": (
            quality.Check("unique", ("k",)),
            quality.Check("not_null", ("v",)),
            quality.Check("expression", expression="v >= 0", severity="warn"),
        )
    }
    rows = quality.run_checks(checks, {"t": df}).collect()
    assert {(r.check_name, r.failures, r.status) for r in rows} == {
        ("unique(k)", 1, "error"), ("not_null(v)", 0, "pass"), ("expression(v >= 0)", 1, "warn"),
    }


# -- dashboards -----------------------------------------------------------------------------


def test_rates_over_nothing_are_null(spark):
    none = spark.createDataFrame([], "status string, is_no_show boolean, is_completed boolean, lead_time_days long")
    assert tuple(bi.appointment_kpis(none).first()) == (0, None, None, None)


def test_unknown_status_is_not_held(spark):
    df = spark.createDataFrame(
        [(None, True, False, 1), ("scheduled", False, False, 2), ("no_show", True, False, 3)],
        "status string, is_no_show boolean, is_completed boolean, lead_time_days long",
    )
    assert tuple(bi.appointment_kpis(df).first()) == (1, 1.0, 0.0, 3.0)


def test_channel_patterns(spark):
    df = spark.createDataFrame(
        [("google", "b", 3, 1, 10.0, 49), ("email", "b", 1, 0, 2.5, None)],
        "channel string, campaign string, signups long, subscribers long, total_spend double, active_mrr long",
    )
    assert tuple(bi.marketing_kpis(df).first()) == (4, 1, 12.5, 3.125, 49)
    assert tuple(bi.marketing_kpis(df, "email").first()) == (1, 0, 2.5, 2.5, None)
    assert [r.channel for r in bi.marketing_by_channel(df, "%o%").collect()] == ["google"]
    assert [r.channel for r in bi.channels(df).collect()] == ["email", "google"]


def test_busiest_timelines(spark):
    df = spark.createDataFrame(
        [(s, v, "basic", 49, None, None, True) for s, n in (("a", 1), ("b", 3), ("c", 2), ("d", 2)) for v in range(1, n + 1)],
        "subscription_id string, version int, plan_id string, mrr_amount int, valid_from date, valid_to date, is_current boolean",
    )
    assert [(r.subscription_id, r.version) for r in bi.busiest_timelines(df, 2).collect()] == [("b", 1), ("b", 2), ("b", 3), ("c", 1), ("c", 2)]


def test_keys_are_only_shuffled_whole_where_one_may_repeat(spark):
    unique, pair = quality.Check("unique", ("k",)), quality.Check("unique_combination", ("k", "v"))
    alone = spark.createDataFrame([("a", 1), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    twice = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    found = quality.run_checks({"alone": (unique, pair), "twice": (unique, pair)}, {"alone": alone, "twice": twice})
    assert {(r.table_name, r.check_name): r.failures for r in found.collect()} == {
        ("alone", "unique(k)"): 0, ("alone", "unique_combination(k, v)"): 0,
        ("twice", "unique(k)"): 2, ("twice", "unique_combination(k, v)"): 2,
    }
    clean = quality.run_checks({"alone": (unique, pair)}, {"alone": alone})
    assert "hashpartitioning(k" not in clean._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in found._jdf.queryExecution().executedPlan().toString()
