"""Landing, stored states, published files and streams, through real files and tables."""

from __future__ import annotations

import time
from datetime import datetime
from random import Random

import pytest
from pyspark.sql import functions as F

from caremill.functions import privacy
from caremill.plans import quality
from caremill.plans.models import TABLES, Models, publish_tables
from caremill.session import RELEASE
from caremill.sources import landing, stored
from caremill.sources.artifacts import artifact_columns, file_footers
from caremill.sources.bindings import RawTables
from caremill.streaming.sync import append_stream, arriving, merge_stream
from compare import plan_of

STAMP = "2024-05-01 00:00:00"


@pytest.fixture
def root(tmp_path) -> str:
    return str(tmp_path)


def _write(path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


# -- landing --------------------------------------------------------------------------------


def test_care_files_land_as_text(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_care")
    _write(tmp_path / "providers.csv", "provider_id,provider_name,specialty,created_at\n007,\"Dr. A, B\",,2024-01-01 10:00:00\n")
    for _ in range(2):
        assert landing.land_care(spark, str(tmp_path), "raw_care", STAMP) == ["providers"]
    row = spark.table("raw_care.providers").first()
    assert (row.provider_id, row.provider_name, row.specialty) == ("007", "Dr. A, B", None)
    assert (row.created_at, row._loaded_at) == ("2024-01-01 10:00:00", datetime(2024, 5, 1))
    assert spark.table("raw_care.providers").count() == 1


def test_clinical_folders_land_without_identifiers(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_clinical")
    header = "Id,BIRTHDATE,ZIP,SSN,First,LAT\n"
    _write(tmp_path / "patients" / "1.csv", header + "a,1990-01-01,02139,1,Ann,1.5\n")
    _write(tmp_path / "patients" / "2.csv", header + "b,1991-01-01,00501,2,Bob,2.5\n")
    _write(tmp_path / "patients" / "notes.txt", "not a table\n")
    (tmp_path / "payers").mkdir()
    assert landing.land_clinical(spark, str(tmp_path), "raw_clinical", STAMP) == ["synthea_patients"]
    table = spark.table("raw_clinical.synthea_patients")
    assert table.columns == ["Id", "BIRTHDATE", "ZIP", "_loaded_at"]
    assert sorted(r.ZIP for r in table.collect()) == ["00501", "02139"]
    catalogue = quality.warehouse_catalogue(spark, ["raw_clinical"])
    assert quality.banned_columns(catalogue, privacy.registry(spark)).count() == 0


def test_unexpected_header_is_refused(spark, tmp_path):
    _write(tmp_path / "providers.csv", "provider_id,name,specialty,created_at\n1,a,b,c\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_text_csv(spark, str(tmp_path / "providers.csv"), landing.CARE_TABLES["providers"]).collect()


def test_quotes_line_breaks_and_short_rows(spark, tmp_path):
    _write(tmp_path / "a.csv", 'k,v\n1,"say ""hi"", twice"\n2,"two\nlines"\n')
    rows = landing.read_text_csv(spark, str(tmp_path / "a.csv"), line_breaks=True).collect()
    assert [tuple(r) for r in rows] == [("1", 'say "hi", twice'), ("2", "two\nlines")]
    _write(tmp_path / "b.csv", "k,v,w\n1,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_text_csv(spark, str(tmp_path / "b.csv")).collect()


def test_registry_file(spark, tmp_path):
    _write(tmp_path / "registry.csv", "column_name,tier,rationale\n SSN ,1,id\nzip,2,input\nfax,,id\n,1,blank\n")
    registry = privacy.read_registry(spark, str(tmp_path / "registry.csv"))
    assert privacy.direct_identifiers(registry) == {"ssn", "fax"}
    df = spark.createDataFrame([(1, 2, 3)], "Ssn int, zip int, FAX int")
    assert landing.drop_identifiers(df, privacy.direct_identifiers(registry)).columns == ["zip"]


# -- published files ------------------------------------------------------------------------


def test_columns_and_rows_of_published_files(spark, root):
    spark.range(3).withColumnRenamed("id", "ZIP").write.parquet(f"{root}/build/deep/dim_a")
    spark.range(3).write.parquet(f"{root}/build/fct_b")
    spark.range(3).select("id", F.lit("x").alias("Phone")).write.mode("append").parquet(f"{root}/build/fct_b")
    # Types that do not merge.
    spark.range(3).select(F.col("id").cast("string"), F.lit(1).alias("lat")).write.mode("append").parquet(f"{root}/build/fct_b")
    spark.range(4).select("id", (F.col("id") % 2).alias("fax")).write.partitionBy("fax").parquet(f"{root}/build/mart c")
    columns = artifact_columns(spark, f"{root}/build")
    assert {(r.artifact, r.column_name, r.rows) for r in columns.collect()} == {
        ("dim_a", "ZIP", 3), ("fct_b", "id", 9), ("fct_b", "Phone", 3), ("fct_b", "lat", 3), ("mart c", "id", 4), ("mart c", "fax", 4),
    }
    found = quality.banned_artifact_columns(columns, privacy.registry(spark))
    assert {(r.artifact, r.column_name) for r in found.collect()} == {
        ("dim_a", "zip"), ("fct_b", "phone"), ("fct_b", "lat"), ("mart c", "fax"),
    }
    footers = file_footers(spark, f"{root}/build").collect()
    assert sum(r.rows for r in footers) == 16 and all(r.path.endswith(".parquet") for r in footers)


def test_no_published_files_pass(spark, tmp_path):
    (tmp_path / "build").mkdir()
    assert artifact_columns(spark, str(tmp_path / "build")).count() == 0


# -- stored states --------------------------------------------------------------------------

STATE = "id string, v string, updated_at timestamp_ntz"


def _state(spark, *rows):
    return spark.createDataFrame([(i, v, datetime(2024, 1, d)) for i, v, d in rows], STATE)


def _pairs(df):
    return sorted((r.id, r.v) for r in df.collect())


def _read(spark, root):
    return stored.read_stored(spark, root, ["id"], "updated_at")


def _moved(spark, root, run):
    return spark.read.schema(STATE).parquet(f"{root}/delta/_run={run}").count()


def test_merge_sync_moves_only_changes_and_repeats_safely(spark, root):
    assert _read(spark, root) is None
    stored.sync_merge(_state(spark, ("a", "1", 1), ("b", "0", 1), ("b", "1", 2)), root, ["id"], "updated_at")
    assert _pairs(_read(spark, root)) == [("a", "1"), ("b", "1")]
    later = _state(spark, ("a", "1", 1), ("b", "2", 3), ("c", "1", 4), ("late", "1", 2))
    assert [stored.sync_merge(later, root, ["id"], "updated_at") for _ in range(2)] == [2, 2]
    assert _pairs(_read(spark, root)) == [("a", "1"), ("b", "2"), ("c", "1")]
    stored.sync_merge(_state(spark, ("c", "2", 5)), root, ["id"], "updated_at")
    assert _moved(spark, root, 3) == 1
    assert _pairs(_read(spark, root)) == [("a", "1"), ("b", "2"), ("c", "2")]


def test_compacting_changes_nothing_to_the_reader(spark, root):
    for day in range(1, 6):
        stored.sync_merge(_state(spark, ("a", str(day), day), (f"k{day}", "1", day)), root, ["id"], "updated_at")
    before = _pairs(_read(spark, root))
    stored.compact(spark, root, ["id"], "updated_at")
    state = stored.finished(spark, root)
    assert (state.version, state.base, state.last_value) == (5, 5, datetime(2024, 1, 5))
    assert _pairs(_read(spark, root)) == before
    stored.sync_merge(_state(spark, ("a", "6", 6)), root, ["id"], "updated_at")
    assert ("a", "6") in _pairs(_read(spark, root))


def test_half_written_run_is_ignored_and_overwritten(spark, root):
    stored.publish(_state(spark, ("a", "1", 1)), root, "updated_at")
    _state(spark, ("x", "torn", 9)).write.parquet(f"{root}/delta/_run=2")
    assert _pairs(_read(spark, root)) == [("a", "1")]
    stored.sync_merge(_state(spark, ("b", "2", 2)), root, ["id"], "updated_at")
    assert _pairs(_read(spark, root)) == [("a", "1"), ("b", "2")]


def test_replace_sync(spark, root):
    for value in ("1", "2"):
        stored.sync_replace(_state(spark, ("a", value, 1)), root)
    assert _pairs(stored.read_stored(spark, root)) == [("a", "2")]


def test_append_sync(spark, root):
    for rows in ([("a", "1", 1), ("b", "1", 2)], [("a", "1", 1), ("b", "1", 2), ("late", "1", 1), ("c", "1", 3)]):
        stored.sync_append(_state(spark, *rows), root, "updated_at")
    assert _pairs(stored.read_appended(spark, root)) == [("a", "1"), ("b", "1"), ("c", "1")]
    assert stored.sync_append(_state(spark, ("c", "1", 3)), root, "updated_at") == 2


class Died(Exception):
    pass


def _dying(monkeypatch, step):
    """Lets the given number of writes through, then fails once, before the next one."""
    from pyspark.sql.readwriter import DataFrameWriter

    real, count = DataFrameWriter.parquet, [0]

    def write(self, path, *args, **more):
        count[0] += 1
        if count[0] == step + 1:
            raise Died(path)
        return real(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    return count


@pytest.mark.parametrize("step", range(4))
def test_append_dies_anywhere_and_is_repeated(spark, root, monkeypatch, step):
    stored.sync_append(_state(spark, ("a", "1", 1), ("b", "1", 2)), root, "updated_at")
    more = _state(spark, ("b", "1", 2), ("c", "1", 3), ("d", "1", 4))
    with monkeypatch.context() as patch:
        _dying(patch, step)
        if step < 3:
            with pytest.raises(Died):
                stored.sync_append(more, root, "updated_at")
            assert _pairs(stored.read_appended(spark, root)) == [("a", "1"), ("b", "1")]
    for _ in range(2):
        stored.sync_append(more, root, "updated_at")
    assert _pairs(stored.read_appended(spark, root)) == [("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")]
    assert stored.finished(spark, root).last_value == datetime(2024, 1, 4)


def test_recent_rows_open_only_files_that_hold_some(spark, root):
    for day in range(1, 5):
        stored.sync_append(_state(spark, ("k", str(day), day)).coalesce(1), root, "updated_at")
    files = {r.rows: (r.lowest, r.highest) for r in stored.appended_files(spark, root).collect()}
    assert set(files) == {1}
    recent = stored.read_appended(spark, root, "updated_at", datetime(2024, 1, 2))
    assert _pairs(recent) == [("k", "3"), ("k", "4")] and len(recent.inputFiles()) == 2
    assert stored.read_appended(spark, root, "updated_at", datetime(2025, 1, 1)).count() == 0


def test_cursor_comes_from_the_log_alone(spark, root):
    assert stored.cursor_in_log(spark, root).first()[0] == datetime(1970, 1, 1)
    stored.sync_append(_state(spark, ("a", "1", 5)), root, "updated_at")
    state = stored.cursor_in_log(spark, root)
    assert state.first()[0] == datetime(2024, 1, 5) and all("/log/" in f for f in state.inputFiles())


def _fact(spark, *rows):
    return spark.createDataFrame(
        [(i, v, datetime(2024, 1, d), m) for i, v, d, m in rows], "id string, v string, updated_at timestamp_ntz, month string"
    )


def _refresh(spark, root, *rows):
    return stored.refresh_partitions(_fact(spark, *rows), root, ["id"], "updated_at", "month")


def _facts(spark, root):
    return sorted(((r.id, r.v, r.month) for r in stored.read_partitioned(spark, root).collect()), key=str)


def test_partitions_are_rewritten_only_where_rows_change(spark, root):
    assert _refresh(spark, root, ("a", "1", 1, "m1"), ("b", "1", 1, "m1"), ("c", "1", 1, "m2"), ("d", "1", 1, "m3")) == 1
    # c moves from m2, which empties, to m3; e is new in a new month, and one without a month; keys may be NULL.
    later = [("a", "unseen", 1, "m1"), ("c", "2", 2, "m3"), ("e", "2", 2, "m 4:/="), ("f", "2", 2, None), (None, "2", 2, "m3")]
    assert _refresh(spark, root, *later) == 2
    wanted = [("a", "1", "m1"), ("b", "1", "m1"), ("c", "2", "m3"), ("d", "1", "m3"), ("e", "2", "m 4:/="), ("f", "2", None)]
    assert _facts(spark, root) == sorted([*wanted, (None, "2", "m3")], key=str)
    assert "is-m1" in stored.in_force(spark, root)[1] and "is-m1" not in stored.in_force(spark, root)[2]
    assert _refresh(spark, root, *later) == 2
    assert _refresh(spark, root, (None, "3", 3, "m3"), ("e", "3", 3, "m 4:/=")) == 3
    wanted = [*wanted[:4], ("e", "3", "m 4:/="), wanted[5], (None, "3", "m3")]
    assert _facts(spark, root) == sorted(wanted, key=str)
    # m2 and m3 of the first run, m3 and m 4 of the second, were replaced; the emptied m2 has no folder.
    assert stored.drop_replaced(spark, root) >= 3
    assert _facts(spark, root) == sorted(wanted, key=str)
    assert [r.id for r in stored.read_partitioned(spark, root, ["is-m1"]).orderBy("id").collect()] == ["a", "b"]


@pytest.mark.parametrize("step", range(3))
def test_refresh_dies_between_any_two_steps_and_is_repeated(spark, root, monkeypatch, step):
    _refresh(spark, root, ("a", "1", 1, "m1"), ("b", "1", 1, "m1"), ("c", "1", 1, "m2"))
    before = _facts(spark, root)
    changes = [("a", "2", 2, "m1"), ("c", "2", 2, "m1"), ("d", "2", 3, "m3")]
    with monkeypatch.context() as patch:
        _dying(patch, step)
        with pytest.raises(Died):
            _refresh(spark, root, *changes)
    assert _facts(spark, root) == before
    # The source has moved on when the run is repeated.
    assert _refresh(spark, root, *changes, ("e", "2", 3, "m2")) == 2 == _refresh(spark, root, *changes)
    assert _facts(spark, root) == [("a", "2", "m1"), ("b", "1", "m1"), ("c", "2", "m1"), ("d", "2", "m3"), ("e", "2", "m2")]


def test_refresh_dies_before_its_log_line_and_is_repeated(spark, root, monkeypatch):
    _refresh(spark, root, ("a", "1", 1, "m1"), ("b", "1", 1, "m1"), ("c", "1", 1, "m2"))
    before = _facts(spark, root)
    with monkeypatch.context() as patch:
        # After the changed rows, the places of those they replace, and the rows that stay.
        _dying(patch, 3)
        with pytest.raises(Died):
            _refresh(spark, root, ("a", "2", 2, "m2"))
    assert _facts(spark, root) == before
    # Another month is touched when the run is repeated, by a session that replaces written folders one by one.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert _refresh(spark, root, ("b", "2", 2, "m3")) == 2
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert _facts(spark, root) == [("a", "1", "m1"), ("b", "2", "m3"), ("c", "1", "m2")]


def test_first_build_dies_and_is_repeated(spark, root, monkeypatch):
    for step in range(2):
        with monkeypatch.context() as patch:
            _dying(patch, step)
            with pytest.raises(Died):
                _refresh(spark, root, ("a", "1", 1, "m1"))
        assert stored.read_partitioned(spark, root) is None
    assert _refresh(spark, root, ("a", "1", 1, "m1")) == 1 and _facts(spark, root) == [("a", "1", "m1")]


@pytest.fixture
def plans(monkeypatch):
    """The paths and plans of what is written."""
    from pyspark.sql.readwriter import DataFrameWriter

    real, seen = DataFrameWriter.parquet, []

    def write(self, path, *args, **more):
        seen.append((path, plan_of(self._df)))
        return real(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    return seen


def test_refresh_shuffles_keys_and_changed_rows_only(spark, root, plans):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _refresh(spark, root, *[(str(i), "1", 1, f"m{i % 3}") for i in range(30)])
        plans.clear()
        assert _refresh(spark, root, ("4", "2", 2, "m1"), ("7", "2", 2, "m0"), ("31", "2", 2, "m2")) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    changes, places, kept, log = plans
    assert "/data/_run=2" in changes[0] and "/replaced/_run=2" in places[0] and "/data/_run=2" in kept[0] and "/log" in log[0]
    assert "hashpartitioning(coalesce(id" in places[1] and ",v#" not in places[1]
    # Stored rows are read and written as they lie.
    assert "hashpartitioning" not in kept[1] and "rangepartitioning" not in kept[1]
    rows = {i: ("1", f"m{i % 3}") for i in range(30)} | {4: ("2", "m1"), 7: ("2", "m0"), 31: ("2", "m2")}
    assert _facts(spark, root) == sorted([(str(i), *v) for i, v in rows.items()], key=str)


@pytest.mark.parametrize(("per_pass", "spare", "lookback_days"), [(4_096, 2, 0), (1, 2, 0), (1, -1_000, 0), (1, 2, 40)])
def test_refresh_equals_replacing_rows_one_by_one(spark, root, monkeypatch, per_pass, spare, lookback_days):
    monkeypatch.setattr(stored, "BITMAPS_PER_PASS", per_pass)
    monkeypatch.setattr(stored, "SPARE_FILES", spare)
    random = Random(7)

    def some(n, version, days):
        return [
            (random.choice([None, *map(str, range(60))]), f"{version}-{i}", random.choice(days), random.choice(["m1", "m2", "m3", None]))
            for i in range(n)
        ]

    # Keys repeat, in the stored table and in the changes.
    held, last = some(80, 0, range(1, 9)), 0
    runs = [held, *(some(25, run, range(6 + 4 * run, 12 + 4 * run)) for run in (1, 2)), []]
    for run, rows in enumerate(runs):
        stored.refresh_partitions(_fact(spark, *rows), root, ["id"], "updated_at", "month", lookback_days)
        since = last - lookback_days
        changed = [r for r in rows if r[2] > since] if run else []
        for key in {r[0] for r in changed}:
            # By time, of equal ones what changed, then by the other columns, NULLs last.
            best = max(
                [(r[2], new, r[1], r[3] or "", r) for new, part in ((0, held if lookback_days else []), (1, changed)) for r in part if r[0] == key]
            )[-1]
            held = [r for r in held if r[0] != key] + [best]
        last = max([last, *(r[2] for r in (changed or ([] if run else held)))])
        assert _facts(spark, root) == sorted(((i, v, m) for i, v, _, m in held), key=str)


def test_columns_that_follow_from_others_are_not_shuffled(spark, root, plans):
    def refresh(*rows):
        df = _fact(spark, *rows).withColumn("size", F.length("v"))
        return stored.refresh_partitions(df, root, ["id"], "updated_at", "month", derived={"size": F.length("v")})

    refresh(("a", "1", 1, "m1"), ("b", "22", 1, "m1"))
    refresh(("b", "333", 2, "m2"), ("c", "4444", 2, None))
    changes = next(plan for path, plan in plans if path.endswith("/data/_run=2"))
    assert "length(v" in changes and "length(v" not in changes[changes.index("Exchange") :]
    rows = [tuple(r) for r in stored.read_partitioned(spark, root).select("id", "v", "size").orderBy("id").collect()]
    assert rows == [("a", "1", 1), ("b", "333", 3), ("c", "4444", 4)]


def _shuffle_files(spark) -> int:
    context = spark.sparkContext
    files = context._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def _left(spark, before: int) -> int:
    """Shuffle files beyond those that were there; they are removed in the background."""
    deadline = time.monotonic() + 20
    while _shuffle_files(spark) > before and time.monotonic() < deadline:
        time.sleep(0.2)
    return max(0, _shuffle_files(spark) - before)


def test_no_shuffle_files_outlast_a_written_table(spark, root):
    before, setting = _shuffle_files(spark), spark.conf.get(RELEASE, None)
    rows = spark.range(10_000).select((F.col("id") % 7).alias("k"), "id").repartition(5, "k")
    written = publish_tables(spark, {("s", "t"): rows}, root)[("s", "t")]
    for month in ("m1", "m2"):
        at = F.lit(datetime(2024, 1, int(month[1]))).cast("timestamp_ntz")
        df = rows.select(F.col("id").cast("string"), F.lit(month).alias("v"), at.alias("updated_at"), F.lit(month).alias("month"))
        stored.refresh_partitions(df, f"{root}/fact", ["id"], "updated_at", "month")
    assert _left(spark, before) == 0 and spark.conf.get(RELEASE, None) == setting
    assert written.count() == 10_000 == stored.read_partitioned(spark, f"{root}/fact").count()


def test_checked_tables_leave_no_shuffle_files(spark, root, folder):
    before = _shuffle_files(spark)
    m = Models(RawTables(spark, folder))
    m.publish(root, ["clinical_patients", "encounters"])
    tables = {"stg_ehr__patients": m.clinical_patients, "stg_ehr__encounters": m.encounters}
    suspect = quality._repeated_hashes({t: quality.MODEL_CHECKS[t] for t in tables}, tables)
    assert not suspect and _left(spark, before) == 0
    for file in m.encounters.inputFiles():
        ids = [r.encounter_id for r in spark.read.parquet(file).select("encounter_id").collect()]
        assert ids == sorted(ids)


def test_tables_of_visits_are_written_before_others_and_after_their_parents():
    order = list(TABLES)
    assert order.index("clinical_encounters") < order.index("patients")
    parents = {
        "payer_periods": ("payer_transitions",), "clinical_encounters": ("encounters", "clinical_patients", "payer_periods"),
        "fct_appointments": ("appointments", "providers", "patients"), "dim_patients": ("patients", "touchpoints"),
        "dim_providers": ("providers",), "subscription_history": ("subscription_events", "subscriptions"),
        "fct_mrr_daily": ("subscriptions",), "fct_subscriptions": ("subscriptions", "subscription_events"),
        "marketing": ("touchpoints", "patients", "subscriptions", "subscription_events"),
    }
    assert len(order) == 18 and all(order.index(p) < order.index(child) for child, some in parents.items() for p in some)


def _taken(spark, root):
    return sorted(((r.id, r.plan, r.valid_to is None) for r in stored.read_snapshot(spark, root).collect()), key=str)


def _take(spark, root, rows, at):
    return stored.take_snapshot(spark.createDataFrame(rows, "id string, plan string"), root, "id", ["plan"], at)


def test_stored_snapshot_writes_only_what_opens_and_closes(spark, root):
    def written(part, run):
        return spark.read.schema("version_id string").parquet(f"{root}/{part}/_run={run}").count()

    assert _take(spark, root, [("a", "x"), ("b", "x"), ("c", None), (None, "n")], "2024-01-01 00:00:00") == 1
    assert _taken(spark, root) == sorted([("a", "x", True), ("b", "x", True), ("c", None, True), (None, "n", True)], key=str)
    second = [("a", "y"), ("c", None), (None, "n")]
    assert _take(spark, root, second, "2024-01-02 00:00:00") == 2
    wanted = [("a", "x", False), ("a", "y", True), ("b", "x", False), ("c", None, True), (None, "n", True)]
    assert _taken(spark, root) == sorted(wanted, key=str)
    assert (written("opened", 1), written("opened", 2), written("closed", 2)) == (4, 1, 2)
    # A run without changes writes no row and no log line.
    assert _take(spark, root, second, "2024-01-03 00:00:00") == 2
    # b comes back, c gets a value, NULL goes.
    assert _take(spark, root, [("a", "y"), ("b", "x"), ("c", "")], "2024-01-04 00:00:00") == 3
    wanted = [w if w[0] in ("a", "b") else (*w[:2], False) for w in wanted] + [("b", "x", True), ("c", "", True)]
    assert _taken(spark, root) == sorted(wanted, key=str)


@pytest.mark.parametrize("step", range(4))
def test_snapshot_dies_between_any_two_steps_and_is_repeated(spark, root, monkeypatch, step):
    _take(spark, root, [("a", "x"), ("b", "x")], "2024-01-01 00:00:00")
    before = _taken(spark, root)
    with monkeypatch.context() as patch:
        _dying(patch, step)
        with pytest.raises(Died):
            _take(spark, root, [("a", "y")], "2024-01-02 00:00:00")
    assert _taken(spark, root) == before
    assert _take(spark, root, [("a", "z"), ("b", "x")], "2024-01-03 00:00:00") == 2
    assert _taken(spark, root) == [("a", "x", False), ("a", "z", True), ("b", "x", True)]


def test_null_keys_do_not_multiply(spark, root):
    for value, day in (("1", 1), ("2", 2), ("3", 3)):
        stored.sync_merge(_state(spark, (None, value, day), ("a", value, day)), root, ["id"], "updated_at")
    assert {(r.id, r.v) for r in _read(spark, root).collect()} == {("a", "3"), (None, "3")}
    assert _read(spark, root).count() == 2


# -- streams --------------------------------------------------------------------------------


def test_stream_takes_each_file_once(spark, root):
    for rows in ([("a", "1", 5)], [("late", "1", 1)]):
        _state(spark, *rows).write.mode("append").parquet(f"{root}/in")
        for _ in range(2):
            stream = arriving(spark, f"{root}/in", _state(spark).schema)
            append_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    assert _pairs(spark.read.parquet(f"{root}/out")) == [("a", "1"), ("late", "1")]


def test_stream_merge_over_several_batches(spark, root):
    for rows in ([("a", "1", 1), ("b", "1", 1)], [("a", "2", 2), ("a", "3", 3)], [("c", "1", 4)]):
        _state(spark, *rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = arriving(spark, f"{root}/in", _state(spark).schema, max_files=1)
    merge_stream(stream, f"{root}/out", ["id"], "updated_at", f"{root}/checkpoint").awaitTermination()
    assert _pairs(_read(spark, f"{root}/out")) == [("a", "3"), ("b", "1"), ("c", "1")]


def test_repeated_stream_batch_changes_nothing(spark, root):
    """A batch that failed after publishing is run again by Spark under the same number."""
    _state(spark, ("a", "1", 1)).write.parquet(f"{root}/in")
    for checkpoint in ("first", "second"):
        stream = arriving(spark, f"{root}/in", _state(spark).schema)
        merge_stream(stream, f"{root}/out", ["id"], "updated_at", f"{root}/{checkpoint}").awaitTermination()
    assert stored.finished(spark, f"{root}/out").version == 1
    assert _pairs(_read(spark, f"{root}/out")) == [("a", "1")]
