"""Stored tables that incremental runs bring up to date by writing only what changed.

A merged table is a base and the deltas of later runs, each in a folder of its own, and a log of
finished runs. Reading puts the newest delta rows in place of base rows of the same key; ``compact``
writes that as a new base. No run reads and overwrites the same folder: one that fails half-way
is not in the log, and its retry overwrites what it left. One writer per table is assumed.

Appended logs, snapshots and partitioned tables follow the same rule: a run writes folders that nobody reads yet, and
one line in the log, written last, makes all of them count. The cursor is in that line as well, so a run that
died is run again as if it had not begun, and no data file is opened to find where to go on.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Collection, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from caremill.functions.dates import TIMESTAMP
from caremill.functions.values import row_key
from caremill.operators.versions import (
    EPOCH,
    cursor_of,
    latest_per_key,
    rows_after,
    same_keys,
)
from caremill.session import released, setting

# The last column is the stored cursor: how far the source has been read.
LOG = "version long, base long, last_value timestamp_ntz"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def finished(spark: SparkSession, root: str, below: int | None = None) -> Row | None:
    """Newest version, its base and its cursor, or None before the first run."""
    try:
        log = spark.read.schema(LOG).parquet(f"{root}/log")
    except AnalysisException as error:
        if _missing(error):
            return None
        raise
    if below is not None:
        log = log.filter(F.col("version") < below)
    # One whole line: the newest version, and of lines with one version the newest base.
    newest = log.agg(F.max(F.struct(*log.columns)).alias("line")).select("line.*").first()
    return None if newest.version is None else newest


def _finish(spark: SparkSession, root: str, version: int, base: int, last_value) -> int:
    line = spark.createDataFrame([(version, base, last_value)], LOG)
    line.coalesce(1).write.mode("append").parquet(f"{root}/log")
    return version


def publish(df: DataFrame, root: str, cursor: str | None = None, version: int | None = None) -> int:
    """Store a table as a whole, as a new base."""
    spark = df.sparkSession
    if version is None:
        state = finished(spark, root)
        version = state.version + 1 if state else 1
    df.write.mode("overwrite").parquet(f"{root}/base-{version}")
    written = spark.read.parquet(f"{root}/base-{version}")
    last_value = cursor_of(written, cursor).first()[0] if cursor else None
    return _finish(spark, root, version, version, last_value)


def read_stored(
    spark: SparkSession, root: str, keys: list[str] | None = None, cursor: str | None = None, below: int | None = None
) -> DataFrame | None:
    """The table as of its newest finished run. The base is not shuffled while the keys of the
    deltas are few enough for Spark to broadcast them."""
    state = finished(spark, root, below)
    if state is None:
        return None
    base = spark.read.parquet(f"{root}/base-{state.base}")
    if state.version == state.base:
        return base
    runs = F.col("_run").between(state.base + 1, state.version)
    schema = StructType([*base.schema.fields, StructField("_run", LongType())])
    deltas = spark.read.schema(schema).parquet(f"{root}/delta").filter(runs)
    # By cursor, then by arrival: a late, older row does not replace a newer one.
    touched = deltas.select(*keys).distinct()
    old = same_keys(base, touched, keys, "left_semi").select(*base.columns, F.lit(0).cast("bigint").alias("_run"))
    newest = latest_per_key(old.unionByName(deltas), keys, cursor, then="_run").select(*base.columns)
    kept = same_keys(base, touched, keys, "left_anti").select(*base.columns)
    return kept.unionByName(newest)


def write_delta(delta: DataFrame, root: str, keys: list[str], cursor: str, version: int, before: Row) -> int:
    """Store the latest delta row of each key as one run; without any there is no new run.
    Returns the newest version."""
    spark, folder = delta.sparkSession, f"{root}/delta/_run={version}"
    latest_per_key(delta, keys, cursor).write.mode("overwrite").parquet(folder)
    reached = spark.read.schema(delta.schema).parquet(folder).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col(cursor).cast(TIMESTAMP)).alias("last_value")
    ).first()
    if not reached.rows:
        return before.version
    known = [v for v in (reached.last_value, before.last_value) if v is not None]
    return _finish(spark, root, version, before.base, max(known, default=None))


def compact(spark: SparkSession, root: str, keys: list[str], cursor: str) -> None:
    """Write base and deltas as a new base of the same version."""
    state = finished(spark, root)
    if state and state.version > state.base:
        read_stored(spark, root, keys, cursor).write.mode("overwrite").parquet(f"{root}/base-{state.version}")
        _finish(spark, root, state.version, state.version, state.last_value)


def sync_replace(source: DataFrame, root: str) -> int:
    """Reload a small reference table as a whole."""
    return publish(source, root)


def sync_merge(source: DataFrame, root: str, keys: list[str], cursor: str, lookback_days: int = 0) -> int:
    """Move what changed past the stored cursor; a repeated run moves nothing."""
    spark = source.sparkSession
    state = finished(spark, root)
    if state is None:
        return publish(latest_per_key(source, keys, cursor), root, cursor)
    delta = rows_after(source, cursor, _literal(state.last_value), lookback_days)
    return write_delta(delta, root, keys, cursor, state.version + 1, state)


def cursor_in_log(spark: SparkSession, root: str) -> DataFrame:
    """One row: how far the source of a stored table has been read, or the epoch before the first run."""
    try:
        log = spark.read.schema(LOG).parquet(f"{root}/log")
    except AnalysisException as error:
        if not _missing(error):
            raise
        log = spark.createDataFrame([], LOG)
    return cursor_of(log, "last_value")


def _literal(last_value):
    """The cursor as a literal (one value), so that the source scan can skip row groups by it."""
    return F.lit(EPOCH if last_value is None else last_value).cast(TIMESTAMP)


# -- appended logs --------------------------------------------------------------------------


def sync_append(source: DataFrame, root: str, cursor: str) -> int:
    """Append the source's rows past the stored cursor as one run; nothing stored is rewritten. The run lists
    its files with the lowest and highest cursor of each. Returns the newest version."""
    spark = source.sparkSession
    state = finished(spark, root)
    version, last_value = (state.version, state.last_value) if state else (0, None)
    folder = f"{root}/rows/_run={version + 1}"
    rows_after(source, cursor, _literal(last_value)).write.mode("overwrite").parquet(folder)
    value = F.col(cursor).cast(TIMESTAMP)
    files = spark.read.schema(source.schema).parquet(folder).groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(value).alias("lowest"), F.max(value).alias("highest")
    )
    files.write.mode("overwrite").parquet(f"{root}/files/_run={version + 1}")
    reached = spark.read.schema(files.schema).parquet(f"{root}/files/_run={version + 1}")
    reached = reached.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("highest").alias("last_value")).first()
    if state and not reached.rows:
        return version
    return _finish(spark, root, version + 1, version + 1, reached.last_value if reached.rows else None)


def appended_files(spark: SparkSession, root: str) -> DataFrame | None:
    """path, rows, lowest and highest cursor of each file of the finished runs."""
    state = finished(spark, root)
    if state is None:
        return None
    return spark.read.parquet(f"{root}/files").filter(F.col("_run") <= state.version).drop("_run")


def read_appended(spark: SparkSession, root: str, cursor: str | None = None, after=None) -> DataFrame | None:
    """The rows of all finished runs, or those past a cursor value: files that hold none of them are not opened."""
    state = finished(spark, root)
    if state is None:
        return None
    every = spark.read.parquet(f"{root}/rows")
    if after is None:
        return every.filter(F.col("_run") <= state.version).drop("_run")
    schema = StructType([field for field in every.schema if field.name != "_run"])
    # As many paths as files are read, which the scan lists anyway.
    paths = [row.path for row in appended_files(spark, root).filter(F.col("highest") > _literal(after)).collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return rows_after(spark.read.schema(schema).parquet(*paths), cursor, _literal(after))


# -- snapshots ------------------------------------------------------------------------------


def _digest(watched: list[str]):
    """Equal for equal values of the watched columns, NULLs being values of their own."""
    return F.md5(F.to_json(F.struct(*watched), {"ignoreNullFields": "false"}))


def _snapshot_part(spark: SparkSession, root: str, part: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/{part}").filter(F.col("_run") <= version).drop("_run")


def take_snapshot(current: DataFrame, root: str, key: str, watched: list[str], run_at: str) -> int:
    """Run a snapshot. A run stores the versions that it opens and the ends of those that it closes, and nothing when
    nothing changed. What changed is found by keys and digests alone: whole rows of the source are only
    read again for the versions that open. Returns the newest version."""
    spark = current.sparkSession
    state = finished(spark, root)
    run = state.version + 1 if state else 1
    now = F.lit(run_at).cast(TIMESTAMP)
    new = current.select(F.col(key).alias("_new"), _digest(watched).alias("_new_digest"), F.lit(True).alias("_here"))
    if state is None:
        changes = new.withColumn("version_id", F.lit(None).cast("string"))
    else:
        opened, closed = (_snapshot_part(spark, root, part, state.version) for part in ("opened", "closed"))
        still_open = opened.join(closed, "version_id", "left_anti").select(F.col(key).alias("_old"), "version_id", "_digest")
        changes = still_open.join(new, F.col("_old").eqNullSafe(F.col("_new")), "full").filter(
            ~F.col("_digest").eqNullSafe(F.col("_new_digest"))
        )
    # Written first: both parts of the run come from one reading of the source's keys.
    changes.select("version_id", "_new", "_here").write.mode("overwrite").parquet(f"{root}/changes/_run={run}")
    changes = spark.read.schema(changes.select("version_id", "_new", "_here").schema).parquet(f"{root}/changes/_run={run}")
    if state and changes.isEmpty():
        return state.version
    opening = same_keys(current, changes.filter("_here").select(F.col("_new").alias(key)).distinct(), [key], "left_semi")
    opening = opening.withColumn("valid_from", now).withColumns(
        {"version_id": row_key(key, "valid_from"), "_digest": _digest(watched)}
    )
    closing = changes.filter("version_id IS NOT NULL").select("version_id", now.alias("valid_to"))
    opening.write.mode("overwrite").parquet(f"{root}/opened/_run={run}")
    closing.write.mode("overwrite").parquet(f"{root}/closed/_run={run}")
    return _finish(spark, root, run, run, None)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """All versions that finished runs have opened, with the ends of those they have closed."""
    state = finished(spark, root)
    if state is None:
        return None
    opened, closed = (_snapshot_part(spark, root, part, state.version) for part in ("opened", "closed"))
    content = [c for c in opened.columns if c not in ("_digest", "version_id")]
    return opened.join(closed, "version_id", "left").select(*content, "valid_to", "version_id")


# -- partitioned tables ---------------------------------------------------------------------

# The partitions a run has written, and the schema of its rows.
PARTITION_LOG = "version long, last_value timestamp_ntz, touched array<string>, schema string"


def _partition_log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        log = spark.read.schema(PARTITION_LOG).parquet(f"{root}/log")
    except AnalysisException as error:
        if _missing(error):
            return None
        raise
    return None if log.isEmpty() else log


def _place(partition: str):
    """The folder of a partition value."""
    return F.coalesce(F.concat(F.lit("is-"), F.col(partition).cast("string")), F.lit("null"))


def in_force(spark: SparkSession, root: str) -> dict[int, list[str]]:
    """The run that wrote each partition last, as lists by run: as many entries as there are partitions."""
    log = _partition_log(spark, root)
    if log is None:
        return {}
    newest = log.select("version", F.explode("touched").alias("part")).groupBy("part").agg(F.max("version").alias("run"))
    by_run: dict[int, list[str]] = {}
    for row in newest.collect():
        by_run.setdefault(row.run, []).append(row.part)
    return by_run


def _in_place(spark: SparkSession, root: str, parts: list[str] | None = None) -> tuple[DataFrame, list[str]] | None:
    """The rows in force with the folder names they lie in, or only some partition folders of them, and the names of their own
    columns. Folders that a later run has replaced, or that a failed run left, are pruned by name."""
    log = _partition_log(spark, root)
    if log is None:
        return None
    schema = StructType.fromJson(json.loads(log.agg(F.max_by("schema", "version")).first()[0]))
    folders = StructType([*schema.fields, StructField("_run", LongType()), StructField("_part", StringType())])
    here = F.lit(False)
    for run, written in in_force(spark, root).items():
        wanted = written if parts is None else sorted(set(written) & set(parts))
        here = here | ((F.col("_run") == run) & F.col("_part").isin(wanted))
    return spark.read.schema(folders).parquet(f"{root}/data").filter(here), schema.names


def read_partitioned(spark: SparkSession, root: str, parts: list[str] | None = None) -> DataFrame | None:
    """The table as of its last finished run, or only some partition folders of it."""
    found = _in_place(spark, root, parts)
    return found and found[0].select(*found[1])


def _write_parts(
    rows: DataFrame,
    folder: str,
    keys: list[str],
    partition: str,
    derived: Mapping[str, Column] | None,
    mode: str = "overwrite",
) -> None:
    """Write rows to a folder for each partition value, in order of their keys. Rows are dealt out by partition, as one file for
    each task and folder would be too many; adaptive execution splits the folders that are big. ``derived`` columns are computed
    behind that."""
    behind = {name: column for name, column in (derived or {}).items() if name in rows.columns and name != partition}
    dealt = rows.drop(*behind).hint("rebalance", F.col(partition)).withColumns(behind)
    placed = dealt.select(*rows.columns, _place(partition).alias("_part"))
    _write_placed(placed.sortWithinPartitions("_part", *keys), folder, mode)


def _write_placed(rows: DataFrame, folder: str, mode: str) -> None:
    # Whatever the session says: a repeated run replaces all that a died one left.
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("_part")
    writer.option("compression", "zstd").option("parquet.writer.version", "v2").parquet(folder)


def refresh_partitions(
    source: DataFrame,
    root: str,
    keys: list[str],
    cursor: str,
    partition: str,
    lookback_days: int = 0,
    derived: Mapping[str, Column] | None = None,
) -> int:
    """Bring a partitioned table up to date by writing anew only the partitions that change: those of changed rows,
    and those where rows with the same key were before. The first run stores the source as it is; a run without changes writes no
    partition. A run writes its changed rows, finds the stored rows that they replace, and writes the other rows of the
    partitions touched, in a folder of its own; a log line puts these in force. Until that line is there readers see the table as it was.
    ``derived`` columns follow from the other columns of a row: they are not shuffled. Returns the newest version."""
    spark = source.sparkSession
    schema = StructType([*source.schema.fields, StructField("_part", StringType())])
    with released(spark):
        log = _partition_log(spark, root)
        state = None if log is None else log.agg(F.max(F.struct("version", "last_value")).alias("line")).select("line.*").first()
        run = state.version + 1 if state else 1
        folder = f"{root}/data/_run={run}"
        changed = rows_after(source, cursor, _literal(state.last_value), lookback_days) if state else source
        if state and lookback_days:
            # A stored row may be newer than one that is read again.
            changed = _changed_and_newer(spark, root, run, changed, keys, cursor)
        _write_parts(changed, folder, keys, partition, derived)
        delta = spark.read.schema(schema).parquet(folder)
        if state:
            if delta.isEmpty():
                return state.version
            if _repeated(delta, keys):
                latest_per_key(delta.drop("_part"), keys, cursor).write.mode("overwrite").parquet(f"{root}/delta/_run={run}")
                latest = spark.read.schema(source.schema).parquet(f"{root}/delta/_run={run}")
                _write_parts(latest, folder, keys, partition, derived)
                delta = spark.read.schema(schema).parquet(folder)
        # Distinct partition values: as many as there are folders.
        touched = {row[0] for row in delta.select("_part").distinct().collect()}
        reached = cursor_of(delta, cursor).first()[0]
        if state:
            touched |= _keep_others(spark, root, run, delta, keys, partition, touched, derived)
    last_value = max(v for v in (reached, state.last_value if state else None) if v is not None)
    line = spark.createDataFrame([(run, last_value, sorted(touched), source.schema.json())], PARTITION_LOG)
    line.coalesce(1).write.mode("append").parquet(f"{root}/log")
    return run


def _changed_and_newer(
    spark: SparkSession, root: str, run: int, changed: DataFrame, keys: list[str], cursor: str
) -> DataFrame:
    """Of each changed key the latest row of the changes and the stored table."""
    folder = f"{root}/delta/_run={run}"
    latest_per_key(changed, keys, cursor).write.mode("overwrite").parquet(folder)
    delta = spark.read.schema(changed.schema).parquet(folder)
    same = same_keys(read_partitioned(spark, root), delta.select(*keys), keys, "left_semi").select(*changed.columns)
    both = same.withColumn("_run", F.lit(0)).unionByName(delta.withColumn("_run", F.lit(1)))
    return latest_per_key(both, keys, cursor, then="_run").drop("_run")


def _repeated(rows: DataFrame, keys: list[str]) -> bool:
    """Whether two rows may have the same key: keys no hash of which occurs twice do not repeat."""
    hashes = rows.groupBy(F.xxhash64(*keys).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    return not hashes.filter("n > 1").isEmpty()


# Bitmaps of row numbers, 4 KB for 32,768 rows of a file, that one pass over the stored rows broadcasts at most.
BITMAPS_PER_PASS = 4_096
# A partition is dealt out anew once it has this many files more than of this size.
SPARE_FILES, FILE_BYTES = 2, 4_000_000


def _keep_others(
    spark: SparkSession,
    root: str,
    run: int,
    delta: DataFrame,
    keys: list[str],
    partition: str,
    touched: set[str],
    derived: Mapping[str, Column] | None,
) -> set[str]:
    """Add the stored rows that a run leaves as they are to the partitions it touches; returns the partitions of those it replaces.

    Keys are only shuffled to find the places (file and row number) of replaced rows. These are kept as bitmaps, a bit for each
    stored row, so whole rows need no shuffle: each file is read and written without the rows marked, and a pass over files
    broadcasts their bitmaps only. Partitions in many small files are dealt out anew."""
    table, columns = _in_place(spark, root)
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index") + 1
    # As many as files are read, which the scan lists anyway.
    sizes = table.select("_part", path.alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    files = sizes.collect()
    if not files:
        return set()

    def numbers(parts: Collection[str]) -> DataFrame:
        found = [(x.path, i) for i, x in enumerate(files) if x._part in parts]
        return F.broadcast(spark.createDataFrame(found, "_file string, _number int"))

    everywhere = numbers({x._part for x in files})
    stored = table.select(*keys, path.alias("_file"), row.alias("_row")).join(everywhere, "_file").select(*keys, "_number", "_row")
    places = same_keys(stored, delta.select(*keys), keys, "left_semi")
    bitmaps = (
        places.select("_number", "_row", F.bitmap_bucket_number("_row").alias("_bucket"))
        .repartition("_number", "_bucket")
        .groupBy("_number", "_bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits"))
    )
    bitmaps.write.mode("overwrite").parquet(f"{root}/replaced/_run={run}")
    bitmaps = spark.read.schema(bitmaps.schema).parquet(f"{root}/replaced/_run={run}")
    marked: Counter[str] = Counter()
    for found in bitmaps.groupBy("_number").agg(F.count(F.lit(1)).alias("n")).collect():
        marked[files[found._number]._part] += found.n

    of_part: dict[str, list[int]] = {}
    for found in files:
        if found._part in touched or found._part in marked:
            of_part.setdefault(found._part, []).append(found.size)
    for parts, scattered in _passes(of_part, marked):
        table, columns = _in_place(spark, root, parts)
        rows = table.select(*columns, "_part", path.alias("_at"), row.alias("_row"))
        marks = bitmaps.join(numbers(parts), "_number").drop("_number")
        few = sum(marked[part] for part in parts) <= BITMAPS_PER_PASS
        same = (F.col("_at") == F.col("_file")) & (F.bitmap_bucket_number("_row") == F.col("_bucket"))
        bit = F.bitmap_bit_position("_row")
        byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_replaced = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
        kept = rows.join(F.broadcast(marks) if few else marks, same, "left").filter(~is_replaced)
        if scattered:
            _write_parts(kept.select(*columns), f"{root}/data/_run={run}", keys, partition, derived, "append")
        else:
            # The writer sorts a task's rows by folder; more of them than this would spill.
            with setting(spark, "spark.sql.files.maxPartitionBytes", "32m"):
                _write_placed(kept.select(*columns, "_part"), f"{root}/data/_run={run}", "append")
    return set(marked)


def _passes(of_part: Mapping[str, list[int]], marked: Mapping[str, int]) -> Iterator[tuple[list[str], bool]]:
    """Partitions by passes, and whether those of a pass lie in many small files, from the sizes of each partition's files."""
    for scattered in (False, True):
        parts: list[str] = []
        for part, sizes in sorted(of_part.items()):
            if (len(sizes) > SPARE_FILES + sum(sizes) / FILE_BYTES) != scattered:
                continue
            if parts and sum(marked[p] for p in (*parts, part)) > BITMAPS_PER_PASS:
                yield parts, scattered
                parts = []
            parts.append(part)
        if parts:
            yield parts, scattered


def drop_replaced(spark: SparkSession, root: str) -> int:
    """Delete the partition folders of finished runs that later runs have replaced. Returns their number."""
    current = {(run, part) for run, parts in in_force(spark, root).items() for part in parts}
    log = _partition_log(spark, root)
    written = {(row.version, row.part) for row in log.select("version", F.explode("touched").alias("part")).collect()}
    context, gone = spark.sparkContext, 0
    escaped = context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for run, part in written - current:
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{root}/data/_run={run}/_part={escaped(part)}")
        gone += bool(folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True))
    return gone
