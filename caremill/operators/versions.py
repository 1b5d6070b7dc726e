"""Bring a stored state up to date: keyed merge, cursor append, and change snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremill.functions.dates import TIMESTAMP
from caremill.functions.values import row_key

EPOCH = "1970-01-01 00:00:00"


def cursor_of(target: DataFrame, cursor: str, initial: str = EPOCH) -> DataFrame:
    """One row: the highest cursor value the target holds, or ``initial`` when it is empty."""
    highest = F.max(F.col(cursor).cast(TIMESTAMP))
    return target.agg(F.coalesce(highest, F.lit(initial).cast(TIMESTAMP)).alias("last_value"))


def rows_after(source: DataFrame, cursor: str, last_value: Column, lookback_days: int = 0) -> DataFrame:
    """Source rows strictly past the cursor, compared as timestamps. The filter reaches the scan
    when the column is a timestamp.

    A row that arrives late with an old cursor value is missed, unless ``lookback_days`` reads
    that many days again; merging tolerates that, appending does not.
    """
    since = last_value - F.make_dt_interval(days=F.lit(lookback_days)) if lookback_days else last_value
    column = F.col(cursor)
    if source.schema[cursor].dataType.typeName() != TIMESTAMP:
        column = column.cast(TIMESTAMP)
    return source.filter(column > since)


def latest_per_key(df: DataFrame, keys: list[str], cursor: str, then: str | None = None) -> DataFrame:
    """The row with the highest cursor per key (of equal ones, with the highest ``then``). Spark prunes each
    task's rows to the best one of a key before the shuffle, so many copies of one key stay cheap."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in (*keys, cursor, then)]
    second = [F.col(then).desc_nulls_last()] if then else []
    order = [F.col(cursor).cast(TIMESTAMP).desc_nulls_last(), *second, *rest]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def same_keys(rows: DataFrame, keys_of: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows`` semi- or anti-joined to a table of keys; a NULL is a key like others."""
    renamed = keys_of.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = reduce(Column.__and__, [rows[k].eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    return rows.join(renamed, same, how)


def merge_by_key(target: DataFrame, delta: DataFrame, keys: list[str], cursor: str) -> DataFrame:
    """Target rows whose key is not in the delta, and of each key in the delta the latest row of
    both: the one with the highest cursor, of equal ones the delta's. A late, older row changes nothing.

    Applying the same delta again changes nothing. The target is not shuffled when the delta's
    keys are few enough for Spark to broadcast them.
    """
    touched = delta.select(*keys).distinct()
    kept = same_keys(target, touched, keys, "left_anti")
    old = same_keys(target, touched, keys, "left_semi").select(*target.columns, F.lit(0).alias("_run"))
    newest = latest_per_key(old.unionByName(delta.withColumn("_run", F.lit(1))), keys, cursor, then="_run")
    return kept.select(*target.columns).unionByName(newest.drop("_run"))


def append_after(target: DataFrame, source: DataFrame, cursor: str) -> DataFrame:
    """Target plus the source rows past the target's own cursor."""
    last_value = cursor_of(target, cursor).scalar()
    return target.unionByName(rows_after(source, cursor, last_value))


def refresh_incrementally(target: DataFrame, source: DataFrame, keys: list[str], cursor: str) -> DataFrame:
    """Re-read only what changed since the target was last built, replacing rows by key."""
    last_value = cursor_of(target, cursor, "1900-01-01 00:00:00").scalar()
    return merge_by_key(target, rows_after(source, cursor, last_value), keys, cursor)


def snapshot(
    current: DataFrame,
    previous: DataFrame | None,
    key: str,
    watched: list[str],
    run_at: str,
    close_deleted: bool = True,
) -> DataFrame:
    """Next state of a versioned snapshot of a source that overwrites its rows.

    A key gets a new version when one of the ``watched`` columns differs (NULLs compare equal);
    the open one is closed at ``run_at``. A key that has gone is closed too, and opens a new
    version if it comes back. With nothing changed the snapshot stays as it is.
    """
    now = F.lit(run_at).cast(TIMESTAMP)
    content = current.columns
    never = F.lit(None).cast(TIMESTAMP)
    if previous is None:
        return _stamp(current, key, now, never)

    old = previous.filter("valid_to IS NULL").select(F.struct(*previous.columns).alias("old"), F.col(key).alias("_old"))
    new = current.select(F.struct(*content).alias("new"), F.col(key).alias("_new"))
    # A NULL key is a key like others.
    pairs = old.join(new, F.col("_old").eqNullSafe(F.col("_new")), "full")
    changed = reduce(Column.__or__, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in watched])
    is_new, is_gone = F.col("old").isNull(), F.col("new").isNull()
    replaced = ~is_new & ~is_gone & changed
    ends = replaced | is_gone if close_deleted else replaced

    # One join yields both the kept or closed version and the version that opens.
    kept = F.when(
        ~is_new, F.col("old").withField("valid_to", F.when(ends, now).otherwise(F.col("old.valid_to")))
    )
    opened = F.when(is_new | replaced, F.struct(
        *[F.col(f"new.{c}").alias(c) for c in content],
        now.alias("valid_from"),
        never.alias("valid_to"),
        F.md5(F.concat_ws("-", F.col(f"new.{key}").cast("string"), now.cast("string"))).alias("version_id"),
    ))
    versions = pairs.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v")).select("v.*")
    return previous.filter("valid_to IS NOT NULL").unionByName(versions)


def _stamp(df: DataFrame, key: str, valid_from: Column, valid_to: Column) -> DataFrame:
    return df.withColumns({"valid_from": valid_from, "valid_to": valid_to}).withColumn(
        "version_id", row_key(key, "valid_from")
    )
