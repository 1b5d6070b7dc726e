"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from caremill.session import scratch_path

#: Runtime settings that the operators rely on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Texts are long: few rows at a time between Spark and Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Shuffle files of a finished job are not waited for by the garbage collector.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A folder in the shared one that goes when the session's program ends."""
    path = scratch_path(spark, f"llm-{name}")
    if _STAGE["open"]:
        _STAGE["paths"].append((spark, path))
    atexit.register(_delete, spark, path)
    return path


#: The folders that the stages of a pipeline have made, and whether one is making some now.
_STAGE: dict = {"open": False, "paths": []}


def release() -> None:
    """Delete what the stages of a pipeline have made so far: their results have been written elsewhere."""
    while _STAGE["paths"]:
        _delete(*_STAGE["paths"].pop())


@contextmanager
def stage() -> Iterator[None]:
    """Tables made inside belong to one stage of a pipeline and go when the next one begins, or with ``release``."""
    release()
    _STAGE["open"] = True
    try:
        yield
    finally:
        _STAGE["open"] = False


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: its rows stay whatever executor is lost, and
    are computed once. The folder goes when the session's program ends, or with ``dropped``."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, compression=compression)
    schema = StructType.fromJson(df.schema.jsonValue())
    read = spark.read.schema(schema).parquet(path)
    read._stored_at = path
    return read


def dropped(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote; nothing may read it any more."""
    for table in tables:
        _delete(table.sparkSession, table._stored_at)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None:
        return
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    try:
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    except Exception:  # the session has ended already
        return
