"""The same syncs as Structured Streaming jobs that take what is new and stop.

The checkpoint replaces the stored cursor: it remembers the files already taken, so a row that
arrives late with an old cursor value is not missed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from caremill.operators.versions import latest_per_key
from caremill.sources.stored import finished, publish, write_delta


def arriving(spark: SparkSession, folder: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def once(stream: DataFrame, keys: list[str], event_time: str, lookback_days: int) -> DataFrame:
    """Each key once, though a source repeats rows for up to ``lookback_days``: keys are remembered until the
    stream's time has passed them by that much. Rows later than that are dropped."""
    watched = stream.withColumn("_watched", F.col(event_time).cast("timestamp")).withWatermark(
        "_watched", f"{lookback_days} days"
    )
    return watched.dropDuplicatesWithinWatermark(keys).drop("_watched")


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append an immutable log exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def merge_stream(stream: DataFrame, root: str, keys: list[str], cursor: str, checkpoint: str) -> StreamingQuery:
    """Store each micro-batch as one run of a merged table, to be read with ``read_stored``.

    A batch is always run (batch + 1) and builds on the runs below it, so a repeated batch gives
    the same result. Of all rows of a key the one with the highest cursor wins, of equal ones that of the later batch.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        before = finished(batch.sparkSession, root, below=batch_id + 1)
        if before is None:
            publish(latest_per_key(batch, keys, cursor), root, cursor, version=batch_id + 1)
        else:
            write_delta(batch, root, keys, cursor, batch_id + 1, before)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
