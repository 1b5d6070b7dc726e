"""Session settings the library relies on, and the shared folder for durable intermediate data."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

# All of these are runtime SQL settings, so they can be applied to a session somebody else built.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle behind it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where measured partitions of one side are small, hash them: the wide rows of the other need no sort, which would
    # spill. Sides with a larger partition are sorted and merged as ever.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    # Rows that one join has dealt out by a key stay where they are for a join by that key and more.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caremill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        # Do not look up the Python call site of every expression: half the time of building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only on a single machine (a local master, as in tests) a temporary folder is made where none is named.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="caremill-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/caremill/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for what is written or collected inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# Whether the shuffle files of an execution go when it ends, instead of when the driver next collects garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released(spark: SparkSession) -> AbstractContextManager[None]:
    """What is written or collected inside leaves no shuffle files behind, so that the steps of a job do not add up on disk.
    Not for frames that are used again as they are: their shuffles would have to be run again."""
    return setting(spark, RELEASE, "true")


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows, and columns such as a partition number, stay fixed if
    an executor is lost or the plan is read twice."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
