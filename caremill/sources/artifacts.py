"""Which columns published Parquet files have, and how many rows, from their footers alone."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _footer(path: str) -> tuple[int, list[str]]:
    """(rows, columns) of a Parquet file; only its footer is read."""
    import pyarrow.fs
    import pyarrow.parquet

    if path.startswith("file:"):
        store, place = pyarrow.fs.LocalFileSystem(), unquote("/" + path.removeprefix("file:").lstrip("/"))
    else:
        store, place = pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    with store.open_input_file(place) as source:
        file = pyarrow.parquet.ParquetFile(source)
        return file.metadata.num_rows, file.schema_arrow.names


def file_footers(spark: SparkSession, root: str) -> DataFrame:
    """artifact, path, rows and columns of each Parquet file below ``root``; partition folders (key=value) are columns
    of the table whose folder they lie in.

    Spark lists the files, and tasks open their footers: no folder or file name reaches the driver, and files need not have
    schemas that merge. A root without files yields no rows.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(
            "path",
            F.regexp_extract("path", "([^/]+)(/[^/=]+=[^/]*)*/[^/]*$", 1).alias("artifact"),
            F.regexp_extract_all("path", F.lit("/([^/=]+)=[^/]*(?=/)"), F.lit(1)).alias("folders"),
        )
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], []
            for path, folders in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                n, names = _footer(path)
                rows.append(n)
                columns.append([*names, *(f for f in map(unquote, folders) if f not in names)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([unquote(a) for a in batch.column(1).to_pylist()], pa.string()),
                    batch.column(0),
                    pa.array(rows, pa.int64()),
                    pa.array(columns, pa.list_(pa.string())),
                ],
                ["artifact", "path", "rows", "columns"],
            )

    return files.mapInArrow(read, "artifact string, path string, rows bigint, columns array<string>")


def artifact_columns(spark: SparkSession, root: str) -> DataFrame:
    """(artifact, column_name, files, rows) for each table folder below ``root``: how many files have the column, and how many
    rows these files have."""
    return (
        file_footers(spark, root)
        .select("artifact", F.explode("columns").alias("column_name"), "rows")
        .groupBy("artifact", "column_name")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    )
