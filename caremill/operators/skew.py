"""Find the keys that are too big for one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A window sorts all rows of a key in one task. Up to this many rows that is fine.
ROWS_PER_TASK = 2_000_000
# Longest list of hot keys that is brought to the driver and broadcast back.
LISTED_KEYS = 2_000


@dataclass(frozen=True)
class HotKeys:
    """Keys with more rows than one task should hold.

    ``values`` lists them, unless there are more than ``LISTED_KEYS``: then ``unlisted`` is
    set and callers must treat every key as possibly hot.
    """

    values: tuple[tuple, ...]
    rows: int
    rows_per_task: int
    unlisted: bool = False

    def __bool__(self) -> bool:
        return self.unlisted or bool(self.values)

    def frame(self, df: DataFrame, keys: list[str]) -> DataFrame:
        schema = df.select(*keys).schema
        return df.sparkSession.createDataFrame([tuple(v) for v in self.values], schema)


def find_hot_keys(df: DataFrame, keys: list[str], rows_per_task: int | None = None) -> HotKeys:
    """Count rows per key, pre-aggregated before the shuffle and reading only the key columns.

    At most ``LISTED_KEYS`` keys and one number per key reach the driver.
    """
    limit = rows_per_task or int(
        df.sparkSession.conf.get("spark.caremill.rowsPerTask", str(ROWS_PER_TASK))
    )
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    found = big.limit(LISTED_KEYS + 1).collect()
    if len(found) > LISTED_KEYS:
        return HotKeys((), df.count(), limit, unlisted=True)
    return HotKeys(
        tuple(tuple(row[key] for key in keys) for row in found),
        sum(row["_rows"] for row in found),
        limit,
    )
