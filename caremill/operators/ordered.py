"""Neighbours, row numbers and running sums per key, for keys of any size.

Ordinary keys take a plain window: one shuffle on the key. A key with more rows than one task
should sort is range-split along (key, order) into chunks of similar size. Each chunk is
windowed on its own, and what crosses a chunk's edge (the last row before it, the first row
after it, the count and sums of all earlier chunks) comes from one summary row per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from caremill.operators.skew import HotKeys, find_hot_keys
from caremill.session import durable

CHUNK = "_chunk"
COPY = "_copy"
# More chunks than this are not made, they get bigger instead. Together with the longest list of
# hot keys it bounds the summaries that are broadcast, whatever the size of the data.
MOST_CHUNKS = 20_000


class OrderedRows:
    """Rows of ``df`` in ascending ``order`` (NULLs last) within each key.

    ``order`` should end in something unique per key, or in all columns that matter: which of two
    tied rows comes first is arbitrary.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        hot: HotKeys | None = None,
    ) -> None:
        self.keys, self.order = list(keys), list(order)
        self._bounded = True
        hot = find_hot_keys(df, self.keys) if hot is None else hot
        if not hot:
            self._plain: DataFrame | None = df
            self._chunked: DataFrame | None = None
            return
        if hot.unlisted:
            self._plain, big, self._bounded = None, df, False
        else:
            listed = F.broadcast(hot.frame(df, self.keys).select(*[F.col(k).alias(f"_hot_{k}") for k in self.keys]))
            same = reduce(
                Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in self.keys]
            )
            self._plain = df.join(listed, same, "left_anti")
            big = df.join(listed, same, "left_semi")
        chunks = min(1 + ceil(hot.rows / hot.rows_per_task), MOST_CHUNKS)
        # Copies of one row cannot be told apart, so they get a number to split them by. Both the
        # number and the chunk must stay the same however often they are read or recomputed,
        # hence the checkpoints.
        told_apart = durable(big.withColumn(COPY, F.monotonically_increasing_id()))
        split = told_apart.repartitionByRange(
            chunks, *[F.col(k) for k in self.keys], *self._ordering(), F.col(COPY)
        )
        self._chunked = durable(split.withColumn(CHUNK, F.spark_partition_id()))

    def _ordering(self) -> list[Column]:
        return [F.col(name).asc_nulls_last() for name in self.order]

    def _each(self, plain: Callable[[DataFrame], DataFrame], chunked: Callable[[DataFrame], DataFrame]) -> OrderedRows:
        if self._plain is not None:
            self._plain = plain(self._plain)
        if self._chunked is not None:
            self._chunked = chunked(self._chunked)
        return self

    def with_columns(self, columns: Mapping[str, Column]) -> OrderedRows:
        """Row-wise columns; they do not disturb the order."""
        return self._each(lambda df: df.withColumns(dict(columns)), lambda df: df.withColumns(dict(columns)))

    def neighbours(
        self,
        previous: Mapping[str, str] | None = None,
        following: Mapping[str, str] | None = None,
        number: str | None = None,
        is_last: str | None = None,
    ) -> OrderedRows:
        """Add values of the previous and the following row (new name → source column), the row
        number from 1, and whether a row is the last of its key."""
        previous, following = dict(previous or {}), dict(following or {})

        def window_columns(w: WindowSpec) -> dict[str, Column]:
            columns = {new: F.lag(source).over(w) for new, source in previous.items()}
            columns |= {new: F.lead(source).over(w) for new, source in following.items()}
            if number:
                columns[number] = F.row_number().over(w).cast("bigint")
            if is_last:
                columns[is_last] = F.lead(F.lit(True)).over(w).isNull()
            return columns

        def plain(df: DataFrame) -> DataFrame:
            return df.withColumns(window_columns(self._in_key()))

        def chunked(df: DataFrame) -> DataFrame:
            w = self._in_chunk()
            position = self._position()
            edges = df.groupBy(*self.keys, CHUNK).agg(
                F.count(F.lit(1)).alias("_rows"),
                F.max_by(F.struct(*self.order, *[s for s in previous.values() if s not in self.order]), position).alias("_tail"),
                F.min_by(F.struct(*self.order, *[s for s in following.values() if s not in self.order]), position).alias("_head"),
            )
            by_chunk = Window.partitionBy(*self.keys).orderBy(CHUNK)
            earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
            edges = edges.select(
                *self.keys,
                CHUNK,
                F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
                F.lag("_tail").over(by_chunk).alias("_tail_before"),
                F.lead("_head").over(by_chunk).alias("_head_after"),
            )
            local = df.withColumns(
                window_columns(w)
                | {"_first_here": F.row_number().over(w) == 1, "_last_here": F.lead(F.lit(True)).over(w).isNull()}
            )
            joined = self._join_edges(local, edges)
            columns = {
                new: F.when(F.col("_first_here"), F.col("_tail_before")[source]).otherwise(F.col(new))
                for new, source in previous.items()
            }
            columns |= {
                new: F.when(F.col("_last_here"), F.col("_head_after")[source]).otherwise(F.col(new))
                for new, source in following.items()
            }
            if number:
                columns[number] = F.col(number) + F.col("_rows_before")
            if is_last:
                columns[is_last] = F.col("_last_here") & F.col("_head_after").isNull()
            return joined.withColumns(columns).drop(
                "_rows_before", "_tail_before", "_head_after", "_first_here", "_last_here"
            )

        return self._each(plain, chunked)

    def running_sum(self, name: str, of: str) -> OrderedRows:
        """Add the sum of a column over the rows up to and including each row."""

        def total(w: WindowSpec) -> Column:
            return F.sum(of).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))

        def chunked(df: DataFrame) -> DataFrame:
            sums = df.groupBy(*self.keys, CHUNK).agg(F.sum(of).alias("_sum"))
            earlier = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
            edges = sums.select(*self.keys, CHUNK, F.sum("_sum").over(earlier).alias("_sum_before"))
            joined = self._join_edges(df.withColumn(name, total(self._in_chunk())), edges)
            return joined.withColumn(
                name, F.coalesce(F.col(name) + F.col("_sum_before"), F.col(name), F.col("_sum_before"))
            ).drop("_sum_before")

        return self._each(lambda df: df.withColumn(name, total(self._in_key())), chunked)

    def lookup(self, per_key: DataFrame) -> OrderedRows:
        """Left-join a frame with at most one row per key. For split keys its rows are first listed
        per chunk, so no task meets more rows of a key than one chunk has."""

        def chunked(df: DataFrame) -> DataFrame:
            places = df.select(*self.keys, CHUNK).distinct()
            return self._join_edges(df, places.join(per_key, self.keys, "left"))

        return self._each(lambda df: df.join(per_key, self.keys, "left"), chunked)

    def _in_key(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self._ordering())

    def _in_chunk(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*self._ordering(), COPY)

    def _position(self) -> Column:
        parts = [part for name in (*self.order, COPY) for part in (F.col(name).isNull(), F.col(name))]
        return F.struct(*[part.alias(f"p{i}") for i, part in enumerate(parts)])

    def _join_edges(self, rows: DataFrame, edges: DataFrame) -> DataFrame:
        renamed = edges.select(
            *[F.col(k).alias(f"_edge_{k}") for k in (*self.keys, CHUNK)],
            *[c for c in edges.columns if c not in (*self.keys, CHUNK)],
        )
        same = reduce(
            Column.__and__, [F.col(k).eqNullSafe(F.col(f"_edge_{k}")) for k in (*self.keys, CHUNK)]
        )
        # With listed keys there are at most (listed keys + chunks) summary rows, both bounded.
        right = F.broadcast(renamed) if self._bounded else renamed
        return rows.join(right, same, "left").drop(*[f"_edge_{k}" for k in (*self.keys, CHUNK)])

    def frame(self) -> DataFrame:
        if self._chunked is None:
            return self._plain
        chunked = self._chunked.drop(CHUNK, COPY)
        return chunked if self._plain is None else self._plain.unionByName(chunked)
