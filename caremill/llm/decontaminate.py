"""Benchmark decontamination by training suffix arrays.

The training texts are cut into shards (blocks of whole texts inside a task). Each shard gets the
suffix array of its words, every test suffix is looked up in it by binary search, and the hits
grow into the longest verbatim matches and their places. The stated query set (the benchmark) goes to
the tasks in parts of bounded size; a larger benchmark takes more passes, not more memory.

Cases: a null or empty text has no words; an item without words matches nothing; an item shorter
than the window is one window as a whole; items that repeat an ``item_id`` are one item with several
texts, and an item without id matches as an item called ''. An empty benchmark matches nothing. Columns beside
those named are carried along or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm import words as W

WINDOW = 13
#: Bytes of benchmark text in one broadcast part.
PART_BYTES = 16 << 20
#: Bytes of training text under one suffix array.
SHARD_BYTES = 8 << 20

MATCH = "struct<item_id:string,item_start:bigint,doc_start:bigint,n_words:bigint>"


@dataclass
class Tests:
    """All windows of a part of the benchmark: window i begins at word ``at[i]``, has ``size[i]`` words and
    belongs to item ``item[i]``, whose words begin at ``first[i]``. ``symbols`` are the words as
    numbers from 1, in the order of ``vocabulary``."""

    vocabulary: np.ndarray
    symbols: np.ndarray
    at: np.ndarray
    size: np.ndarray
    item: np.ndarray
    first: np.ndarray
    names: list[str]
    window: int

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]], window: int) -> Tests:
        names = sorted({"" if name is None else name for name, _ in items})
        number = {name: i for i, name in enumerate(names)}
        words = W.split_words(pa.array([t for _, t in items], pa.string()), W.ALPHANUMERIC, lower=True)
        vocabulary, symbols = np.unique(words.hashes(), return_inverse=True)
        n = words.counts
        windows = np.where(n >= window, n - window + 1, np.minimum(n, 1))
        first = np.repeat(words.first[:-1], windows)
        at = W.ranges(words.first[:-1], windows)
        item = np.repeat(np.array([number["" if x is None else x] for x, _ in items], np.int64), windows)
        size = np.repeat(np.minimum(n, window), windows)
        return cls(vocabulary, symbols.astype(np.int64) + 1, at, size, item, first, names, window)


def _keys(symbols: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, fill: int) -> np.ndarray:
    """The first ``size`` symbols of each suffix as a byte string of fixed width that sorts like them."""
    rows = np.full((len(at), width), fill, ">u4")
    for k in range(width):
        have = size > k
        rows[have, k] = symbols[at[have] + k]
    return rows.view(f"S{4 * width}").reshape(-1)


def find(words: W.Words, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of test windows: (word where it begins, number of the window)."""
    none = np.zeros(0, np.int64)
    if not len(tests.at) or not len(words.start):
        return none, none
    h = words.hashes()
    place = np.minimum(np.searchsorted(tests.vocabulary, h), len(tests.vocabulary) - 1)
    symbols = np.where(tests.vocabulary[place] == h, place + 1, 0)
    # Words until the next one that no test has, or the end of the text: no match is longer.
    here = np.arange(len(h))
    unknown = np.append(np.flatnonzero(symbols == 0), len(h))
    run = np.minimum(unknown[np.searchsorted(unknown, here)], np.repeat(words.first[1:], words.counts)) - here
    shortest = np.full(len(tests.vocabulary) + 1, np.iinfo(np.int64).max)
    np.minimum.at(shortest, tests.symbols[tests.at], tests.size)
    suffixes = np.flatnonzero(run >= shortest[symbols])
    if not len(suffixes):
        return none, none
    keys = _keys(symbols, suffixes, np.minimum(run[suffixes], tests.window), tests.window, 0)
    order = np.argsort(keys, kind="stable")
    array, suffixes = keys[order], suffixes[order]
    low = np.searchsorted(array, _keys(tests.symbols, tests.at, tests.size, tests.window, 0), "left")
    high = np.searchsorted(array, _keys(tests.symbols, tests.at, tests.size, tests.window, 0xFFFFFFFF), "right")
    found = np.flatnonzero(high > low)
    times = high[found] - low[found]
    return suffixes[W.ranges(low[found], times)], np.repeat(found, times)


def longest_matches(words: W.Words, tests: Tests) -> pa.Array:
    """Per text, its longest verbatim matches: windows that follow one another in text and item, as one."""
    at, window = find(words, tests)
    text = np.searchsorted(words.first, at, "right") - 1
    first, item = tests.first[window], tests.item[window]
    shift = at - tests.at[window]
    order = np.lexsort((at, shift, first, item, text))
    at, window, text, first, item, shift = (x[order] for x in (at, window, text, first, item, shift))
    new = np.ones(len(at), bool)
    same = [x[1:] == x[:-1] for x in (text, first, item, shift)]
    new[1:] = ~(np.logical_and.reduce(same) & (np.diff(at) == 1)) if len(at) else True
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(at))[: len(head)] - 1
    size = at[last] + tests.size[window[last]] - at[head]
    names = pa.array(tests.names, pa.string())
    values = pa.StructArray.from_arrays(
        [
            names.take(pa.array(item[head])),
            pa.array(tests.at[window[head]] - first[head]),
            pa.array(at[head] - words.first[text[head]]),
            pa.array(size),
        ],
        ["item_id", "item_start", "doc_start", "n_words"],
    )
    offsets = np.searchsorted(text[head], np.arange(len(words.first)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def benchmark_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in parts of bounded size, one after the other."""
    part, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text IS NOT NULL")
    for row in rows.toLocalIterator(prefetchPartitions=False):
        part.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= part_bytes:
            yield part
            part, size = [], 0
    if part:
        yield part


def verbatim_matches(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Each row of ``documents`` (text) as the struct ``row``, with ``n_words`` and ``matches``: the longest
    verbatim matches with test items (item_id, text) of at least ``window`` words, or of a whole shorter item."""
    spark: SparkSession = documents.sparkSession

    def search(tests):
        def result(_: pa.RecordBatch, text: pa.Array) -> dict[str, pa.Array]:
            words = W.split_words(text, W.ALPHANUMERIC, lower=True)
            return {"n_words": pa.array(words.counts), "matches": longest_matches(words, tests.value)}

        return result

    fields = f"n_words bigint, matches array<{MATCH}>"
    found = None
    for part in benchmark_parts(benchmark, part_bytes):
        step = search(spark.sparkContext.broadcast(Tests.of(part, window)))
        if found is None:
            found = W.annotate(documents, step, fields, SHARD_BYTES)
            continue
        again = found.select("row.*", F.struct("row", "n_words", "matches").alias("_before"))
        more = W.annotate(again.select("text", "_before"), step, fields, SHARD_BYTES)
        found = more.select(
            "row._before.row", "n_words", F.concat("row._before.matches", "matches").alias("matches")
        )
    if found is None:
        found = W.annotate(documents, search(_Empty(Tests.of([], window))), fields, SHARD_BYTES)
    return found


@dataclass
class _Empty:
    value: Tests


# Words in at least one match: matches in order, each adding what reaches beyond the ones before it.
_N_HIT = """aggregate(
    sort_array(transform(matches, m -> struct(m.doc_start AS lo, m.doc_start + m.n_words AS hi))),
    struct(0L AS covered, 0L AS reach),
    (s, m) -> struct(s.covered + greatest(0L, m.hi - greatest(m.lo, s.reach)) AS covered,
                     greatest(s.reach, m.hi) AS reach),
    s -> s.covered)"""


def judged(found: DataFrame) -> DataFrame:
    """Beside ``verbatim_matches``: words hit, the items that occur, and whether the row is contaminated (at
    least one word in 20 is hit)."""
    items = F.sort_array(F.array_distinct(F.col("matches.item_id")))
    return found.withColumns(
        {
            "n_hit": F.expr(_N_HIT),
            "n_items": F.size(items).cast("bigint"),
            "items_sha256": F.sha2(F.array_join(items, ","), 256),
        }
    ).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, unchanged."""
    return judged(verbatim_matches(documents, benchmark, window)).filter("NOT contaminated").select("row.*")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return judged(verbatim_matches(documents, benchmark)).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
