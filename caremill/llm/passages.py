"""Places where word sequences may recur, for operators that need every window of n words that occurs twice.

From each window of n consecutive words the k-gram with the smallest hash is its seed. Equal windows have
equal seeds at the same place, so only windows whose seed occurs at two places can recur. Windows in a row that
share one seed at one place form a phrase; phrases are what is compared, and most never leave their task.

Phrases that share a seed meet in one task. A seed with many different phrases (a line of a few words that many pages
hold between words of their own) would make that task grow with the corpus, so its phrases are taken apart into
single windows. Equal windows are one row after a pre-aggregated count, and each recurring one is a group of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremill.llm import words as W
from caremill.llm.storage import dropped, stored

#: Phrases that are compared with one another at a time in a task.
SHARD_PHRASES = 20_000
#: A seed with more different phrases than this is replaced by the windows of its phrases.
SEED_PHRASES = 1_000
# Words are numbered with this many bits of a seed's sort key; the others are of its hash.
_PLACE = np.uint64((1 << 24) - 1)
# Words that are cut into phrases at a time; windows do not end there.
_STEP = 1 << 23


@dataclass
class Phrases:
    """Phrase i: ``windows[i]`` windows, the first of which begins at word ``lo[i]``; their seed is at word ``at[i]``."""

    lo: np.ndarray
    windows: np.ndarray
    at: np.ndarray
    seed: np.ndarray
    print: np.ndarray


def phrases(words: W.Words, window: int, k: int, step: int = _STEP) -> Phrases:
    """``print`` is a second hash, of all words of the phrase: (seed, print) names its contents."""
    h, fits = words.hashes(), words.fits(window)
    first = range(0, max(len(h) - window + 1, 1), step)
    parts = [_phrases(h[lo : lo + step + window - 1], fits[lo : lo + step], lo, window, k) for lo in first]
    return Phrases(*map(np.concatenate, zip(*parts)))


def _phrases(h: np.ndarray, fits: np.ndarray, begin: int, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Phrases among fewer words than ``_PLACE`` can number, the first of which is word ``begin``."""
    g = W.grams(h, k)
    wide = window - k + 1
    if len(g) < wide:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    least = (g & ~_PLACE) | np.arange(len(g), dtype=np.uint64)
    size = 1
    while size * 2 <= wide:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < wide:
        least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
    start = np.flatnonzero(fits[: len(least)])
    place = (least[start] & _PLACE).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (np.diff(start) != 1)
    head = np.flatnonzero(new)
    windows = np.diff(np.append(head, len(start)))
    lo, at = start[head], place[head]
    whole = W.grams(h, window)
    # First and last window cover the phrase, since it has fewer than 2 * window words.
    mark = W.pair(W.pair(whole[lo], whole[lo + windows - 1]), windows.astype(np.uint64))
    return lo + begin, windows, at + begin, g[at].view(np.int64), mark.view(np.int64)


def one_row_per_id(documents: DataFrame) -> DataFrame:
    """Each document, with all its columns. Rows without id are no documents; of rows that repeat an id, the one with
    the smallest text counts (a null text only if there is no other)."""
    rows = documents.withColumn("doc_id", F.col("doc_id").cast("bigint")).filter("doc_id IS NOT NULL")
    repeated = rows.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return rows
    rest = [F.col(f"`{c}`").asc_nulls_last() for c in rows.columns if c not in ("doc_id", "text")]
    first = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), *rest)
    # Longer than any column's name, so it clashes with none.
    rank = "_" * max(map(len, rows.columns)) + "_rank"
    again = rows.join(repeated, "doc_id", "left_semi").withColumn(rank, F.row_number().over(first))
    return rows.join(repeated, "doc_id", "left_anti").unionByName(again.filter(f"{rank} = 1").drop(rank))


def candidates(documents: DataFrame, window: int, k: int, crowd: int = SEED_PHRASES) -> tuple[DataFrame, DataFrame]:
    """The phrases whose seed occurs at two places or more, stored: seed, print, doc_id, start (the number of its
    first word), windows, ahead (words before its seed). Counting is summed up in tasks, and a seed that many rows share
    is split in the join. Then the seeds with more than ``crowd`` different phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in W.blocks(batch, batch.column("text")):
                words = W.split_words(text, W.NOT_SPACE)
                found = phrases(words, window, k)
                owner = np.searchsorted(words.first, found.lo, "right") - 1
                doc_id = np.array(part.column("doc_id"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.seed, pa.int64()),
                        pa.array(found.print, pa.int64()),
                        pa.array(doc_id[owner], pa.int64()),
                        pa.array((found.lo - words.first[owner]).astype(np.int32)),
                        pa.array(found.windows.astype(np.int16)),
                        pa.array((found.at - found.lo).astype(np.int16)),
                    ],
                    ["seed", "print", "doc_id", "start", "windows", "ahead"],
                )

    fields = "seed bigint, print bigint, doc_id bigint, start int, windows smallint, ahead smallint"
    rows = documents.select("doc_id", "text").mapInArrow(W.trimmed(run), fields)
    counted = stored(rows.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed"), "seeds")
    found = stored(rows.join(counted, "seed", "left_semi"), "phrases")
    dropped(counted)
    different = found.select("seed", "print").distinct().groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    crowded = stored(different.filter(F.col("n") > crowd).select("seed"), "crowded")
    return found, crowded


# A place in the corpus that sorts by document, then by word: doc_id * 2^32 + start, in one decimal.
_PLACE_SQL = "CAST(CAST(doc_id AS DECIMAL(20, 0)) * 4294967296 + start AS DECIMAL(32, 0))"
_START_SQL = "pmod(low, 4294967296)"

_TEXT = "seed bigint, print bigint, doc_id bigint, start int, again boolean, ahead smallint, phrase string"
_CUT = _TEXT + ", apart boolean"
_WINDOWS = "seed bigint, print bigint, first smallint, own bigint, own_print bigint, doc_id bigint, start int, again boolean"
_RUNS = "seed bigint, print bigint, first smallint, windows smallint, source_doc_id bigint, source_start int"


def distinct_phrases(found: DataFrame) -> DataFrame:
    """Each phrase once: seed, print, windows, ahead, its first place (doc_id, start) and whether it has another
    (known already where a row says ``again``)."""
    known = F.bool_or("again") if "again" in found.columns else F.lit(False)
    low_high = (
        found.withColumn("place", F.expr(_PLACE_SQL))
        .groupBy("seed", "print", "windows", "ahead")
        .agg(F.min("place").alias("low"), F.max("place").alias("high"), known.alias("known"))
    )
    return low_high.selectExpr(
        "seed",
        "print",
        "windows",
        "ahead",
        f"CAST((low - {_START_SQL}) / 4294967296 AS BIGINT) AS doc_id",
        f"CAST({_START_SQL} AS INT) AS start",
        "known OR low < high AS again",
    )


def phrase_texts(documents: DataFrame, once: DataFrame, window: int) -> DataFrame:
    """The words of each distinct phrase, cut out of the document where it is first; ``apart`` goes along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in W.blocks(batch, batch.column("text")):
                words = W.split_words(text, W.NOT_SPACE)
                lists = part.column("wanted")
                item, n = lists.flatten(), np.array(lists.value_lengths())
                owner = np.repeat(np.arange(len(n)), n)
                start = np.array(item.field("start"))
                lo = words.first[owner] + start
                joined = words.join(lo, lo + np.array(item.field("windows")) + window - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        item.field("seed"),
                        item.field("print"),
                        part.column("doc_id").take(pa.array(owner)),
                        item.field("start"),
                        item.field("again"),
                        item.field("ahead"),
                        joined.cast(pa.string()),
                        item.field("apart"),
                    ],
                    ["seed", "print", "doc_id", "start", "again", "ahead", "phrase", "apart"],
                )

    wanted = once.groupBy("doc_id").agg(
        F.collect_list(F.struct("seed", "print", "start", "again", "ahead", "windows", "apart")).alias("wanted")
    )
    joined = documents.join(wanted.hint("merge"), "doc_id").select("doc_id", "text", "wanted")
    return joined.mapInArrow(W.trimmed(run), _CUT)


def single_windows(texts: DataFrame, window: int) -> DataFrame:
    """The windows of each distinct phrase: seed and print of the phrase, first (its number there), own and own_print
    (two hashes of its words), doc_id and start (its place where the phrase is first), again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in W.blocks(batch, batch.column("phrase")):
                w = Windows.of_table(pa.Table.from_batches([part]), window)
                own, own_print = W.grams(w.h, window), W.grams(W.mix(w.h), window)
                phrase = pa.array(w.of)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("seed").take(phrase),
                        part.column("print").take(phrase),
                        pa.array(w.t.astype(np.int16)),
                        pa.array(own[w.at].view(np.int64)),
                        pa.array(own_print[w.at].view(np.int64)),
                        pa.array(w.doc_id),
                        pa.array(w.start.astype(np.int32)),
                        pa.array(w.again),
                    ],
                    ["seed", "print", "first", "own", "own_print", "doc_id", "start", "again"],
                )

    return texts.mapInArrow(W.trimmed(run), _WINDOWS)


def window_texts(texts: DataFrame, windows: DataFrame, again: DataFrame, window: int) -> DataFrame:
    """The words of each distinct window that recurs (``again``), as a phrase of its own, cut out of the phrase that has
    it where it is first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in W.blocks(batch, batch.column("phrase")):
                words = W.split_words(text, W.NOT_SPACE)
                lists = part.column("wanted")
                item, n = lists.flatten(), np.array(lists.value_lengths())
                lo = words.first[np.repeat(np.arange(len(n)), n)] + np.array(item.field("first"))
                yield pa.RecordBatch.from_arrays(
                    [
                        item.field("own"),
                        item.field("own_print"),
                        item.field("doc_id"),
                        item.field("start"),
                        pa.array(np.ones(len(lo), bool)),
                        pa.array(np.zeros(len(lo), np.int16)),
                        words.join(lo, lo + window).cast(pa.string()),
                    ],
                    ["seed", "print", "doc_id", "start", "again", "ahead", "phrase"],
                )

    # Of a document, a window belongs to one phrase, so its place names the row.
    own = again.select(F.col("seed").alias("own"), F.col("print").alias("own_print"), "doc_id", "start")
    found = windows.drop("again").join(own, ["own", "own_print", "doc_id", "start"], "left_semi")
    wanted = found.groupBy("seed", "print").agg(
        F.collect_list(F.struct("own", "own_print", "doc_id", "start", "first")).alias("wanted")
    )
    return texts.select("seed", "print", "phrase").join(wanted, ["seed", "print"]).mapInArrow(W.trimmed(run), _TEXT)


def runs_of_windows(windows: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs in the phrases that were taken apart, from those of their windows."""
    own = runs.select(F.col("seed").alias("own"), F.col("print").alias("own_print"), "source_doc_id", "source_start")
    found = windows.select("seed", "print", "first", "own", "own_print").join(own, ["own", "own_print"])
    found = found.withColumn("shift", F.col("source_start") - F.col("first"))
    line = Window.partitionBy("seed", "print", "source_doc_id", "shift").orderBy("first")
    return (
        found.withColumn("island", F.col("first") - F.row_number().over(line))
        .groupBy("seed", "print", "source_doc_id", "shift", "island")
        .agg(F.min("first").alias("first"), F.count(F.lit(1)).cast("smallint").alias("windows"))
        .selectExpr("seed", "print", "first", "windows", "source_doc_id", "shift + first AS source_start")
    )


@dataclass
class Windows:
    """All windows of some phrases: window i is the ``t[i]``-th of phrase ``of[i]`` and begins at word ``at[i]``."""

    words: W.Words
    h: np.ndarray
    of: np.ndarray
    t: np.ndarray
    at: np.ndarray
    doc_id: np.ndarray
    start: np.ndarray
    again: np.ndarray

    @classmethod
    def of_table(cls, table: pa.Table, window: int) -> Windows:
        words = W.split_words(table.column("phrase"), W.NOT_SPACE)
        n = words.counts - window + 1
        of = np.repeat(np.arange(len(n)), n)
        at = W.ranges(words.first[:-1], n)
        t = at - words.first[of]
        doc_id, start, again = (table.column(c).to_numpy() for c in ("doc_id", "start", "again"))
        return cls(words, words.hashes(), of, t, at, doc_id[of], start[of] + t, again[of])

    def firsts(self, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows with equal keys are equal: for each window, does it occur at two places, and which window
        has the first one."""
        order = np.lexsort((self.start, self.doc_id, *keys))
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(order)))
        again = np.logical_or.reduceat(self.again[order], head) if len(head) else np.zeros(0, bool)
        twice, first = np.empty(len(order), bool), np.empty(len(order), np.int64)
        twice[order] = np.repeat((size > 1) | again, size)
        first[order] = np.repeat(order[head], size)
        return twice, first

    def passages(self, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows with equal keys are equal. Those that occur at two places, as passages: windows in a row that only occur
        together, in this order. For each passage, its first window where it is first, and the number of its windows."""
        twice, first = self.firsts(*keys)
        n = len(first)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = self.of[1:] == self.of[:-1]
        behind, ahead = np.full(n, -1), np.full(n, -1)
        behind[:-1][inside] = first[1:][inside]
        ahead[1:][inside] = first[:-1][inside]
        order = np.argsort(first, kind="stable")
        head = np.flatnonzero(np.diff(first[order], prepend=-1))
        kind = first[order][head]

        def only(neighbour: np.ndarray) -> np.ndarray:
            """The neighbour that all windows equal to this one have, by the window's first place, or -1."""
            low, high = (f.reduceat(neighbour[order], head) for f in (np.minimum, np.maximum))
            out = np.full(n, -1)
            out[kind] = np.where(low == high, low, -1)
            return out

        behind, ahead = only(behind), only(ahead)
        own = np.unique(first[twice])
        goes_on = (own > 0) & (ahead[own] == own - 1) & (behind[own - 1] == own)
        start = np.flatnonzero(~goes_on)
        return own[start], np.diff(np.append(start, len(own)))

    def runs(self, table: pa.Table, twice: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        """Recurring windows in a row whose first places are in a row too, as one."""
        at = np.flatnonzero(twice)
        of, t, source, begin = self.of[at], self.t[at], self.doc_id[first[at]], self.start[first[at]]
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | (np.diff(t) != 1) | (source[1:] != source[:-1]) | (np.diff(begin) != 1)
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(at)))
        owner = pa.array(of[head])
        return pa.RecordBatch.from_arrays(
            [
                table.column("seed").take(owner).combine_chunks(),
                table.column("print").take(owner).combine_chunks(),
                pa.array(t[head].astype(np.int16)),
                pa.array(size.astype(np.int16)),
                pa.array(source[head]),
                pa.array(begin[head].astype(np.int32)),
            ],
            ["seed", "print", "first", "windows", "source_doc_id", "source_start"],
        )


def recurring(
    documents: DataFrame, window: int, k: int, shard: Callable[[pa.Table], pa.RecordBatch], crowd: int = SEED_PHRASES
) -> DataFrame:
    """All runs of windows that occur earlier too (smaller doc_id, or same document and earlier start): doc_id,
    start, windows, and the first place source_doc_id, source_start.

    ``documents``: doc_id, text, one row per id. ``shard`` finds the runs among the phrases of some seeds. The
    phrases of a seed with more than ``crowd`` different ones reach it window by window, each a seed of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in W.by_key(batches, "seed", SHARD_PHRASES):
            yield shard(table)

    documents = documents.select("doc_id", "text")
    found, crowded = candidates(documents, window, k, crowd)
    once = distinct_phrases(found)
    # Without a crowded seed there is nothing to take apart, and the result is the same.
    cut = windows = None
    if crowded.isEmpty():
        texts = phrase_texts(documents, once.withColumn("apart", F.lit(False)), window).drop("apart")
    else:
        marked = once.join(crowded.withColumn("apart", F.lit(True)), "seed", "left").fillna(False, ["apart"])
        # All phrases are cut out at once: the documents are shuffled a single time, and windows come from the phrases.
        cut = stored(phrase_texts(documents, marked, window), "cut", "zstd")
        apart = cut.filter("apart").drop("apart")
        windows = stored(single_windows(apart, window), "windows")
        each = windows.selectExpr(
            "own AS seed", "own_print AS print", "1S AS windows", "0S AS ahead", "doc_id", "start", "again"
        )
        recur = window_texts(apart, windows, distinct_phrases(each).filter("again"), window)
        texts = cut.filter("NOT apart").drop("apart").unionByName(recur)
    runs = texts.repartition("seed").sortWithinPartitions("seed").mapInArrow(W.trimmed(run), _RUNS)
    if windows is not None:
        runs = stored(runs, "runs")
        dropped(cut)
        # The runs of single windows have no phrase among those found, so the join below leaves them out.
        runs = runs.unionByName(runs_of_windows(windows, runs))
    places = found.select("seed", "print", "doc_id", "start").join(
        runs.withColumnRenamed("windows", "length"), ["seed", "print"]
    )
    return places.selectExpr(
        "doc_id", "start + first AS start", "length AS windows", "source_doc_id", "source_start"
    ).filter("NOT (doc_id = source_doc_id AND start = source_start)")
