"""Substring dedup by sparse suffix arrays.

Of all suffixes only those at content-selected positions are kept: the minimisers of the windows of ``least``
words, so that every repeat of that length has one at the same place in all its copies. The kept suffixes
that share their first words meet in a task, are sorted by their words, and neighbours are compared:
how many words they share to the right gives the runs of equal suffixes for each length, and within
a run the words to the left are compared. Matches are then extended over the windows that follow.

Where more suffixes share their first words than a task should hold, the windows of ``least`` words around them are
told apart first, and each that recurs is a suffix of its own.

Cases: null, empty and short texts have no match; texts of any length are taken whole; rows without doc_id are no documents; of rows that repeat
an id the one with the smallest text counts; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm import words as W
from caremill.llm.passages import SEED_PHRASES, Windows, one_row_per_id, recurring
from caremill.llm.storage import configure

#: Shortest match, in words, and words of a minimiser.
LEAST = 50
SEED_WORDS = 10


def suffix_shard(least: int):
    """Runs of windows that recur, by the sorted suffixes of a shard."""

    def shard(table: pa.Table) -> pa.RecordBatch:
        w = Windows.of_table(table, least)
        ahead = table.column("ahead").to_numpy().astype(np.int64)
        first_word, last_word = w.words.first[:-1], w.words.first[1:]
        suffix = first_word + ahead
        symbols = np.unique(w.h, return_inverse=True)[1].astype(np.int64) + 1
        # The suffixes' words to the right, as byte strings that sort like them; 0 is the end.
        right = np.zeros((len(suffix), least), ">u4")
        for k in range(least):
            some = suffix + k < last_word
            right[some, k] = symbols[suffix[some] + k]
        order = np.argsort(right.view(f"S{4 * least}").reshape(-1), kind="stable")
        right = right[order]
        # Neighbours: the number of words they share.
        same = right[1:] == right[:-1]
        shared = np.where(same.all(axis=1), least, np.argmin(same, axis=1)) if len(order) > 1 else np.zeros(0, int)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        window_key, left_key = np.zeros(len(w.of), np.int64), np.zeros(len(w.of), np.uint64)
        # A window has o words before the suffix's place and least - o from there on.
        left = np.zeros(len(suffix), np.uint64)
        for o in range(int(ahead.max(initial=0)) + 1):
            if o:
                some = ahead >= o
                left[some] = W.pair(left[some], w.h[suffix[some] - o])
            run = np.concatenate([[0], np.cumsum(shared < least - o)])[rank]
            own = np.flatnonzero(ahead[w.of] - w.t == o)
            window_key[own], left_key[own] = run[w.of[own]] * (least + 1) + o, left[w.of[own]]
        return w.runs(table, *w.firsts(left_key, window_key))

    return shard


def matches(
    documents: DataFrame, least: int = LEAST, seed_words: int = SEED_WORDS, crowd: int = SEED_PHRASES
) -> DataFrame:
    """Maximal matches of at least ``least`` words with the place where the words are first: doc_id, start, n_words,
    source_doc_id, source_start. Every repeated passage of that length is in a match, unless it is at its first place,
    which is the source of the others."""
    runs = recurring(one_row_per_id(documents), least, seed_words, suffix_shard(least), crowd)
    per_document = runs.groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "windows", "source_doc_id", "source_start")).alias("runs")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("runs")
            item, n = lists.flatten(), np.array(lists.value_lengths())
            owner = np.repeat(np.arange(len(n)), n)
            start, size, source, begin = (
                np.array(item.field(c)).astype(np.int64) for c in ("start", "windows", "source_doc_id", "source_start")
            )
            order = np.lexsort((start, start - begin, source, owner))
            owner, start, size, source, begin = (x[order] for x in (owner, start, size, source, begin))
            new = np.ones(len(order), bool)
            new[1:] = (
                (owner[1:] != owner[:-1])
                | (source[1:] != source[:-1])
                | (np.diff(start - begin) != 0)
                | (start[1:] != (start + size)[:-1])
            )
            head = np.flatnonzero(new)
            total = np.add.reduceat(size, head) if len(head) else size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner[head])),
                    pa.array(start[head]),
                    pa.array(total + least - 1),
                    pa.array(source[head]),
                    pa.array(begin[head]),
                ],
                ["doc_id", "start", "n_words", "source_doc_id", "source_start"],
            )

    fields = "doc_id bigint, start bigint, n_words bigint, source_doc_id bigint, source_start bigint"
    return per_document.mapInArrow(W.trimmed(run), fields)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"))
