"""Substring dedup by repeated-phrase automata.

Documents are cut into phrases; those whose seed occurs once hold nothing that recurs (``passages``). The others meet
in shards. There the passages of ``window`` words or more that occur at two places are confirmed, each with its first
place; words that only occur together are one passage. They are compiled into Aho-Corasick automata over words, of a bounded number of passages, and every phrase of the
shard is streamed through each. The automata's hits are the occurrences: they alone say which words of which phrase
repeat which place. Shards are made where the phrases are, so neither automata nor documents are sent to every task.

Cases: null, empty and short texts have no window, so nothing is removed; texts of any length are taken whole; rows
without doc_id are no documents; of rows that repeat an id the one with the smallest text counts; of equal windows the
one of the smallest doc_id, then the earliest, stays; other columns are not looked at; an empty table gives none.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from caremill.llm import words as W
from caremill.llm.passages import SEED_PHRASES, Windows, one_row_per_id, recurring
from caremill.llm.storage import configure

WINDOW = 20
SEED_WORDS = 4
#: Passages that one automaton holds; it has a node for each of their words at most.
AUTOMATON_PASSAGES = 50_000
# A name that no column of the documents has.
_REMOVED = "_removed_windows_of_document"


def locate(passages: list[tuple[int, ...]], texts: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of the passages: number of the text, place of the last word, number of the passage."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for number, passage in enumerate(passages):
        automaton.add_word(passage, number)
    automaton.make_automaton()
    of, last, which = array("q"), array("q"), array("q")
    for number, text in enumerate(texts):
        for end, passage in automaton.iter(text):
            of.append(number)
            last.append(end)
            which.append(passage)
    return tuple(np.frombuffer(hits, np.int64) if hits else np.zeros(0, np.int64) for hits in (of, last, which))


def automaton_shard(window: int, most: int = AUTOMATON_PASSAGES):
    """Runs of windows that recur, found by the automata of a shard's passages."""

    def shard(table: pa.Table) -> pa.RecordBatch:
        w = Windows.of_table(table, window)
        passage, windows = w.passages(W.grams(w.h, window)[w.at], W.grams(W.mix(w.h), window)[w.at])
        begin, end = w.at[passage].tolist(), (w.at[passage] + windows + window - 1).tolist()
        symbols = np.unique(w.h, return_inverse=True)[1].tolist()
        bounds = w.words.first.tolist()
        texts = [tuple(symbols[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]
        before = np.concatenate([[0], np.cumsum(w.words.counts - window + 1)])
        located, source = np.zeros(len(w.of), bool), np.zeros(len(w.of), np.int64)
        for lo in range(0, len(passage), most):
            some = [tuple(symbols[a:b]) for a, b in zip(begin[lo : lo + most], end[lo : lo + most])]
            of, last, which = locate(some, texts)
            size = windows[lo : lo + most][which]
            hit = W.ranges(before[of] + last - (window - 1) - (size - 1), size)
            located[hit], source[hit] = True, W.ranges(passage[lo : lo + most][which], size)
        return w.runs(table, located, source)

    return shard


def repeats(
    documents: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS, crowd: int = SEED_PHRASES
) -> DataFrame:
    """Runs of windows of ``window`` words that occur earlier too: doc_id, start, windows, source_doc_id, source_start."""
    return recurring(documents, window, seed_words, automaton_shard(window), crowd)


def without_repeats(documents: DataFrame, window: int = WINDOW, crowd: int = SEED_PHRASES) -> DataFrame:
    """Each document as the struct ``row``, with kept_text (the words that are kept, with one space between them), n_words
    and n_removed. All words that a repeated window covers are removed; nothing is at first places."""
    documents = one_row_per_id(documents)
    removed = repeats(documents, window, crowd=crowd).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "windows")).alias("removed")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in W.blocks(batch, batch.column("row").field("text")):
                words = W.split_words(text, W.NOT_SPACE)
                lists = part.column("removed").fill_null([])
                run, n = lists.flatten(), np.array(lists.value_lengths())
                owner = np.repeat(np.arange(len(n)), n)
                lo = words.first[owner] + np.array(run.field("start"))
                hi = lo + np.array(run.field("windows")) + window - 1
                total = len(words.start)
                depth = np.bincount(lo, minlength=total + 1) - np.bincount(hi, minlength=total + 1)
                kept = np.cumsum(depth[:total]) == 0
                before = np.concatenate([[0], np.cumsum(kept)])
                left = W.Words(words.data, words.start[kept], words.end[kept], before[words.first])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        left.join(left.first[:-1], left.first[1:]).cast(pa.string()),
                        pa.array(words.counts),
                        pa.array(words.counts - left.counts),
                    ],
                    ["row", *added.names],
                )

    # The documents' columns are packed above the join, so that the rows of its other use are shuffled once.
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    joined = documents.join(removed.withColumnRenamed("removed", _REMOVED).hint("merge"), "doc_id", "left")
    joined = joined.select(row, F.col(_REMOVED).alias("removed"))
    added = _parse_datatype_string("kept_text string, n_words bigint, n_removed bigint")
    return joined.mapInArrow(W.trimmed(run), StructType([joined.schema["row"], *added]))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(documents).selectExpr(
        "row.doc_id", "n_words", "n_removed", "sha2(kept_text, 256) AS kept_sha256"
    )
