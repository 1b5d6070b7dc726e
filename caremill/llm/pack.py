"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows, and its rest into pieces of falling size. The pieces of a group of
documents are dealt to as few windows as can hold them: partial partitions, ordered by imbalance, are
merged two at a time, the heaviest windows of one with the lightest of the other, which leaves windows of nearly
equal size. When the heaviest exceeds the capacity, the partition is made anew with one window more.
Groups are made inside a task, so nothing is shuffled.

Cases: a null or empty text is one end id; repeated rows are packed once for each row, also those
without doc_id; an empty table gives no piece; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from caremill.llm.tokens import KEPT_WORDS, encoder
from caremill.llm.words import blocks, trimmed

CAPACITY = 1024
#: A document's rest is halved until a piece has less than twice this: pieces of all sizes balance best.
SHORTEST = 8
#: Windows that one partition deals with.
GROUP_WINDOWS = 160

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, windows being of nearly equal sum."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return np.zeros(n, np.int64)
    # A partial partition: its sums in falling order, less the smallest. Those of single items are (size, 0, 0, ...).
    sums: dict[int, np.ndarray] = {}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []

    def taken(i: int) -> np.ndarray:
        if i < n:
            alone = np.zeros(windows, np.int64)
            alone[0] = sizes[i]
            return alone
        return sums.pop(i)

    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        merged = taken(a) + taken(b)[::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        merged -= merged[-1]
        number = n + len(merges)
        merges.append((a, b, order))
        sums[number] = merged
        heapq.heappush(heap, (-int(merged[0]), number))
    # Downwards: which window each place of a partial partition became.
    place = {n + len(merges) - 1: np.arange(windows)} if merges else {0: np.arange(windows)}
    out = np.zeros(n, np.int64)
    for number in range(n + len(merges) - 1, n - 1, -1):
        a, b, order = merges[number - n]
        final = place.pop(number)
        for child, where in ((a, order), (b, windows - 1 - order)):
            if child < n:
                out[child] = final[np.flatnonzero(where == 0)[0]]
            else:
                own = np.empty(windows, np.int64)
                own[where] = final
                place[child] = own
    return out


def deal(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each item, none above ``capacity``, in as few windows as differencing can."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, windows)
        if np.bincount(window, sizes, windows).max(initial=0) <= capacity:
            return window
        windows += 1


def pack(
    documents: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = CAPACITY,
    kept_words: int = KEPT_WORDS,
    keep_between_tasks: bool = True,
) -> DataFrame:
    """One row for each piece: its document, place in the document and in a sequence, and its ids as
    little-endian unsigned 32-bit numbers. ``kept_words`` and ``keep_between_tasks`` (words that a worker knows
    when its next task begins) trade a worker's memory for time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, True, kept_words)
        encode = coder.encode
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        tokens = 0

        def packed(pieces: list[tuple]) -> pa.RecordBatch:
            nonlocal sequence
            size = np.array([len(ids) for _, _, ids, _ in pieces], np.int64)
            window = deal(size, capacity)
            order = np.argsort(window, kind="stable")
            size, window = size[order], window[order]
            before = np.cumsum(size) - size
            first = np.searchsorted(window, window)
            # Windows that got no piece are not numbered.
            number = np.cumsum(np.diff(window, prepend=-1) > 0) - 1
            rows = [pieces[i] for i in order]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array(size),
                    pa.array([r[2].tobytes() for r in rows], pa.binary()),
                    pa.array([r[3] for r in rows], pa.int64()),
                    pa.array(sequence + number),
                    pa.array(before - before[first]),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            sequence += int(number[-1]) + 1
            return batch

        for batch in batches:
            for part, text in blocks(batch, batch.column("text")):
                ids, bounds = encode(text, end_id)
                full: list[tuple] = []
                for doc_id, lo, hi in zip(part.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    rest = lo + (hi - lo) // capacity * capacity
                    full += [(doc_id, at - lo, ids[at : at + capacity], hi - lo) for at in range(lo, rest, capacity)]
                    tokens += hi - rest
                    while rest < hi:
                        size = (hi - rest) // 2 if hi - rest >= 2 * SHORTEST else hi - rest
                        waiting.append((doc_id, rest - lo, ids[rest : rest + size].copy(), hi - lo))
                        rest += size
                    if tokens >= GROUP_WINDOWS * capacity:
                        yield packed(waiting)
                        waiting, tokens = [], 0
                if full:
                    yield alone(full, sequence)
                    sequence += len(full)
        if waiting:
            yield packed(waiting)
        if not keep_between_tasks:
            coder.clear()

    def alone(pieces: list[tuple], sequence: int) -> pa.RecordBatch:
        n = len(pieces)
        columns = [
            pa.array([p[0] for p in pieces], pa.int64()),
            pa.array([p[1] for p in pieces], pa.int64()),
            pa.array(np.full(n, capacity)),
            pa.array([p[2].tobytes() for p in pieces], pa.binary()),
            pa.array([p[3] for p in pieces], pa.int64()),
            pa.array(sequence + np.arange(n)),
            pa.array(np.zeros(n, np.int64)),
        ]
        return pa.RecordBatch.from_arrays(
            columns, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        )

    return documents.select("doc_id", "text").mapInArrow(trimmed(run), PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.selectExpr(
        "doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(pack(documents, public_tokenizers.path("byte_bpe_50k.json"), end_id=0))
