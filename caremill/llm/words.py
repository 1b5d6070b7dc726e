"""Words of many texts at once: numpy arrays over one byte buffer, so that no Python runs per word.

All functions work on a block of texts that a Spark task holds for a moment; ``blocks`` bounds it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

#: Bytes of text that are taken apart at a time. One longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def _byte_set(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)])


#: Bytes of words that end at white space: all but 0x20 and 0x09-0x0D.
NOT_SPACE = _byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of words of ASCII letters, digits and everything beyond ASCII.
ALPHANUMERIC = _byte_set(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

_U = np.uint64
_C1, _C2, _C3 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random."""
    x = x ^ (x >> _U(30))
    x *= _C1
    x ^= x >> _U(27)
    x *= _C2
    x ^= x >> _U(31)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two, in this order."""
    return mix(a * _C3 + (b ^ (b >> _U(29))))


@dataclass
class Words:
    """Word ``i`` is ``data[start[i]:end[i]]``; text ``d`` has the words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, step: int = 1 << 18) -> np.ndarray:
        """64-bit hashes of the words' bytes; words of up to eight bytes and equal length never collide."""
        out = np.empty(len(self.start), np.uint64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        for lo in range(0, len(out), step):
            at, left = self.start[lo : lo + step], self.end[lo : lo + step] - self.start[lo : lo + step]
            h = mix(left.astype(np.uint64) * _C3)
            todo = np.arange(len(at))
            while len(todo):
                take = np.minimum(left, 8)
                h[todo] = mix(h[todo] ^ (eight[at] & (~_U(0) >> ((8 - take) * 8).astype(np.uint64))))
                more = left > 8
                todo, at, left = todo[more], at[more] + 8, left[more] - 8
            out[lo : lo + step] = h
        return out

    def fits(self, n: int) -> np.ndarray:
        """For each word: do it and the next n - 1 belong to one text?"""
        return np.arange(len(self.start)) + n <= np.repeat(self.first[1:], self.counts)

    def join(self, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
        """The texts made of the words lo[i]:hi[i], with one space between words."""
        n = hi - lo
        words = ranges(lo, n)
        size = self.end[words] - self.start[words] + 1
        ends = np.cumsum(size)
        # One separator after each word; a text's last one is cut off by the offsets below.
        out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
        out[ranges(ends - size, size - 1)] = self.data[ranges(self.start[words], size - 1)]
        bytes_of = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])])
        keep = np.ones(len(out), bool)
        keep[np.cumsum(bytes_of)[bytes_of > 0] - 1] = False
        offsets = np.concatenate([[0], np.cumsum(np.maximum(bytes_of - 1, 0))])
        return pa.Array.from_buffers(
            pa.large_string(), len(lo), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[keep])]
        )


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (length[0] numbers), start[1], ... as one array."""
    start, length = np.asarray(start, np.int64), np.asarray(length, np.int64)
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, bounds of each). A null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def split_words(texts: pa.Array, word_byte: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of ``word_byte`` bytes, after A-Z became a-z if ``lower``."""
    data, bounds = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = word_byte[data]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n hashes in a row, one for each start; whether they lie in one text is not looked at."""
    if n > len(h):
        return np.zeros(0, np.uint64)
    out, done, power, size = None, 0, h, 1
    while True:
        if n & size:
            out = power if out is None else pair(out[: len(power) - done], power[done:])
            done += size
        if done == n:
            return out[: len(h) - n + 1]
        power, size = pair(power[:-size], power[size:]), size * 2


def blocks(batch: pa.RecordBatch, texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The batch in slices of about ``limit`` bytes of text, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, "right")))
        yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)
        lo = hi


def by_key(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Rows that are sorted by a 64-bit key, in tables of about ``rows`` rows that hold all rows of their keys."""
    kept: list[pa.RecordBatch] = []
    n, enough = 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(kept)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut == 0:
            # One key so far: look again when there is twice as much of it.
            enough = 2 * n
            continue
        yield table.slice(0, cut)
        kept, n, enough = table.slice(cut).to_batches(), n - cut, rows
    if n:
        yield pa.Table.from_batches(kept)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which the worker's unused memory goes back: Spark keeps workers for the next task."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return whole


ROW = "row"


def annotate(
    documents: DataFrame,
    result: Callable[[pa.RecordBatch, pa.Array], dict[str, pa.Array]],
    fields: str,
    limit: int = BLOCK_BYTES,
) -> DataFrame:
    """Each row of ``documents`` as the struct ``row``, whatever its columns are called, with new
    columns beside it that are computed from blocks of texts in tasks. There is no shuffle."""
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias(ROW))
    added = _parse_datatype_string(fields)
    kinds = added.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field("text")
            for part, text in blocks(batch, texts, limit):
                columns = result(part, text)
                yield pa.RecordBatch.from_arrays([part.column(0), *[columns[k] for k in kinds]], [ROW, *kinds])

    return packed.mapInArrow(trimmed(run), StructType([packed.schema[ROW], *added]))
