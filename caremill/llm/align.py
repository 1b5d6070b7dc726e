"""Alignment of two tokenizers over a corpus, each distinct text being tokenised once.

Documents are shuffled by their full text; each distinct text is encoded by both vocabularies and cut at the bytes where tokens
of both end. Its distinct pairs of overlapping tokens are stored with it, and weigh as many documents as the text has. Texts
lie in chunks of bounded size: a chunk's pairs are summed up before they are shuffled by pair, and only the distinct pairs
of a chunk are looked up in the counted table, to be met by the chunk's texts. So nothing of the pair table is
broadcast and no pair is hot. The measures are joined to the documents by a digest of the text.

Cases: a text that is null, empty, or changed by a vocabulary (its tokens' bytes are not those of the text) has no
tokens: zeros and an empty digest. Names of special tokens inside texts are plain text. Every row is a document, also if it
repeats another or has no doc_id. A text that is longer than a chunk is a chunk of its own, encoded in parts between words. Ties for the highest count of a token
all are best. An empty table gives no row. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm import words as W
from caremill.llm.storage import configure, dropped, stored
from caremill.llm.tokens import _BYTE_LETTERS, Encoder

#: Bytes of text whose pairs are looked up together.
CHUNK_BYTES = 8 << 20
#: Words whose ids a worker keeps, of the first vocabulary.
KEPT_WORDS = 400_000
#: Bytes of a text that the second vocabulary is given at a time; it is cut between words.
PART_BYTES = 1 << 20
_MARK = "▁"


class Vocabulary:
    """The bytes of each id, and their decimal digits, padded with zero bytes."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.sizes = np.array([len(t) for t in tokens])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        width = len(str(len(tokens)))
        self.digits = np.array([str(i).encode() for i in range(len(tokens))], f"S{width}").view(np.uint8).reshape(-1, width)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[W.ranges(self.starts[ids], self.sizes[ids])]


class ByteLevel(Vocabulary):
    """A byte-level vocabulary of the tokenizers library; a text is encoded with a space before it."""

    def __init__(self, path: str) -> None:
        self.encoder = Encoder(path, True, KEPT_WORDS, names_are_text=True)
        known = self.encoder.library.get_vocab(with_added_tokens=True)
        byte_of = {letter: byte for byte, letter in _BYTE_LETTERS.items()}
        tokens = [b""] * (1 + max(known.values()))
        for token, i in known.items():
            plain = all(c in byte_of for c in token)
            tokens[i] = bytes(byte_of[c] for c in token) if plain else token.encode()
        super().__init__(tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of each)."""
        ids, bounds = self.encoder.encode(pa.array([" " + t for t in texts], pa.large_string()), 0)
        keep = np.ones(len(ids), bool)
        keep[bounds[1:] - 1] = False
        return ids[keep].astype(np.int64), np.diff(bounds) - 1


class Pieces(Vocabulary):
    """A vocabulary of the sentencepiece library, which puts the space before a text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # Where no piece runs on over a space, what is between two spaces is encoded on its own.
        self.by_word = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        super().__init__(
            [
                bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_MARK, " ").encode()
                for i, p in enumerate(pieces)
            ]
        )

    def parts(self, text: str) -> list[str]:
        """The text in parts; each lacks the one space before it, which the library puts there again."""
        if len(text) <= PART_BYTES or not self.by_word:
            return [text]
        out, lo = [], 0
        while len(text) - lo > PART_BYTES:
            cut = lo + PART_BYTES
            while cut > lo + 1:
                cut = text.rfind(" ", lo + 1, cut)
                alone = cut > lo and text[cut - 1] not in (" ", _MARK) and text[cut + 1] not in (" ", _MARK)
                if cut < 0 or alone:
                    break
            if cut <= lo + 1:
                break
            out.append(text[lo:cut])
            lo = cut + 1
        return [*out, text[lo:]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = array("i"), []
        for text in texts:
            before = len(ids)
            for part in self.parts(text):
                ids.extend(self.model.encode(part, num_threads=1))
            sizes.append(len(ids) - before)
        return np.frombuffer(ids, np.int32).astype(np.int64), np.array(sizes, np.int64)


_VOCABULARIES: dict[tuple[type, str], Vocabulary] = {}


def _vocabulary(kind: type, path: str):
    """The worker's vocabulary; it is read once in each worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (kind, path) not in _VOCABULARIES:
        _VOCABULARIES[kind, path] = kind(path)
    return _VOCABULARIES[kind, path]


def _without(ids: np.ndarray, sizes: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[np.repeat(keep, sizes)], np.where(keep, sizes, 0)


def _intact(vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Are the joined bytes of each text's tokens those of the text?"""
    first = np.concatenate([[0], np.cumsum(sizes)])
    at = np.concatenate([[0], np.cumsum(vocabulary.sizes[ids])])[first]
    same = np.diff(at) == np.diff(bounds)
    joined = vocabulary.spelled(ids)
    if same.all():
        differs = np.flatnonzero(joined != data)
        same[np.searchsorted(bounds, differs, "right") - 1] = False
        return same
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(joined[at[i] : at[i + 1]], data[bounds[i] : bounds[i + 1]])
    return same


@dataclass
class Aligned:
    """Texts' tokens, as ids of both vocabularies, with the groups and links between them. ``first_*[t]`` is the first token,
    group or link of text t."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    first_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    first_link: np.ndarray

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first pair of each text, distinct pairs of each text as id * width + id in rising order, their links)."""
        pair = self.a[self.link_a] * width + self.b[self.link_b]
        text = np.repeat(np.arange(len(self.first_link) - 1), np.diff(self.first_link))
        order = np.lexsort((pair, text))
        pair, text = pair[order], text[order]
        new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])]) if len(pair) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        links = np.diff(np.concatenate([head, [len(pair)]]))
        return np.searchsorted(text[head], np.arange(len(self.first_link))), pair[head], links

    def spelled(self, one: Vocabulary, two: Vocabulary) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        groups = int(self.first_group[-1])
        n_a, n_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        before_a, before_b = np.cumsum(n_a), np.cumsum(n_b) - n_b
        place_a = np.arange(len(self.a)) + before_b[self.group_a]
        place_b = np.arange(len(self.b)) + before_a[self.group_b]
        width = max(one.digits.shape[1], two.digits.shape[1])
        cells = np.zeros((len(self.a) + len(self.b), width + 1), np.uint8)
        cells[place_a, : one.digits.shape[1]] = one.digits[self.a]
        cells[place_b, : two.digits.shape[1]] = two.digits[self.b]
        cells[:, width] = ord(",")
        last_a, last_b = before_a - 1, np.cumsum(n_b) - 1
        cells[place_a[last_a], width], cells[place_b[last_b], width] = ord("|"), ord(";")
        size = (cells != 0).sum(axis=1)
        bounds = np.concatenate([[0], np.cumsum(size)])[self.first_a + self.first_b]
        flat = cells.ravel()
        flat = flat[flat != 0].tobytes()
        return [flat[lo : hi - 1] if hi > lo else b"" for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def align(one: Vocabulary, two: Vocabulary, texts: list[str]) -> Aligned:
    """The tokens of texts by both vocabularies, cut into groups where both end, and linked where they overlap."""
    data, bounds = W.text_bytes(pa.array([" " + t for t in texts], pa.large_string()))
    (a, n_a), (b, n_b) = one.encode(texts), two.encode(texts)
    keep = _intact(one, a, n_a, data, bounds) & _intact(two, b, n_b, data, bounds)
    (a, n_a), (b, n_b) = _without(a, n_a, keep), _without(b, n_b, keep)
    end_a, end_b = np.cumsum(one.sizes[a]), np.cumsum(two.sizes[b])
    both = np.intersect1d(end_a, end_b, assume_unique=True)
    every = np.union1d(end_a, end_b)
    # The bytes of the texts that were kept, one text after the other.
    text_ends = np.concatenate([[0], np.cumsum(np.where(keep, np.diff(bounds), 0))])
    return Aligned(
        a, b, np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)]),
        np.searchsorted(both, end_a), np.searchsorted(both, end_b), np.searchsorted(both, text_ends, "right"),
        np.searchsorted(end_a, every), np.searchsorted(end_b, every), np.searchsorted(every, text_ends, "right"),
    )


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as all their lowest bytes, then all second ones, and so on: they compress well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


TEXTS = (
    "text_key binary, copies bigint, chunk bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " groups_sha256 string, pairs binary, links binary"
)


def _pairs(column: pa.Array) -> Iterator[np.ndarray]:
    """A text's distinct pairs, which are stored as differences."""
    for planes in column:
        yield np.cumsum(_numbers(planes.as_py()))


@dataclass
class Alignment:
    """``texts``: a row for each distinct text that is not empty, with its measures and pairs. ``pairs``: a, b, count (documents that
    hold the pair linked), best (is that the highest of a's counts?)."""

    texts: DataFrame
    pairs: DataFrame
    parts: DataFrame
    two_ids: int

    def drop(self) -> None:
        dropped(self.texts, self.pairs, self.parts)


def text_key(text: str = "text"):
    return F.unhex(F.sha2(F.col(text), 256))


def alignment(documents: DataFrame, byte_path: str, piece_path: str, chunk_bytes: int = CHUNK_BYTES) -> Alignment:
    """Align the two vocabularies over the distinct texts of ``documents`` (text), and count their linked pairs."""

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _vocabulary(ByteLevel, byte_path), _vocabulary(Pieces, piece_path)
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for rows, texts in W.blocks(batch, batch.column(0), min(chunk_bytes, W.BLOCK_BYTES)):
                found = align(one, two, texts.to_pylist())
                if size >= chunk_bytes:
                    chunk, size = chunk + 1, 0
                size += texts.nbytes
                first, pair, links = found.pairs(len(two.sizes))
                # Differences within a text; its first pair stands as it is.
                step = np.diff(pair, prepend=0)
                step[first[:-1][first[:-1] < first[1:]]] = pair[first[:-1][first[:-1] < first[1:]]]
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in found.spelled(one, two)]
                bounds = list(zip(first[:-1].tolist(), first[1:].tolist()))
                counts = [np.diff(x) for x in (found.first_a, found.first_b, found.first_group, found.first_link)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(1),
                        rows.column(2),
                        pa.array(np.full(rows.num_rows, chunk)),
                        *[pa.array(c.astype(np.int64)) for c in counts],
                        pa.array(digests, pa.string()),
                        pa.array([_planes(step[lo:hi]) for lo, hi in bounds], pa.binary()),
                        pa.array([_planes(links[lo:hi]) for lo, hi in bounds], pa.binary()),
                    ],
                    names=["text_key", "copies", "chunk", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"],
                )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, copies, now = [], [], None

        def out() -> Iterator[pa.RecordBatch]:
            if kept:
                pair, place = np.unique(np.concatenate(kept), return_inverse=True)
                n = np.bincount(place, np.repeat(copies, [len(k) for k in kept])).astype(np.int64)
                for lo in range(0, len(pair), 100_000):
                    some = pair[lo : lo + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), now)), pa.array(some), pa.array(n[lo : lo + 100_000])],
                        ["chunk", "pair", "n"],
                    )
                kept.clear()
                copies.clear()

        for batch in batches:
            for chunk, n, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _pairs(batch.column(2))):
                if chunk != now:
                    yield from out()
                    now = chunk
                kept.append(pairs)
                copies.append(n)
        yield from out()

    distinct = documents.select("text").filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = stored(distinct.select("text", text_key(), "copies").mapInArrow(W.trimmed(tokenised), TEXTS), "aligned-texts")
    two_ids = len(_vocabulary(Pieces, piece_path).sizes)
    parts = texts.select("chunk", "copies", "pairs").mapInArrow(W.trimmed(summed), "chunk bigint, pair bigint, n bigint")
    parts = stored(parts, "aligned-parts")
    counts = parts.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.select(
        F.expr(f"CAST(pair DIV {two_ids} AS INT)").alias("a"), F.expr(f"CAST(pair % {two_ids} AS INT)").alias("b"), "count"
    )
    counts = stored(counts, "aligned-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    pairs = counts.join(highest, "a").select("a", "b", "count", F.expr("count = highest").alias("best"))
    pairs = stored(pairs, "aligned-pairs")
    dropped(counts)
    return Alignment(texts, pairs, parts, two_ids)


def measures(found: Alignment) -> DataFrame:
    """The rows of ``found.texts`` without pairs, with n_best (links whose count is the highest of their a) and
    count_sum (over links)."""

    def run(key: tuple, texts: pa.Table, pairs: pa.Table) -> pa.Table:
        pair = pairs.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, count = pair[order], pairs.column("count").to_numpy()[order]
        best = pairs.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, total = [], []
        for own, links in zip(_pairs(texts.column("pairs")), texts.column("links")):
            place, links = np.searchsorted(pair, own), _numbers(links.as_py())
            n_best.append(int(links[best[place]].sum()))
            total.append(int((links * count[place]).sum()))
        plain = texts.drop_columns(["pairs", "links", "chunk"])
        return plain.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(total, pa.int64())
        )

    of_pair = found.pairs.selectExpr(f"CAST(a AS BIGINT) * {found.two_ids} + b AS pair", "count", "best")
    looked_up = found.parts.select("chunk", "pair").join(of_pair, "pair")
    schema = (
        "text_key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
        " n_best bigint, count_sum bigint"
    )
    return found.texts.groupBy("chunk").cogroup(looked_up.groupBy("chunk")).applyInArrow(run, schema)


def per_document(documents: DataFrame, measured: DataFrame) -> DataFrame:
    """doc_id with the measures of its text; zeros where it has none."""
    keyed = documents.select("doc_id", text_key().alias("text_key"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return keyed.join(measured.drop("copies"), "text_key", "left").select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = public_tokenizers.path
    found = alignment(documents, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    measured = stored(measures(found), "aligned-measures")
    found.drop()
    return per_document(documents, measured)
