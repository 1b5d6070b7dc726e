"""Token ids in binary shards with a minimal perfect hash index.

A shard holds the documents of one range of keys in ascending order: raw ids of 16 or 32 bits, and an
index that leads from a key to the place of its ids in constant time. The index hashes the shard's n
keys to 0..n-1 without gaps (levels of bit arrays; a key is placed on the first level where nobody
else has its bit) and keeps a fingerprint per key, so that keys the shard does not have are refused.

File format, little-endian, each block padded to 8 bytes:

    header   8 x uint64: magic, keys n, records r, ids, bytes per id, levels, records without key, 0
    list     per level: uint64 count of blocks, uint64 count of bits set on the levels before it
    levels   per level its blocks: uint64 count of bits set before the block on its level, 8 x uint64 of bits
    slots    n x (uint32 fingerprint, uint32 number of records, uint64 first record)
    keys     r x int64: the key of each record (0 where there is none), to list what a shard holds
    bounds   (r + 1) x int64: ids before each record
    payload  ids

A record is one row. Rows that repeat a key are successive records of that key, in order of hashes of their
texts, and may go over the edge of a shard; rows without key come first in their shard and have no slot. A null or empty
text is the end id alone. Texts of any length are one record. An empty table makes no shard. Other columns are not looked
at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremill.llm.storage import configure, scratch
from caremill.llm.tokens import encoder
from caremill.llm.words import blocks, mix, ranges

MAGIC = 0x3230534449544B4F
#: Bits per key and level; more of them mean fewer levels.
GAMMA = 2
MOST_LEVELS = 64

#: A block of a level, and the entry of a key.
BLOCK = np.dtype([("ahead", "<u8"), ("words", "<u8", 8)])
SLOT = np.dtype([("print", "<u4"), ("records", "<u4"), ("first", "<u8")])

_SHARD = "shard bigint, path string, first_key bigint, last_key bigint, ids bigint"


def _level_bit(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return mix(keys.view(np.uint64) ^ mix(np.full(1, level + 1, np.uint64))) % np.uint64(bits)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64) ^ np.uint64(0xA5A5A5A55A5A5A5A)) >> np.uint64(32)).astype(np.uint32)


class Stored:
    """An array within a file, of which only the entries asked for are read."""

    def __init__(self, source: pa.NativeFile, dtype: np.dtype | str, count: int, at: int) -> None:
        self.source, self.dtype, self.count, self.at = source, np.dtype(dtype), count, at

    def __len__(self) -> int:
        return self.count

    def _read(self, first: int, n: int) -> np.ndarray:
        size = self.dtype.itemsize
        return np.frombuffer(self.source.read_at(n * size, self.at + first * size), self.dtype)

    def __getitem__(self, which: slice | np.ndarray) -> np.ndarray:
        if isinstance(which, slice):
            first, end, _ = which.indices(self.count)
            return self._read(first, max(end - first, 0))
        return np.concatenate([np.zeros(0, self.dtype), *[self._read(int(i), 1) for i in which]])


@dataclass
class PerfectHash:
    """``before[i]`` bits are set on the levels ahead of level i. A level is an array of blocks of 512 bits, each with the
    number of bits set ahead of it on its level, so a lookup takes one block of each level it tries."""

    levels: list[np.ndarray | Stored]
    before: list[int]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct int64 keys."""
        levels, before, placed = [], [], 0
        while len(keys):
            if len(levels) == MOST_LEVELS:
                raise ValueError("keys must be distinct")
            bits = -(-GAMMA * len(keys) // 512) * 512
            at = _level_bit(keys, len(levels), bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
            blocks = np.zeros(bits // 512, BLOCK)
            blocks["words"] = np.packbits(alone, bitorder="little").view("<u8").reshape(-1, 8)
            ones = np.bitwise_count(blocks["words"]).sum(axis=1, dtype=np.uint64)
            blocks["ahead"] = np.cumsum(ones) - ones
            levels.append(blocks)
            before.append(placed)
            placed += int(alone.sum())
            keys = keys[~alone[at.astype(np.int64)]]
        return cls(levels, before)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """0..n-1, each once, for the n keys it was made for; -1 or any slot for others."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (blocks, before) in enumerate(zip(self.levels, self.before)):
            if not len(todo):
                break
            at = _level_bit(keys[todo], level, 512 * len(blocks))
            block = blocks[(at >> np.uint64(9)).astype(np.int64)]
            word, bit = (at >> np.uint64(6) & np.uint64(7)).astype(np.int64), at & np.uint64(63)
            own = block["words"][np.arange(len(todo)), word]
            hit = (own >> bit) & np.uint64(1) == 1
            ones = np.bitwise_count(block["words"]) * (np.arange(8) < word[:, None])
            below = np.bitwise_count(own & ((np.uint64(1) << bit) - np.uint64(1)))
            rank = before + block["ahead"].astype(np.int64) + ones.sum(axis=1, dtype=np.int64) + below
            out[todo[hit]] = rank[hit]
            todo = todo[~hit]
        return out


def shard_bytes(keys: list[int | None], ids: np.ndarray, bounds: np.ndarray, width: int) -> bytes:
    """The file of records in ascending order of key, those without key ahead."""
    without = sum(k is None for k in keys)
    known = np.array(keys[without:], np.int64)
    distinct, first, times = np.unique(known, return_index=True, return_counts=True)
    index = PerfectHash.of(distinct)
    slots = np.zeros(len(distinct), SLOT)
    at = index.slot(distinct)
    slots["print"][at], slots["records"][at], slots["first"][at] = _fingerprint(distinct), times, first + without
    parts = [
        np.array([MAGIC, len(distinct), len(keys), len(ids), width, len(index.levels), without, 0], "<u8").tobytes()
    ]
    parts += [np.array([len(blocks), before], "<u8").tobytes() for blocks, before in zip(index.levels, index.before)]
    parts += [blocks.tobytes() for blocks in index.levels]
    payload = ids.astype(f"<u{width}").tobytes()
    listed = np.concatenate([np.zeros(without, np.int64), known])
    return b"".join([*parts, slots.tobytes(), listed.tobytes(), bounds.astype("<i8").tobytes(), payload, bytes(-len(payload) % 8)])


class Shard:
    """A shard by its arrays; nothing is parsed. ``array`` gives one by type, length and place in the file: a view of bytes
    that have been read, or one that reads what is asked for."""

    def __init__(self, array: Callable[[np.dtype | str, int, int], np.ndarray | Stored]) -> None:
        head = array("<u8", 8, 0)[:]
        if head[0] != MAGIC:
            raise ValueError("not a shard of token ids")
        n, self.records, ids, width, levels, self.without_key = (int(x) for x in head[1:7])
        listed = array("<u8", 2 * levels, 64)[:].reshape(-1, 2).tolist()
        at, blocks = 64 + 16 * levels, []
        for count, _ in listed:
            blocks.append(array(BLOCK, count, at))
            at += BLOCK.itemsize * count
        self.index = PerfectHash(blocks, [before for _, before in listed])
        self.slots = array(SLOT, n, at)
        at += SLOT.itemsize * n
        self.keys = array("<i8", self.records, at)
        at += 8 * self.records
        self.bounds = array("<i8", self.records + 1, at)
        self.ids = array(f"<u{width}", ids, at + 8 * (self.records + 1))

    def records_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first record, number of records) of each key; none for keys that are not here."""
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slot = self.index.slot(keys)
        found = self.slots[np.maximum(slot, 0)]
        here = (slot >= 0) & (found["print"] == _fingerprint(keys))
        return np.where(here, found["first"], 0).astype(np.int64), np.where(here, found["records"], 0).astype(np.int64)

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each record of a key."""
        first, n = (int(x[0]) for x in self.records_of(np.array([key], np.int64)))
        bounds = self.bounds[first : first + n + 1].tolist()
        return [self.ids[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]


def write(documents: DataFrame, folder: str, vocabulary: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Write the shards below ``folder`` (any file system that pyarrow opens by its address) and return the
    list of them, itself written there: shard, path, first and last key, ids, and ids of all shards before it."""
    spark = documents.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, spaced=False).encode
        keys: list[int | None] = []
        ids, sizes = [], []
        for batch in batches:
            for part, text in blocks(batch, batch.column("text")):
                some, bounds = encode(text, end_id)
                keys += part.column("doc_id").to_pylist()
                widest = int(some.max(initial=0))
                ids.append(some.astype(np.uint16) if widest < 1 << 16 else some)
                sizes.append(np.diff(bounds))
        if not keys:
            return
        number = TaskContext.get().partitionId()
        flat, bounds = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        path = f"{folder}/shard-{number:06d}.ids"
        # A lost or doubled attempt writes a file of its own; the last one to finish takes the name.
        system, place = fs.FileSystem.from_uri(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        own = f"{place}.{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(own) as out:
            out.write(shard_bytes(keys, flat, bounds, flat.dtype.itemsize))
        system.move(own, place)
        yield pa.RecordBatch.from_pydict(
            {"shard": [number], "path": [path], "first_key": [next((k for k in keys if k is not None), None)]}
            | {"last_key": [keys[-1]], "ids": [len(flat)]},
            pa.schema([(c, pa.string() if c == "path" else pa.int64()) for c in ("shard", "path", "first_key", "last_key", "ids")]),
        )

    # Rows without doc_id, and rows that repeat one, are spread by their texts.
    spread = ["doc_id", F.xxhash64("text")]
    ordered = documents.select("doc_id", "text").repartitionByRange(n, *spread).sortWithinPartitions(*spread, "text")
    ordered.mapInArrow(run, _SHARD).write.parquet(f"{folder}/list")
    # One row for each shard, whatever the number of documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(f"{folder}/list").withColumn(
        "ids_before", F.coalesce(F.sum("ids").over(before), F.lit(0))
    )


def _opened(path: str) -> Shard:
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place) as source:
        raw = source.read()
    return Shard(lambda dtype, count, at: np.frombuffer(raw, dtype, count, at))


def read(shards: DataFrame) -> DataFrame:
    """All records, each key looked up in its shard's index: doc_id, start (ids of all records before it), ids as
    little-endian unsigned 32-bit numbers. Shards are read by as many tasks as wrote them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, ahead in zip(batch.column("path").to_pylist(), batch.column("ids_before").to_pylist()):
                shard = _opened(path)
                keys = np.unique(shard.keys[shard.without_key :])
                first, n = shard.records_of(keys)
                records = np.concatenate([np.arange(shard.without_key), ranges(first, n)])
                known = np.concatenate([np.zeros(shard.without_key, np.int64), np.repeat(keys, n)])
                for lo in range(0, len(records), 500):
                    some = records[lo : lo + 500]
                    lost = np.arange(lo, lo + len(some)) < shard.without_key
                    raw = [shard.ids[shard.bounds[r] : shard.bounds[r + 1]].astype("<u4").tobytes() for r in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(known[lo : lo + 500], pa.int64(), mask=lost),
                            pa.array(ahead + shard.bounds[some]),
                            pa.array(raw, pa.binary()),
                        ],
                        ["doc_id", "start", "ids"],
                    )

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(n, "shard").mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def get(shards: DataFrame, key: int) -> list[np.ndarray]:
    """The ids of each record of one key. A key's records may go over the edge of a shard. Of a shard the header, a block
    of each level tried, one slot, and the records' bounds and ids are read, whatever its size."""
    rows = shards.filter(F.lit(key).between(F.col("first_key"), F.col("last_key"))).orderBy("shard").collect()
    found = []
    for row in rows:
        system, place = fs.FileSystem.from_uri(row["path"])
        with system.open_input_file(place) as source:
            found += Shard(partial(Stored, source)).get(key)
    return found


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    configure(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "ids")
    shards = write(documents, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read(shards).selectExpr("doc_id", "start", "length(ids) div 4 AS n_tokens", "crc32(ids) AS ids_crc32")
