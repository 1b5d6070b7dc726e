"""MinHash near-dedup with odd sketches.

Each document's distinct word shingles give MinHash samples. Bands of samples propose candidates; all
samples are folded into a parity bitmap (odd sketch), and the population count of two bitmaps' XOR
estimates the similarity of a candidate pair. What the estimate does not rule out by more than five standard
deviations is compared on the full sets.

Links are found in two steps, and never all pairs of a group are made. First, documents with equal sets
are one, and in each bucket every member is compared with the smallest. Then, only in buckets whose members are
still in several components, members of different components are compared, block by block, by bitmaps
and then on the full sets; what leaves a block are the links that join two components.

Cases: null texts and texts without words have the empty set and are linked with nothing; texts with fewer words
than a shingle are one shingle; rows without doc_id are no documents; of rows that repeat an id the one with
the smallest text counts; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm import words as W
from caremill.llm.links import components
from caremill.llm.passages import one_row_per_id
from caremill.llm.storage import configure, stored

SHINGLE = 5
#: Documents are linked from this many hundredths of similarity.
LEAST = 75
#: At similarity 0.75 a band agrees with probability 0.32, so all of them fail in 5 of a million pairs.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Bits that differ at an estimated similarity of 0.5. At 0.75 the mean is 57 and this is 5.5 deviations away.
MOST_BITS = int(SKETCH_BITS / 2 * (1 - np.exp(-2 * SAMPLES * 2 * (1 - 0.5) / SKETCH_BITS)))
#: Members of a bucket that are compared at a time.
BLOCK = 1024

_U32 = np.random.default_rng(20231).integers(0, 1 << 32, (2, SAMPLES), np.uint64).astype(np.uint32)
_FACTORS, _SHIFTS = _U32[0] | np.uint32(1), _U32[1]


def shingle_sets(text: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit hashes."""
    words = W.split_words(text, W.NOT_SPACE, lower=True)
    h = words.hashes()
    g = W.grams(h, n)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if hi - lo >= n:
            s = np.sort(g[lo : hi - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif hi > lo:
            out.append(W.pair(W.grams(h[lo:hi], hi - lo), np.full(1, hi - lo, np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples, one row per set; empty sets are not allowed."""
    sizes = np.array([len(s) for s in sets])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum(sizes) - sizes
    out = np.empty((SAMPLES, len(sets)), np.uint32)
    for i in range(SAMPLES):
        out[i] = np.minimum.reduceat(x * _FACTORS[i] + _SHIFTS[i], at)
    return out.T


def bands(sample: np.ndarray) -> np.ndarray:
    """One bucket key per band."""
    rows = sample.reshape(len(sample), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    for r in range(ROWS):
        key = W.pair(key, rows[:, :, r])
    return key


def odd_sketches(sample: np.ndarray) -> np.ndarray:
    """Per row, the parity of how many samples fall on each bit."""
    bit = W.mix(sample.astype(np.uint64) << np.uint64(16) | np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(SKETCH_BITS)
    place = (np.arange(len(sample))[:, None] * SKETCH_BITS + bit.astype(np.int64)).reshape(-1)
    odd = np.bincount(place, minlength=len(sample) * SKETCH_BITS).reshape(len(sample), SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.uint64)


_SIGNATURE = "doc_id bigint, n_shingles bigint, mark1 bigint, mark2 bigint, bands array<bigint>, sketch array<bigint>"


def _lists(rows: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """Rows of a matrix as lists, at the places ``owner`` of n; the other lists are empty."""
    size = np.zeros(n, np.int64)
    size[owner] = rows.shape[1]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1).view(np.int64)))


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, bucket keys and odd sketch of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in W.blocks(batch, batch.column("text")):
                sets = shingle_sets(text)
                size = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(size)
                marks = np.zeros((2, len(sets)), np.uint64)
                keys, sketch = np.zeros((0, BANDS), np.uint64), np.zeros((0, SKETCH_BITS // 64), np.uint64)
                if len(some):
                    full = [sets[i] for i in some]
                    flat, at = np.concatenate(full), np.cumsum(size[some]) - size[some]
                    marks[0, some] = np.add.reduceat(W.mix(flat), at)
                    marks[1, some] = np.add.reduceat(W.mix(flat ^ np.uint64(0x5DEECE66D)), at)
                    sample = samples(full)
                    keys, sketch = bands(sample), odd_sketches(sample)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(size),
                        pa.array(marks[0].view(np.int64)),
                        pa.array(marks[1].view(np.int64)),
                        _lists(keys, some, len(sets)),
                        _lists(sketch, some, len(sets)),
                    ],
                    ["doc_id", "n_shingles", "mark1", "mark2", "bands", "sketch"],
                )

    return documents.select("doc_id", "text").mapInArrow(W.trimmed(run), _SIGNATURE)


def estimated(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sketches do not rule out."""
    left = sketches.selectExpr("doc_id AS a", "sketch AS sketch_a")
    right = sketches.selectExpr("doc_id AS b", "sketch AS sketch_b")
    differ = " + ".join(f"bit_count(sketch_a[{i}] ^ sketch_b[{i}])" for i in range(SKETCH_BITS // 64))
    return pairs.join(left, "a").join(right, "b").filter(f"{differ} <= {MOST_BITS}").select("a", "b")


def confirmed(pairs: DataFrame, documents: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in W.blocks(batch, batch.column("text_a")):
                one, other = shingle_sets(text), shingle_sets(part.column("text_b"))
                keep = []
                for x, y in zip(one, other):
                    common = len(x) + len(y) - len(np.union1d(x, y)) if len(x) and len(y) else 0
                    keep.append(common > 0 and 100 * common >= least * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Neither side is small by itself: the same join at every size.
    pairs = pairs.hint("merge")
    with_b = pairs.join(documents, pairs.b == documents.doc_id).select("a", "b", F.col("text").alias("text_b"))
    with_b = with_b.hint("merge")
    with_a = with_b.join(documents, with_b.a == documents.doc_id).select("a", "b", F.col("text").alias("text_a"), "text_b")
    return with_a.mapInArrow(W.trimmed(run), "a bigint, b bigint")


def full_sets(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, shingles (the whole set) of the documents in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in W.blocks(batch, batch.column("text")):
                sets = shingle_sets(text)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), flat)], ["doc_id", "shingles"]
                )

    # Not small by itself: the same join at every size.
    wanted = documents.join(ids.hint("merge"), "doc_id", "left_semi").select("doc_id", "text")
    return wanted.mapInArrow(W.trimmed(run), "doc_id bigint, shingles array<bigint>")


def between_components(members: DataFrame, least: int = LEAST) -> DataFrame:
    """Links (a, b) between members of one bucket (band, place of the band, doc_id, component, bands, sketch, shingles, n
    members) that are in different components. A bucket is dealt out in pairs of blocks. Two documents
    are compared in the first bucket they share: by sketches, then on their full sets. A link that joins
    what a block has joined already is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in W.by_key(batches, "key", BLOCK):
            key, doc_id, component, side, place = (
                table.column(c).to_numpy() for c in ("key", "doc_id", "component", "side", "place")
            )
            component = component.copy()
            sketch, keys = (
                table.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(key), -1)
                for c in ("sketch", "bands")
            )
            sets = table.column("shingles").combine_chunks()
            shingles = sets.flatten().to_numpy().view(np.uint64)
            size = sets.value_lengths().to_numpy().astype(np.int64)
            at = np.cumsum(size) - size
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            links: list[tuple[int, int]] = []
            for lo, hi in zip(head.tolist(), [*head[1:].tolist(), len(key)]):
                for i in range(lo, hi):
                    # Rows of one block meet each other; rows of two blocks meet those of the other one.
                    other = np.arange(i + 1, hi)
                    other = other[(component[other] != component[i]) & ((side[other] != side[i]) | (side[i] == 2))]
                    other = other[np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1) <= MOST_BITS]
                    other = other[~(keys[other, : place[i]] == keys[i, : place[i]]).any(axis=1)]
                    if not len(other):
                        continue
                    own = shingles[at[i] : at[i] + size[i]]
                    theirs = shingles[W.ranges(at[other], size[other])]
                    same = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                    common = np.add.reduceat(same, np.cumsum(size[other]) - size[other], dtype=np.int64)
                    linked = other[100 * common >= least * (size[i] + size[other] - common)]
                    for k in linked.tolist():
                        if component[k] != component[i]:
                            links.append((int(doc_id[i]), int(doc_id[k])))
                            mine = component[lo:hi]
                            mine[mine == component[k]] = component[i]
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    parts = members.withColumn("parts", F.expr(f"CAST(ceil(n / {BLOCK}) AS INT)")).withColumn(
        "own", F.expr("CAST(pmod(xxhash64(doc_id), parts) AS INT)")
    )
    dealt = parts.withColumn("other", F.expr("explode(sequence(0, parts - 1))"))
    rows = dealt.selectExpr(
        "xxhash64(band, least(own, other), greatest(own, other)) AS key",
        # 2: block with itself.
        "CASE WHEN own = other THEN 2 WHEN own < other THEN 0 ELSE 1 END AS side",
        "place",
        "doc_id",
        "component",
        "bands",
        "sketch",
        "shingles",
    )
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(W.trimmed(run), "a bigint, b bigint")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links lead to), kept, for each document."""
    documents = one_row_per_id(documents).select("doc_id", "text")
    every = stored(signatures(documents), "signatures")
    marks = ["mark1", "mark2", "n_shingles"]
    same = every.filter("n_shingles > 0").groupBy(*marks).agg(F.min("doc_id").alias("copy_of"))
    same = stored(same, "copies")
    one = every.join(same.select(F.col("copy_of").alias("doc_id")), "doc_id", "left_semi")
    one = stored(one.select("doc_id", "bands", "sketch"), "representatives")
    sketches = one.select("doc_id", "sketch")
    rows = one.select("doc_id", F.posexplode("bands").alias("place", "band"))
    buckets = rows.groupBy("band").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n"))
    buckets = stored(buckets.filter("n > 1"), "buckets")
    star = rows.drop("place").join(buckets, "band").filter("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    links = stored(confirmed(estimated(star, sketches), documents), "links")

    # Buckets of three and more whose members the stars did not bring together.
    found = stored(components(links), "components")
    members = rows.join(buckets.filter("n > 2").select("band", "n"), "band").join(
        found.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    )
    members = stored(members.withColumn("component", F.coalesce("component", "doc_id")), "members")
    open_ones = members.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_ones = stored(open_ones.filter("lo < hi").select("band"), "open")
    rest = members.join(open_ones, "band", "left_semi")
    sets = full_sets(documents, rest.select("doc_id").distinct())
    more = between_components(rest.join(one.join(sets, "doc_id"), "doc_id"))
    found = components(links.unionByName(more))

    classes = every.select("doc_id", *marks).join(same, marks, "left")
    classes = classes.withColumn("node", F.coalesce("copy_of", "doc_id")).join(found, "node", "left")
    component = F.coalesce("component", "node").alias("component_id")
    return classes.select("doc_id", "n_shingles", component).withColumn("kept", F.expr("doc_id = component_id"))


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, unchanged: the one with the smallest id."""
    documents = one_row_per_id(documents)
    kept = near_duplicates(documents).filter("kept").select("doc_id")
    return documents.join(kept.hint("merge"), "doc_id", "left_semi").select(*documents.columns)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
