"""Language identification by word-first backoff.

A word that the training texts have is scored by its log frequency in each language. A word they do not
have is scored by its longest character n-grams that they have, falling back to shorter and shorter
ones. A text's score for a language is the mean over its words; the smallest (negative log) wins.

Counting runs over all training texts and is summed up in tasks before the shuffle. The counted table is kept whole in
the shared folder. The most frequent words and n-grams are broadcast, so that the frequent ones are never shuffled; the
documents' other words, and the other n-grams of words that were not counted, are joined to the table. How many are
broadcast changes the cost and never the result.

Cases: null text, or one without any letter, is ``und`` with score 0; so is every text if nothing was
learned. Training rows with null text or null language teach nothing; repeated rows count each time.
Ties go to the language first in alphabetical order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from caremill.llm import words as W
from caremill.llm.storage import configure, dropped, stored

#: Longest n-grams, in characters.
LONGEST = 5
#: Words, and n-grams of each length, that are broadcast: the most frequent ones. The others are joined.
MOST_WORDS = 60_000
MOST_GRAMS = 20_000
#: Distinct words of its blocks that a task sums up before it hands them on.
KEPT_KEYS = 500_000
#: Negative log10 frequency of what a language does not have, and the largest of what it has.
PENALTY = 9.0
UNKNOWN = "und"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(is it a letter, its lower-case form) of every character of all planes."""
    letter, lower = np.zeros(sys.maxunicode + 1, bool), np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        text = chr(c)
        if text.isalpha():
            letter[c] = True
            small = text.lower()
            if len(small) == 1:
                lower[c] = ord(small)
    return letter, lower


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def letters(text: pa.Array) -> tuple[np.ndarray, W.Words]:
    """(lower-case code points of all texts, words as runs of letters)."""
    if not _TABLES:
        _TABLES.append(_tables())
    letter, lower = _TABLES[0]
    data, bounds = W.text_bytes(text)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    # Characters before each text: bytes that do not continue a character.
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = begins[bounds]
    inside = letter[codes]
    codes = lower[codes]
    first, last = inside.copy(), inside.copy()
    if len(codes):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(codes))]
        first[edges], last[edges - 1] = inside[edges], inside[edges - 1]
    start = np.flatnonzero(first)
    return codes, W.Words(codes, start, np.flatnonzero(last) + 1, np.searchsorted(start, bounds))


def word_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of characters, four characters at a time."""
    padded = np.concatenate([codes.astype(np.uint64), np.zeros(4, np.uint64)])
    four = padded[:-3] | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(32) | padded[3:] << np.uint64(48)
    at, left = start, end - start
    h = W.mix(left.astype(np.uint64))
    todo = np.arange(len(at))
    ones = ~np.uint64(0)
    while len(todo):
        take = np.minimum(left, 4)
        h[todo] = W.mix(h[todo] ^ (four[at] & (ones >> ((4 - take) * 16).astype(np.uint64))))
        more = left > 4
        todo, at, left = todo[more], at[more] + 4, left[more] - 4
    return h


def word_grams(codes: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number of the word) of all n-grams of the words, each with a space on both sides."""
    size = end - start
    # All words once more, each with its two spaces.
    wide = size + 2
    spaced = np.full(int(wide.sum()), 0x20, np.uint64)
    ends = np.cumsum(wide)
    spaced[W.ranges(ends - wide + 1, size)] = codes[W.ranges(start, size)]
    number = np.maximum(wide - n + 1, 0)
    place = W.ranges(ends - wide, number)
    h = np.full(len(place), n, np.uint64)
    for k in range(n):
        h = W.mix(h ^ (spaced[place + k] << np.uint64(8))) if k % 2 == 0 else h ^ (spaced[place + k] << np.uint64(20))
    return W.mix(h), np.repeat(np.arange(len(start)), number)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


def count(texts: DataFrame) -> DataFrame:
    """How often each word (kind 0) and n-gram (kind n) occurs in the texts of each language: kind, lang, key, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, kind), parts in kept.items():
                keys, n = _summed(*(np.concatenate(x) for x in zip(*parts)))
                for lo in range(0, len(keys), 100_000):
                    some = keys[lo : lo + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), kind), pa.int32()),
                            pa.array([lang] * len(some), pa.string()),
                            pa.array(some.view(np.int64)),
                            pa.array(n[lo : lo + 100_000]),
                        ],
                        ["kind", "lang", "key", "n"],
                    )
            kept.clear()

        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                own = batch.filter(pc.equal(langs, lang))
                for _, text in W.blocks(own, own.column("text")):
                    codes, words = letters(text)
                    h = word_hashes(codes, words.start, words.end)
                    keys, first, n = np.unique(h, return_index=True, return_counts=True)
                    kept.setdefault((lang, 0), []).append((keys, n))
                    start, end = words.start[first], words.end[first]
                    for k in range(1, LONGEST + 1):
                        g, word = word_grams(codes, start, end, k)
                        kept.setdefault((lang, k), []).append(_summed(g, n[word]))
                    size += len(keys)
            if size > KEPT_KEYS:
                yield from out()
                size = 0
        yield from out()

    counted = texts.select("lang", "text").mapInArrow(W.trimmed(run), "kind int, lang string, key bigint, n bigint")
    return counted.groupBy("kind", "lang", "key").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Per kind (0 words, n n-grams): sorted keys, and the negative log10 frequency in each language, of the most
    frequent ones. ``table`` has those of all others too (kind, key, scores); it is None if there are no others."""

    langs: list[str]
    keys: list[np.ndarray]
    scores: list[np.ndarray]
    table: DataFrame | None = None

    def find(self, kind: int, h: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        keys = self.keys[kind]
        if not len(keys):
            return np.full(len(h), -1)
        place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[place] == h, place, -1)


def fit(texts: DataFrame, most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS) -> Model:
    """Learn from all rows of ``texts`` (text, lang; neither null)."""
    counts = stored(count(texts), "language-counts", "zstd")
    totals = counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()
    langs = sorted({row["lang"] for row in totals})
    # The model as it is looked up, made once: the counts of single languages are not needed any more.
    sums = F.create_map(*[F.lit(x) for row in totals for x in (f"{row['kind']} {row['lang']}", float(row["n"]))])
    score = F.least(F.lit(PENALTY), -F.log10(F.col("n") / sums[F.concat_ws(" ", "kind", "lang")]))
    by_lang = [F.coalesce(F.min(F.when(F.col("lang") == x, score)), F.lit(PENALTY)) for x in langs]
    scores_of = F.array(*by_lang) if langs else F.lit(None).cast("array<double>")
    table = counts.groupBy("kind", "key").agg(F.sum("n").alias("n"), scores_of.alias("scores")) if langs else counts.selectExpr(
        "kind", "key", "n", "CAST(NULL AS ARRAY<DOUBLE>) AS scores"
    )
    table = stored(table, "language-model", "zstd")
    dropped(counts)
    keys, scores, whole = [], [], True
    for kind in range(LONGEST + 1):
        most = most_grams if kind else most_words
        top = table.filter(F.col("kind") == kind).orderBy(F.desc("n"), "key").limit(most + 1).select("key", "scores").toArrow()
        key = top.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        whole = whole and len(key) <= most
        keys.append(key[order])
        scores.append(top.column("scores").combine_chunks().flatten().to_numpy().reshape(len(key), len(langs))[order])
    if whole:
        dropped(table)
        return Model(langs, keys, scores)
    return Model(langs, keys, scores, table.select("kind", "key", "scores"))


def predict(model: Model, text: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text. The score is the language's share when the mean frequencies are
    taken for probabilities."""
    codes, words = letters(text)
    out, share = [UNKNOWN] * len(text), np.zeros(len(text))
    if not model.langs or not len(words.start):
        return out, share
    h, first, inverse = np.unique(
        word_hashes(codes, words.start, words.end), return_index=True, return_inverse=True
    )
    start, end = words.start[first], words.end[first]
    value = np.full((len(h), len(model.langs)), PENALTY)
    row = model.find(0, h)
    value[row >= 0] = model.scores[0][row[row >= 0]]
    todo = np.flatnonzero(row < 0)
    for n in range(LONGEST, 0, -1):
        if not len(todo):
            break
        g, word = word_grams(codes, start[todo], end[todo], n)
        row = model.find(n, g)
        known = row >= 0
        found = np.bincount(word[known], minlength=len(todo))
        have = found > 0
        for lang in range(len(model.langs)):
            sums = np.bincount(word[known], model.scores[n][row[known], lang], len(todo))
            value[todo[have], lang] = sums[have] / found[have]
        todo = todo[~have]
    counts = words.counts
    some = np.flatnonzero(counts)
    mean = np.add.reduceat(value[inverse], words.first[:-1][some], axis=0) / counts[some, None]
    best, share[some] = _best(mean)
    for i, k in zip(some.tolist(), best.tolist()):
        out[i] = model.langs[k]
    return out, share


def _best(mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the language, its share) for each row of mean scores."""
    weight = 10.0 ** (mean.min(axis=1, keepdims=True) - mean)
    return np.argmin(mean, axis=1), 1 / weight.sum(axis=1)


def _doubles(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _with_rare_words(documents: DataFrame, shared: Broadcast) -> DataFrame:
    """Each row of ``documents`` as the struct ``row``, with a number, how many words it has, the summed scores of its
    words that are in the broadcast, and its other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, text in W.blocks(batch, batch.column(1)):
                codes, words = letters(text)
                owner = words.text_of_word()
                h, first, inverse = np.unique(
                    word_hashes(codes, words.start, words.end), return_index=True, return_inverse=True
                )
                row = model.find(0, h)
                value = np.zeros((len(h), len(model.langs)))
                value[row >= 0] = model.scores[0][row[row >= 0]]
                sums = np.stack(
                    [np.bincount(owner, value[inverse, k], len(text)) for k in range(len(model.langs))], axis=1
                )
                # Each text's words that are not in the broadcast, once each.
                rare = np.flatnonzero(row[inverse] < 0)
                pairs, n = np.unique(owner[rare] * max(1, len(h)) + inverse[rare], return_counts=True)
                of, word = np.divmod(pairs, max(1, len(h)))
                plain = codes.astype("<u4").tobytes().decode("utf-32-le")
                used, place = np.unique(word, return_inverse=True)
                spelled = [plain[a:b] for a, b in zip(words.start[first[used]].tolist(), words.end[first[used]].tolist())]
                missing = pa.StructArray.from_arrays(
                    [
                        pa.array(h[word].view(np.int64)),
                        pa.array(spelled, pa.string()).take(pa.array(place)),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["key", "word", "n"],
                )
                offsets = np.searchsorted(of, np.arange(len(text) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(number + np.arange(len(text))),
                        pa.array(words.counts.astype(np.int64)),
                        _doubles(sums),
                        pa.ListArray.from_arrays(pa.array(offsets), missing),
                    ],
                    ["row", "id", "n_words", "sums", "missing"],
                )
                number += len(text)

    row = documents.schema["row"]
    fields = "id bigint, n_words bigint, sums array<double>, missing array<struct<key:bigint,word:string,n:bigint>>"
    return documents.mapInArrow(W.trimmed(run), StructType([row, *_parse_datatype_string(fields)]))


def _rare_grams(unseen: DataFrame, shared: Broadcast) -> DataFrame:
    """For words (key, word) that were not counted, from the longest n-grams on down to the first that the broadcast
    has: a row with the number and the summed scores of those it has (kind below 0), and one for each other n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            keys = batch.column(0).to_numpy()
            text = batch.column(1).to_pylist()
            codes = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
            end = np.cumsum([len(x) for x in text], dtype=np.int64)
            start = np.concatenate([[0], end[:-1]])
            todo = np.arange(len(keys))
            for n in range(LONGEST, 0, -1):
                if not len(todo):
                    break
                g, word = word_grams(codes, start[todo], end[todo], n)
                row = model.find(n, g)
                known = row >= 0
                found = np.bincount(word[known], minlength=len(todo))
                sums = np.stack(
                    [
                        np.bincount(word[known], model.scores[n][row[known], k], len(todo))
                        for k in range(len(model.langs))
                    ],
                    axis=1,
                )
                some = found > 0
                # An n-gram that a word has twice counts twice.
                other = np.flatnonzero(~known)
                size = len(other)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([keys[todo[some]], keys[todo[word[other]]]])),
                        pa.array(np.full(int(some.sum()) + size, n, np.int32)),
                        pa.array(np.repeat(np.array([-n, n], np.int32), [int(some.sum()), size])),
                        pa.array(np.concatenate([keys[todo[some]], g[other].view(np.int64)])),
                        pa.array(np.concatenate([found[some], np.zeros(size, np.int64)]).astype(np.int64)),
                        _doubles(np.concatenate([sums[some], np.zeros((size, len(model.langs)))])),
                    ],
                    ["word_key", "level", "kind", "key", "found", "sums"],
                )
                todo = todo[~some]

    fields = "word_key bigint, level int, kind int, key bigint, found bigint, sums array<double>"
    return unseen.select("key", "word").mapInArrow(W.trimmed(run), fields)


def _rare_scores(words: DataFrame, model: Model, shared: Broadcast) -> DataFrame:
    """The scores in each language of distinct words (key, word) that are not in the broadcast."""
    places = range(len(model.langs))

    def total(values: Column) -> list[Column]:
        return [F.sum(F.get(values, F.lit(k))) for k in places]

    counted = model.table.filter("kind = 0").select("key", "scores")
    looked_up = stored(words.join(counted, "key", "left"), "language-words", "zstd")
    parts = _rare_grams(looked_up.filter("scores IS NULL"), shared)
    grams = model.table.filter("kind > 0").select("kind", "key", "scores")
    joined = parts.join(grams, ["kind", "key"], "left").select(
        "word_key",
        "level",
        F.when(F.col("scores").isNotNull(), F.lit(1)).otherwise(F.col("found")).alias("found"),
        F.coalesce("scores", "sums").alias("sums"),
    )
    levels = joined.groupBy("word_key", "level").agg(
        F.sum("found").alias("found"), F.array(*total(F.col("sums"))).alias("sums")
    )
    means = F.transform("sums", lambda x: x / F.greatest(F.col("found"), F.lit(1)))
    longest = levels.filter("found > 0").groupBy(F.col("word_key").alias("key")).agg(F.max_by(means, "level").alias("means"))
    nothing = F.array(*[F.lit(PENALTY) for _ in places])
    backed_off = looked_up.filter("scores IS NULL").select("key").join(longest, "key", "left")
    return looked_up.filter("scores IS NOT NULL").select("key", "scores").unionByName(
        backed_off.select("key", F.coalesce("means", nothing).alias("scores"))
    )


def _identify_joined(documents: DataFrame, model: Model) -> DataFrame:
    """As ``identify``, with the words and n-grams that are not in the broadcast joined to the model's table."""
    context = documents.sparkSession.sparkContext
    shared = context.broadcast(Model(model.langs, model.keys, model.scores))
    found = stored(_with_rare_words(documents, shared), "language-found", "zstd")
    rare = found.select("id", F.explode("missing").alias("w")).select("id", "w.key", "w.word", "w.n")
    scores = _rare_scores(rare.groupBy("key").agg(F.min("word").alias("word")), model, shared)
    places = range(len(model.langs))
    sums = (
        rare.select("id", "key", "n")
        .join(scores, "key")
        .groupBy("id")
        .agg(F.array(*[F.sum(F.col("n") * F.get("scores", F.lit(k))) for k in places]).alias("rare"))
    )
    mean = F.transform("sums", lambda x, k: (x + F.coalesce(F.get("rare", k), F.lit(0.0))) / F.greatest(F.col("n_words"), F.lit(1)))
    least = F.array_min("mean")
    weight = F.aggregate("mean", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), least - x))
    some = F.col("n_words") > 0
    named = F.get(F.array(*map(F.lit, model.langs)), (F.array_position("mean", least) - 1).cast("int"))
    return (
        found.select("row", "id", "n_words", "sums")
        .join(sums, "id", "left")
        .select("row", "n_words", F.when(some, mean).alias("mean"))
        .select(
            "row",
            F.when(some, named).otherwise(UNKNOWN).alias("lang_pred"),
            F.when(some, 1 / weight).otherwise(0.0).alias("score"),
        )
    )


def identify(documents: DataFrame, model: Model, kept: Sequence[str] | None = None) -> DataFrame:
    """Each row of ``documents`` (text) as the struct ``row``, with ``lang_pred`` and ``score``. The struct has the
    columns ``kept``, or all."""
    row = F.struct(*[F.col(f"`{c}`") for c in kept or documents.columns]).alias("row")
    if model.table is not None:
        return _identify_joined(documents.select(row, F.col("text").alias("text")), model)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def result(_: pa.RecordBatch, text: pa.Array) -> dict[str, pa.Array]:
        lang, score = predict(shared.value, text)
        return {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)}

    return W.annotate(documents, result, "lang_pred string, score double").select(
        F.struct(*[F.col(f"row.`{c}`") for c in kept or documents.columns]).alias("row"), "lang_pred", "score"
    )


def held_out(doc_id: Column, parts: int = 5, held: int = 0) -> Column:
    """True for the share of rows that nothing is learned from. A row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == held, F.lit(False))


def learned_from(documents: DataFrame) -> DataFrame:
    """Text and language of the rows that are not held out."""
    return documents.filter(~held_out(F.col("doc_id"))).select("text", "lang").filter(
        "text IS NOT NULL AND lang IS NOT NULL"
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(learned_from(documents))
    return identify(documents.select("doc_id", "text"), model, kept=["doc_id"]).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )
