"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all texts, whatever they are, are the unlabelled ones. Labels that say
"not toxic" are used for the class prior alone. A linear classifier in numpy minimises the
class-prior-corrected risk, whose negative part is not allowed below zero:

    prior * R(positives as 1) + max(0, R(unlabelled as 0) - prior * R(positives as 0))

Features are words and word beginnings, weighted by how much more often positives have them than the
corpus does. The corpus counts cover every document. The classifier is fitted on bounded samples (the rows with the
smallest hashes of their ids): at most MOST_POSITIVE confirmed and MOST_UNLABELLED unlabelled texts.

Cases: null and empty texts have no features and get the score of the bias alone; without any confirmed toxic
text every score is 0; a label that is null, or of a row without id, teaches nothing; repeated rows are
scored each for itself. Texts of any length are taken whole. Samples are drawn by id, so ties need no rule; an empty table
of documents gives no rows, an empty table of labels the score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm import words as W
from caremill.llm.language import held_out
from caremill.llm.storage import configure

MOST_POSITIVE = 20_000
MOST_UNLABELLED = 40_000
#: A feature is counted over the corpus if at least this many positives have it. All such are, so the bounded sample of
#: positives alone bounds their number.
LEAST_POSITIVE = 4
#: A feature counts if positives have it this many times as often as the corpus, by so many standard deviations.
LEAST_RATIO, LEAST_DEVIATION = 4.0, 6.0
#: Word beginnings, in bytes.
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.7


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash) of each text's distinct features."""
    words = W.split_words(text, W.ALPHANUMERIC, lower=True)
    of = words.text_of_word()
    keys, owners = [words.hashes()], [of]
    size = words.end - words.start
    for n in BEGINNINGS:
        long = size >= n
        cut = W.Words(words.data, words.start[long], words.start[long] + n, words.first)
        keys.append(cut.hashes() ^ np.uint64(n))
        owners.append(of[long])
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], key[new]


@dataclass
class Known:
    """Sorted feature hashes."""

    keys: np.ndarray

    def of(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of the text, number of the feature) of the texts' features that are known."""
        owner, key = features(text)
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[place] == key
        return owner[hit], place[hit]


@dataclass
class Classifier:
    known: Known
    weights: np.ndarray
    bias: float

    def score(self, text: pa.Array) -> np.ndarray:
        if not np.isfinite(self.bias):
            return np.zeros(len(text))
        owner, feature = self.known.of(text)
        return _sigmoid(self.bias + np.bincount(owner, self.weights[feature], len(text)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_pu(
    positives: list[np.ndarray],
    unlabelled: list[np.ndarray],
    scale: np.ndarray,
    prior: float,
    steps: int = 1000,
    rate: float = 0.1,
    decay: float = 1e-6,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative risk estimator's minimum, by Adam over all rows. Each row is a list
    of feature numbers; ``scale`` is the value of a feature that a row has. Features were chosen as evidence
    of toxicity, so weights begin at 1 (their log ratio) and stay above zero."""

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return owner, np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)

    p, u = flat(positives), flat(unlabelled)
    w, b = np.ones(len(scale)), 0.0
    first, second = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)

    def outputs(rows: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
        return b + np.bincount(rows[0], (w * scale)[rows[1]], n)

    def gradient(rows: tuple[np.ndarray, np.ndarray], slope: np.ndarray) -> np.ndarray:
        by_feature = np.bincount(rows[1], slope[rows[0]], len(scale)) * scale
        return np.append(by_feature, slope.sum()) / len(slope)

    for step in range(1, steps + 1):
        gp, gu = outputs(p, len(positives)), outputs(u, len(unlabelled))
        # Sigmoid loss: s(-g) as 1, s(g) as 0. It is bounded, so no single text outweighs the others.
        sp, su = _sigmoid(gp), _sigmoid(gu)
        as_one = gradient(p, -sp * (1 - sp))
        negative = su.mean() - prior * sp.mean()
        negative_slope = gradient(u, su * (1 - su)) - prior * gradient(p, sp * (1 - sp))
        # Below zero the unlabelled part is overfitted: a step back along it.
        slope = prior * as_one + negative_slope if negative >= 0 else -negative_slope
        slope[:-1] += decay * (w - 1)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = np.maximum(w - move[:-1], 0), b - move[-1]
    return w * scale, float(b)


def _sample(ids: DataFrame, n: int) -> DataFrame:
    """At most n of the ids: those with the smallest hashes."""
    return ids.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _rows(documents: DataFrame, ids: DataFrame) -> DataFrame:
    # The ids are bounded by their limit.
    return documents.join(F.broadcast(ids), "doc_id", "left_semi").select("text")


def _counts(texts: DataFrame, known: Known | None) -> DataFrame:
    """Texts that have each feature (key, n), of the known features or of all."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None if shared.value is None else np.zeros(len(shared.value.keys), np.int64)
        for batch in batches:
            for _, text in W.blocks(batch, batch.column("text")):
                if total is None:
                    yield rows(*np.unique(features(text)[1], return_counts=True))
                else:
                    total += np.bincount(shared.value.of(text)[1], minlength=len(total))
        if total is not None and total.any():
            yield rows(shared.value.keys[total > 0], total[total > 0])

    def rows(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    counted = texts.select("text").mapInArrow(W.trimmed(run), "key bigint, n bigint")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def _feature_rows(texts: DataFrame, known: Known) -> list[np.ndarray]:
    """The known features of each text of a bounded sample, at the driver."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, text in W.blocks(batch, batch.column("text")):
                owner, feature = shared.value.of(text)
                offsets = np.searchsorted(owner, np.arange(len(text) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.astype(np.int32)))], ["features"]
                )

    table = texts.mapInArrow(W.trimmed(run), "features array<int>").toArrow()
    return [row.values.to_numpy() for row in table.column("features")] if table.num_rows else []


def fit(documents: DataFrame, toxic: DataFrame, prior: float | None = None) -> Classifier:
    """Learn from ``documents`` (doc_id, text) and ``toxic`` (doc_id, toxic 0 or 1; only rows one may learn from).
    ``prior`` is the share of toxic texts; unless given, that of the labels."""
    documents = documents.select("doc_id", "text")
    labels = toxic.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", "toxic")
    ids = _sample(labels.filter("toxic = 1"), MOST_POSITIVE)
    positive = _rows(documents, ids)
    n_positive = positive.count()
    if not n_positive:
        return Classifier(Known(np.zeros(0, np.uint64)), np.zeros(0), float("-inf"))
    if prior is None:
        prior = labels.agg(F.avg("toxic")).first()[0]
    prior = min(max(prior, 1e-4), 0.5)

    table = _counts(positive, None).filter(F.col("n") >= min(LEAST_POSITIVE, n_positive)).toArrow()
    keys, having = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(keys)
    keys, having = keys[order], having[order]
    corpus = _counts(documents, Known(keys)).toArrow()
    place = np.searchsorted(keys, corpus.column("key").to_numpy().view(np.uint64))
    n_all = documents.count()
    everywhere = np.ones(len(keys))
    everywhere[place] = corpus.column("n").to_numpy()
    expected = everywhere * n_positive / n_all
    ratio = having / expected
    good = (ratio >= LEAST_RATIO) & (having - expected >= LEAST_DEVIATION * np.sqrt(expected))
    known = Known(keys[good])
    scale = np.log(ratio[good])
    weights, bias = fit_pu(
        _feature_rows(positive, known),
        _feature_rows(_rows(documents, _sample(documents, MOST_UNLABELLED)), known),
        scale,
        prior,
    )
    return Classifier(known, weights, bias)


def scored(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """Each row of ``documents`` (text) as the struct ``row``, with ``score``."""
    shared = documents.sparkSession.sparkContext.broadcast(classifier)

    def result(_: pa.RecordBatch, text: pa.Array) -> dict[str, pa.Array]:
        return {"score": pa.array(shared.value.score(text))}

    return W.annotate(documents, result, "score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    classifier = fit(documents, labels.filter(~held_out(F.col("doc_id"), 3, 1)))
    return scored(documents, classifier).select(
        "row.doc_id",
        held_out(F.col("row.doc_id"), 3, 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
