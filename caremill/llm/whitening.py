"""Embedding whitening by shifted CholeskyQR.

Sums of all vectors are exact whole numbers. Then distributed passes over the centred rows A sum up Gram matrices: the first is
factored with a small shift on its diagonal, which succeeds however badly A is conditioned; each further pass solves
the rows against the factors so far, which leaves them nearly orthonormal, and factors what is left. The product R of the
factors satisfies A = QR with orthonormal Q, so the small R alone is decomposed (SVD) for components and eigenvalues,
which keeps the digits that an eigenvalue decomposition of the covariance would square away. A last pass measures the
covariance of the whitened rows.

Only a few matrices of vector length squared reach the driver, whatever the number of rows.

Cases: a row whose vector is null, empty, or holds null or non-finite entries, or entries beyond 2^52 units, is
dropped; rows without vec_id and repeated rows count and are returned like all others. Vectors of each length have a fit of
their own. A component whose eigenvalue is zero to working precision has no whitened form and is left out, so constant
or too few vectors give fewer components, or none. Equal eigenvalues have any base of their space. ``deviation`` is null where it does not fit 64 bits.
An empty table gives no row. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.storage import configure

#: Passes after the first that make the rows more orthonormal: at most, and the deviation from it that ends them.
MOST_PASSES = 6
ORTHONORMAL = 1e-13
#: Rows of a block in a task.
BLOCK_ROWS = 4096
_EPS = np.finfo(float).eps


@dataclass
class Units:
    """Components become whole numbers floor(scale * component) + shift."""

    scale: float = 1.0
    shift: int = 0


@dataclass
class Fit:
    """All that tasks need of the vectors of one length."""

    n: int
    sums: list[int]
    factors: list[np.ndarray]
    components: np.ndarray | None = None
    eigenvalues: np.ndarray | None = None
    trace: float = 0.0
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * (x - mean) as exact whole numbers."""
        largest = max(1, int(np.abs(x).max(initial=0)), *(abs(s) // self.n + 1 for s in self.sums))
        kind = np.int64 if 2 * self.n * largest < 2**62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x).astype(float) / self.n

    def orthonormal(self, x: np.ndarray) -> np.ndarray:
        """The centred rows after a triangular solve with each factor so far."""
        q = self.rows(x).T
        for r in self.factors:
            q = np.linalg.solve(r.T, q)
        return q.T

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.rows(x) @ self.components / np.sqrt(self.eigenvalues)


def _vectors(embeddings: DataFrame, *columns: str) -> DataFrame:
    """The given columns and ``embedding`` as doubles, of rows with a usable vector."""
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    return embeddings.select(*kept, F.col("embedding").cast("array<double>").alias("embedding")).filter(
        "size(embedding) > 0 AND forall(embedding, c -> coalesce(NOT isnan(c) AND abs(c) < double('inf'), false))"
    )


def _blocks(batches: Iterator[pa.RecordBatch], units: Units) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one vector length, with their vectors in units."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        length = np.diff(vectors.offsets.to_numpy())
        for size in np.unique(length).tolist():
            own = np.flatnonzero(length == size)
            for lo in range(0, len(own), BLOCK_ROWS):
                some = pa.array(own[lo : lo + BLOCK_ROWS])
                c = vectors.take(some).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                scaled = np.floor(units.scale * c)
                fits = (np.abs(scaled) < 2.0**52).all(axis=1)
                yield batch.take(some.filter(pa.array(fits))), scaled[fits].astype(np.int64) + units.shift


def _summed(
    vectors: DataFrame, units: Units, kind: str, part: Callable[[np.ndarray], np.ndarray | None]
) -> dict[int, tuple[int, np.ndarray]]:
    """For each vector length the number of rows and the sum of ``part`` (a flat array) over blocks of rows. A task sums
    up its own blocks, and Spark adds the tasks' sums place by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for _, x in _blocks(batches, units):
            value = part(x) if len(x) else None
            if value is not None:
                have = total.setdefault(x.shape[1], [0, 0])
                have[0] += len(x)
                have[1] = have[1] + value
        for size, (n, value) in total.items():
            place = np.arange(-1, len(value))
            if kind == "double":
                values = pa.array(np.concatenate([[float(n)], value]))
            else:
                values = pa.array([n, *map(int, value)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), size, np.int32)), pa.array(place.astype(np.int32)), values],
                ["size", "place", "value"],
            )

    sums = vectors.select("embedding").mapInArrow(run, f"size int, place int, value {kind}")
    out: dict[int, tuple[int, np.ndarray]] = {}
    table = sums.groupBy("size", "place").agg(F.sum("value").alias("value")).orderBy("size", "place").toArrow()
    sizes = table.column("size").to_numpy()
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        values = table.column("value").slice(own[0], len(own)).to_pylist()
        out[size] = int(values[0]), np.array(values[1:], float if kind == "double" else object)
    return out


def _gram(a: np.ndarray) -> np.ndarray:
    return (a.T @ a)[np.triu_indices(a.shape[1])]


def _square(flat: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = flat
    return out + np.triu(out, 1).T


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper triangular factor of a Gram matrix, after a shift of its diagonal where one is needed."""
    size = len(gram)
    norm = max(np.linalg.norm(gram, 2), np.finfo(float).tiny)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    # The usual bound on the rounding errors of the sums and of the factoring; doubled until it suffices.
    shift = min(11 * (n * size + size * (size + 1)) * _EPS, 1e-3) * norm
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(size)).T
        except np.linalg.LinAlgError:
            shift *= 2


def fit(embeddings: DataFrame, units: Units | None = None, most: int = 32) -> dict[int, Fit]:
    """A fit for each vector length in ``embeddings`` (embedding), of up to ``most`` components each."""
    units = units or Units()
    vectors = _vectors(embeddings)
    context = embeddings.sparkSession.sparkContext
    fits = {
        size: Fit(n, [int(s) for s in sums], [])
        for size, (n, sums) in _summed(vectors, units, "decimal(38,0)", lambda x: x.sum(axis=0, dtype=object)).items()
    }
    todo = set(fits)
    for number in range(1 + MOST_PASSES):
        if not todo:
            break
        shared = context.broadcast({size: fits[size] for size in todo})

        def part(x: np.ndarray, shared=shared) -> np.ndarray | None:
            own = shared.value.get(x.shape[1])
            return None if own is None else _gram(own.orthonormal(x))

        for size, (_, flat) in _summed(vectors, units, "double", part).items():
            own, gram = fits[size], _square(flat, size)
            if number == 0:
                own.trace = float(np.trace(gram)) / own.n
            if own.trace == 0 or (number > 1 and np.abs(gram - np.eye(size)).max() < ORTHONORMAL * np.sqrt(own.n)):
                todo.discard(size)
            if own.trace > 0:
                own.factors.append(_factor(gram, own.n, shifted=number == 0))
        shared.unpersist()
    for size, own in fits.items():
        r = np.eye(size)
        for factor in own.factors:
            r = factor @ r
        _, singular, rows = np.linalg.svd(r)
        known = (singular > singular[0] * _EPS * size * 64)[:most] & (own.trace > 0)
        own.eigenvalues = (singular[:most] ** 2 / own.n)[known]
        own.components = rows[:most][known].T
    shared = context.broadcast(fits)

    def moments(x: np.ndarray) -> np.ndarray | None:
        w = shared.value[x.shape[1]].whitened(x)
        return np.concatenate([w.sum(axis=0), _gram(w)]) if w.shape[1] else None

    for size, (n, flat) in _summed(vectors, units, "double", moments).items():
        k = fits[size].components.shape[1]
        mean = flat[:k] / n
        fits[size].error = float(np.abs(_square(flat[k:], k) / n - np.outer(mean, mean) - np.eye(k)).max())
    shared.unpersist()
    return fits


def whiten(embeddings: DataFrame, fits: dict[int, Fit], units: Units | None = None) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error, for each row and component."""
    units = units or Units()
    shared = embeddings.sparkSession.sparkContext.broadcast(fits)

    def deviations(centred: np.ndarray) -> pa.Array:
        if centred.dtype != object and float(np.abs(centred).max(initial=0)) ** 2 * centred.shape[1] < 2.0**62:
            return pa.array((centred * centred).sum(axis=1))
        exact = (centred.astype(object) ** 2).sum(axis=1)
        return pa.array([v if v < 2**63 else None for v in exact], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, units):
            own = shared.value[x.shape[1]] if len(x) else None
            k = own.components.shape[1] if own else 0
            if not k:
                continue
            row = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(row), own.n)),
                    deviations(own.centred(x)).take(row),
                    pa.array(own.whitened(x).ravel()),
                    pa.array(np.tile(own.eigenvalues / own.trace, len(x))),
                    pa.array(np.full(len(row), own.error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    given = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding"))
    return _vectors(given, "vec_id").mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    units = Units(64.0, 1_000_000)
    return whiten(embeddings, fit(embeddings, units), units)
