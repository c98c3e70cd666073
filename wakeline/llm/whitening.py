"""Embedding whitening by incremental eigendecomposition.

Entries become whole numbers first (floor(1024 * entry) + 100000), so sums are exact. Each
task keeps the spectrum of its own vectors and takes them in one rank-one update after
another (``spectrum``), equal vectors of a batch as one. Spectra are merged a few at
a time, again by rank-one updates, until one is left. Its eigenvectors then serve as the
basis of a Rayleigh-Ritz step over all vectors: every task sums the outer products of its
centred vectors in that basis, and the eigenvectors of the sum turn the basis into the
components, to double precision. What tasks hand over is one row of the size of a
covariance, and no step gathers more than a few of them.

Vectors that are null or hold null or non-finite entries take no part, nor those that
differ from the most common length (the longest of equally common ones). Null ids stay;
repeated rows each count and each give rows. Components whose eigenvalue is below RANK
times the largest are noise and left out: a table of equal vectors, a single vector and an
empty table give an empty result. Equal eigenvalues have their components in any order and
direction. Numbers too large for exact 64-bit sums are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.folding import folded, per_task, summed
from wakeline.llm.spectrum import Spectrum
from wakeline.sources.staging import staged

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
RANK = 1e-10
# Sums of squares stay below 2^63, and the longs they are made of below 2^62.
_MOST = 9.0e18


@dataclass
class Whitening:
    """A fitted transform: count, exact sums, components in columns, their eigenvalues."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over the entries of (n * x - sum)^2, exactly."""
        if x.size and self.n * float(np.abs(x).max()) > _MOST / 2:
            raise OverflowError("n times an entry is beyond 64 bits")
        apart = self.n * x - self.sums
        if x.size and (apart.astype(np.float64) ** 2).sum(1).max() > _MOST:
            raise OverflowError("a deviation is beyond 64 bits")
        return (apart * apart).sum(1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, whose whole part is taken off as a whole number."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), size)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries as whole numbers."""
    for batch in batches:
        entries = batch.column(1)
        value = np.floor(np.array(entries.flatten(), np.float64) * SCALE)
        if len(value) and np.abs(value).max() > _MOST / 2:
            raise OverflowError("an entry is beyond 64 bits")
        offsets = np.concatenate(([0], np.cumsum(np.array(entries.value_lengths()))))
        x = pa.array(value.astype(np.int64) + OFFSET)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), x)], ["vec_id", "x"]
        )


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, the whole numbers, of the vectors that take part; written once."""
    entry = F.col(column).cast("array<double>")
    spoilt = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fit = vectors.select(F.col("vec_id").cast("long"), entry.alias("entries")).filter(
        entry.isNotNull() & ~spoilt
    )
    lengths = fit.groupBy(F.size("entries").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    whole = fit.filter((F.size("entries") == size) & (F.size("entries") > 0))
    return staged(whole.mapInArrow(_whole, "vec_id long, x array<long>"), "vectors")


def _from_tasks(rows: DataFrame, work: Callable[[Iterator[np.ndarray]], bytes | None], size: int) -> DataFrame:
    """One row from each task that has vectors, made from its matrices."""
    return per_task(rows.select("x"), lambda batches: work(_matrix(batch.column(0), size) for batch in batches))


def _sums(rows: DataFrame, size: int) -> tuple[int, np.ndarray]:
    def work(batches):
        total = np.zeros(size + 1, np.int64)
        for x in batches:
            if (np.abs(x).sum(0, dtype=np.float64) + np.abs(total[1:])).max() > _MOST:
                raise OverflowError("a sum of entries is beyond 64 bits")
            total[0] += len(x)
            total[1:] += x.sum(0)
        return total.tobytes() if total[0] else None

    total = np.frombuffer(folded(_from_tasks(rows, work, size), summed(np.int64), "sums"), np.int64)
    return int(total[0]), total[1:].copy()


def spectrum(rows: DataFrame, n: int, sums: np.ndarray) -> Spectrum:
    """Spectrum of all vectors about the common mean, by rank-one updates alone."""
    size = len(sums)

    def work(batches):
        own = Spectrum.empty(size)
        for x in batches:
            vectors, copies = np.unique(x, axis=0, return_counts=True)
            for vector, many in zip(_centred(vectors, n, sums), copies.tolist(), strict=True):
                own.add(vector, many)
        return own.packed() if own.n else None

    def merge(rows):
        first, *rest = (Spectrum.unpacked(row, size) for row in rows)
        for other in rest:
            first.merge(other)
        return first.packed()

    return Spectrum.unpacked(folded(_from_tasks(rows, work, size), merge, "spectra"), size)


def _scatter(rows: DataFrame, size: int, turn: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of the outer products of all vectors after ``turn``, and the sum of the vectors."""

    def work(batches):
        total = np.zeros((width + 1, width))
        seen = False
        for x in batches:
            y = turn(x)
            total[:width] += y.T @ y
            total[width] += y.sum(0)
            seen = True
        return total.tobytes() if seen else None

    data = folded(_from_tasks(rows, work, size), summed(np.float64), "scatter")
    return np.frombuffer(data, np.float64).reshape(width + 1, width)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit to ``usable`` vectors; None if there are none."""
    first = rows.select(F.size("x").alias("size")).first()
    if first is None:
        return None
    n, sums = _sums(rows, first["size"])
    basis, _ = np.linalg.qr(spectrum(rows, n, sums).vectors)
    ritz = _scatter(rows, len(sums), lambda x: _centred(x, n, sums) @ basis, len(sums))[:-1]
    values, turn = np.linalg.eigh(ritz / n)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    kept = np.flatnonzero(values[:components] > RANK * max(values[0], 0.0))
    return Whitening(n, sums, vectors[:, kept], values[kept], float(np.trace(ritz)) / n)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry by which the covariance of the whitened vectors differs from the identity."""
    size, width = len(model.sums), len(model.values)
    total = _scatter(rows, size, model.project, width)
    mean = total[width] / model.n
    return float(np.abs(total[:width] / model.n - np.outer(mean, mean) - np.eye(width)).max())


_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector that takes part and each component, by falling eigenvalue."""
    rows = usable(vectors)
    model = fit(rows, components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], _RESULT)
    error = identity_error(rows, model)
    size, width = len(model.sums), len(model.values)
    explained = model.values / model.trace

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), size)
            many = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(many), width))),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * width, model.n)),
                    pa.array(np.repeat(model.deviation(x), width)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(explained, many)),
                    pa.array(np.full(many * width, error)),
                ],
                [part.split()[0] for part in _RESULT.split(", ")],
            )

    return rows.mapInArrow(transform, _RESULT)
