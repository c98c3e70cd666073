"""Eigendecomposition of a scatter matrix, updated one vector at a time.

A spectrum is the scatter of the vectors seen, about their mean, as eigenvalues and
eigenvectors. A vector changes the scatter by a multiple of one outer product; the new
eigenvalues are the roots of the secular equation, one between each two old ones.
Components that the vector does not touch, and equal eigenvalues, are taken out first
(deflation). Eigenvectors are formed from the outer product for which the roots found are
exact, so they stay orthogonal however often this is done.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EPS = np.finfo(np.float64).eps
_STEPS = 60


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots x of 1 + sum(weights / (poles - x)), one above each pole, and all poles - x.

    Poles rise and differ, weights are positive. A root is sought as its distance from the
    nearer pole, so differences to the poles keep their digits.
    """
    size = len(poles)
    if size == 1:
        return poles + weights, -weights[:, None]
    nearest = np.arange(size)
    high = np.empty(size)
    high[:-1] = np.diff(poles) / 2
    high[-1] = weights.sum()
    low = np.zeros(size)
    middle = poles[:-1] + high[:-1]
    above = 1 + (weights / (poles - middle[:, None])).sum(1) < 0
    nearest[:-1] += above
    low[:-1] = np.where(above, -high[:-1], 0)
    high[:-1] = np.where(above, 0, high[:-1])
    delta = poles - poles[nearest][:, None]
    at = (low + high) / 2
    rows = np.arange(size)
    # The last root lies above all poles; the two below it take the part of its neighbours.
    left = np.minimum(rows, size - 2)
    right = left + 1
    side = np.where(rows == size - 1, -1.0, 1.0)
    lower = (rows <= left[:, None]).astype(float)
    for _ in range(_STEPS):
        apart = delta - at[:, None]
        terms = weights / apart
        slopes = terms / apart
        value = 1 + terms.sum(1)
        slope = slopes.sum(1)
        low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
        done = np.abs(value) <= 4 * size * _EPS * (1 + np.abs(terms).sum(1))
        if done.all():
            break
        first, second = apart[rows, left], apart[rows, right]
        below = (slopes * lower).sum(1)
        # The rational function with the two poles beside the root, of equal value and slopes.
        c = value - first * below - second * (slope - below)
        a = (first + second) * value - first * second * slope
        b = first * second * value
        root = side * np.sqrt(np.abs(a * a - 4 * b * c))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a * side <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        moved = at + step
        inside = (moved > low) & (moved < high)
        moved = np.where(inside, moved, (low + high) / 2)
        if ((moved == at) | done).all():
            break
        at = np.where(done, at, moved)
    return poles[nearest] + at, delta - at[:, None]


@dataclass
class Spectrum:
    """Scatter of ``n`` vectors about ``mean``: rising eigenvalues, eigenvectors in columns."""

    n: float
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0.0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, vector: np.ndarray, copies: float = 1.0) -> None:
        """Take in one vector, or ``copies`` equal ones."""
        apart = vector - self.mean
        total = self.n + copies
        self.outer(apart, self.n * copies / total)
        self.mean = self.mean + apart * (copies / total)
        self.n = total

    def merge(self, other: Spectrum) -> None:
        """Take in what another spectrum has seen, one outer product for each eigenpair."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            self.outer(vector, value)
        apart, total = other.mean - self.mean, self.n + other.n
        self.outer(apart, self.n * other.n / total)
        self.mean = self.mean + apart * (other.n / total)
        self.n = total

    def outer(self, vector: np.ndarray, weight: float) -> None:
        """Add ``weight`` times the outer product of ``vector``."""
        if weight <= 0:
            return
        z = self.vectors.T @ vector * np.sqrt(weight)
        tolerance = 8 * _EPS * max(abs(self.values[-1]), abs(self.values[0]), float(z @ z))
        z = self._deflated(z, tolerance)
        active = np.abs(z) * np.sqrt(z @ z) > tolerance
        if not active.any():
            return
        poles, z = self.values[active], z[active]
        roots, apart = secular_roots(poles, z * z)
        gaps = poles - poles[:, None]
        np.fill_diagonal(gaps, 1.0)
        exact = np.sqrt(np.abs(np.prod(-apart.T / gaps, axis=1)))
        turn = np.copysign(exact, z)[:, None] / apart.T
        turn /= np.sqrt((turn * turn).sum(0))
        values, vectors = self.values.copy(), self.vectors.copy()
        values[active] = roots
        vectors[:, active] = self.vectors[:, active] @ turn
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    def _deflated(self, z: np.ndarray, tolerance: float) -> np.ndarray:
        """``z`` after eigenvectors of equal eigenvalues were turned so that one is touched."""
        close = np.flatnonzero(np.diff(self.values) <= tolerance)
        if not len(close):
            return z
        z, vectors = z.copy(), self.vectors
        vectors = vectors.copy()
        for i in close.tolist():
            length = np.hypot(z[i], z[i + 1])
            if z[i] == 0 or length == 0:
                continue
            c, s = z[i + 1] / length, z[i] / length
            one, two = vectors[:, i].copy(), vectors[:, i + 1]
            vectors[:, i], vectors[:, i + 1] = c * one - s * two, s * one + c * two
            z[i], z[i + 1] = 0.0, length
        self.vectors = vectors
        return z

    def packed(self) -> bytes:
        return np.concatenate(([self.n], self.mean, self.values, self.vectors.ravel())).tobytes()

    @classmethod
    def unpacked(cls, data: bytes, size: int) -> Spectrum:
        flat = np.frombuffer(data, np.float64)
        return cls(
            float(flat[0]),
            flat[1 : size + 1].copy(),
            flat[size + 1 : 2 * size + 1].copy(),
            flat[2 * size + 1 :].reshape(size, size).copy(),
        )
