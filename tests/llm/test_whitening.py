"""Whitening against numpy on whole tables; the rank-one updates against numpy by themselves."""

import numpy as np
import pytest

from wakeline.llm import whitening
from wakeline.llm.spectrum import Spectrum, secular_roots

SCHEMA = "vec_id long, embedding array<float>, x int"


def checked(got, rows, components=8):
    """Compare the result with numpy over the rows that take part."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([v for _, v in kept], np.float32).astype(np.float64)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(0)
    mean = x - sums / n
    cov = mean.T @ mean / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    wide = int((e[:components] > 1e-10 * e[0]).sum())
    assert len(got) == n * wide
    deviation = ((n * x - sums).astype(object) ** 2).sum(1)
    by = {}
    for row in got:
        by.setdefault((row.vec_id, row.component), []).append(row)
        assert row.n == n and row.identity_error <= 1e-4
        assert abs(row.explained / (e[row.component - 1] / np.trace(cov)) - 1) < 1e-9
    for k in range(wide):
        want = mean @ q[:, k] / np.sqrt(e[k])
        own = sorted((r.vec_id, r.deviation, r.whitened) for rs in by.values() for r in rs if r.component == k + 1)
        both = [sorted((i, d, s * w) for (i, _), d, w in zip(kept, deviation, want, strict=True)) for s in (1, -1)]
        errors = [max(abs(a[2] - b[2]) for a, b in zip(own, one, strict=True)) for one in both]
        assert min(errors) < 1e-8
        assert [a[:2] for a in own] == [b[:2] for b in both[0]]


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(3, 0.1, 12)
    rows = [(i, (rng.normal(size=12) * scale).tolist()) for i in range(700)]
    rows += [(7, rows[3][1])] * 150 + [(900 + i, rows[5][1]) for i in range(100)]
    bad = [(1, None), (2, [None] + [1.0] * 11), (3, [float("nan")] * 12), (4, [float("inf")] + [0.0] * 11)]
    vectors = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA).repartition(40)
    checked(whitening.whiten(vectors).collect(), rows)


def test_whitening_of_few_dimensions_and_equal_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a), float(a) * 2, float(b)]) for i, (a, b) in enumerate(rng.normal(size=(60, 2)) * 9)]
    flat = [(i, [v[0], v[0], v[2]]) for i, v in rows]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in flat], SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2}
    checked(got, flat)
    for few in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(9)], [(1, None, 0), (2, [], 0)]):
        assert whitening.whiten(spark.createDataFrame(few, SCHEMA)).count() == 0
    mixed = [(i, [float(i), float(i * i)], 0) for i in range(9)] + [(50, [1.0], 0), (51, [1.0, 2.0, 3.0], 0)]
    assert {r.vec_id for r in whitening.whiten(spark.createDataFrame(mixed, SCHEMA)).collect()} == set(range(9))


def test_numbers_beyond_64_bits_are_an_error(spark):
    vectors = spark.createDataFrame([(1, [1e30, 1.0], 0), (2, [0.0, 1.0], 0)], SCHEMA)
    with pytest.raises(Exception, match="beyond 64 bits"):
        whitening.whiten(vectors).collect()


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_rank_one_updates_equal_numpy(size):
    rng = np.random.default_rng(size)
    for kind in ("plain", "copies", "rank", "scales"):
        x = rng.normal(size=(200, size))
        if kind == "copies":
            x[:90] = x[0]
        if kind == "rank":
            x[:, size // 2 :] = x[:, : size - size // 2]
        if kind == "scales":
            x *= 10.0 ** rng.integers(-5, 5, size)
        one, two = Spectrum.empty(size), Spectrum.empty(size)
        for row in x[:80]:
            one.add(row)
        for row, many in zip(*np.unique(x[80:], axis=0, return_counts=True), strict=True):
            two.add(row, many)
        one.merge(two)
        apart = x - x.mean(0)
        scatter = apart.T @ apart
        top = np.abs(scatter).max()
        assert np.abs(one.vectors * one.values @ one.vectors.T - scatter).max() < 1e-11 * top
        assert np.abs(one.vectors.T @ one.vectors - np.eye(size)).max() < 1e-11
        assert np.abs(one.values - np.linalg.eigvalsh(scatter)).max() < 1e-11 * top
        assert one.n == 200 and np.allclose(one.mean, x.mean(0))


def test_secular_roots_lie_between_poles():
    rng = np.random.default_rng(1)
    for _ in range(100):
        poles = np.cumsum(10.0 ** rng.uniform(-6, 3, 20))
        weights = 10.0 ** rng.uniform(-9, 3, 20)
        roots, apart = secular_roots(poles, weights)
        assert (apart.diagonal() < 0).all()
        assert (np.diagonal(apart, 1) > 0).all()
        error = np.abs(1 + (weights / apart).sum(1)) / (1 + np.abs(weights / apart).sum(1))
        assert error.max() < 1e-12
        assert np.allclose(np.linalg.eigvalsh(np.diag(poles) + np.sqrt(np.outer(weights, weights))), roots)
