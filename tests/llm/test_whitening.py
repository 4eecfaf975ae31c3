"""Jacobi-Davidson and whitening against a dense eigensolver."""

import numpy as np
import pytest

from orderloom.llm import whitening


@pytest.mark.parametrize("dims, spectrum", [(64, "flat"), (40, "falling"), (3, "falling"), (30, "equal"), (20, "low")])
def test_jacobi_davidson(dims, spectrum):
    rng = np.random.default_rng(dims)
    q, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    e = {"flat": 1 + rng.random(dims) / 2, "falling": 0.6 ** np.arange(dims), "equal": np.ones(dims),
         "low": np.r_[3.0, 2.0, 1.0, np.zeros(dims - 3)]}[spectrum]
    a = (q * e) @ q.T
    values, vectors = whitening.jacobi_davidson(lambda b: a @ b, dims, 8)
    k = min(8, dims)
    assert np.allclose(values, np.sort(e)[::-1][:k], atol=1e-13)
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-13
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)


def test_minres_solves():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    b = rng.standard_normal((12, 3))
    b[:, 1] = 0
    assert np.allclose(a @ whitening.minres(lambda x: a @ x, b, 60, 1e-14), b, atol=1e-8)


def frame(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if e is None else float(e) for e in v], 7, "n")
            for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, x int, n string").repartition(3)


def test_against_dense(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((300, 12)).astype(np.float32) * np.linspace(0.1, 2, 12, dtype=np.float32)
    bad = [None, [None] * 12, [float("nan")] * 12, [float("inf")] * 12, [1.0] * 5, [], [3e38] * 12]
    got = whitening.whiten(frame(spark, [*v, *bad, v[0]], [*range(300), *range(900, 907), None])).collect()
    assert len(got) == 301 * 8 and {r.vec_id for r in got} == {None, *range(300)}
    x = np.floor(1024 * np.vstack([v, v[:1]]).astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    white = np.zeros((300, 8))
    for r in got:
        assert r.n == n and r.identity_error < 1e-10
        assert abs(r.explained / (e[r.component - 1] / np.trace(cov)) - 1) < 1e-10
        if r.vec_id is not None:
            white[r.vec_id, r.component - 1] = r.whitened
            assert r.deviation == ((n * x[r.vec_id] - s) ** 2).sum()
    want = c[:300] @ u / np.sqrt(e)
    assert np.abs(white * np.sign((white * want).sum(axis=0)) - want).max() < 1e-9


def test_large_integers_are_exact(spark):
    v = [[1e9, 0.5], [-1e9, 0.25], [3.0, 1.0]]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, v)).where("component = 1").collect()}
    x = [[int(np.floor(1024 * np.float64(np.float32(e)))) + 100_000 for e in r] for r in v]
    s = [sum(c) for c in zip(*x)]
    for i, r in enumerate(x):
        want = sum((3 * e - t) ** 2 for e, t in zip(r, s))
        assert got[i] == (want if want < 1 << 63 else None)


def test_no_variance(spark):
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 4)).collect() == []
    assert whitening.whiten(frame(spark, [[]])).collect() == []
    assert whitening.whiten(frame(spark, [[1.0, 2.0]]).where("false")).collect() == []
    one = whitening.whiten(frame(spark, [[1.0, 2.0], [3.0, 2.0]])).collect()
    assert [r.component for r in one] == [1, 1] and {round(r.whitened, 9) for r in one} == {1.0, -1.0}
