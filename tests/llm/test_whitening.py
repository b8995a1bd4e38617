"""op12: components, scores and certificates against a dense eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest

from palabre.llm.whitening import (
    chebyshev_filter,
    fit_whitening,
    scaled_vectors,
    subspace_iteration,
    whiten,
    whiten_embeddings,
)

SCHEMA = "vec_id long, embedding array<float>, x string, d string"


def frame(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", "d") for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def covariance(vectors):
    x = np.floor(1024 * np.asarray(vectors, np.float32).astype(float)) + 100_000
    centred = x - x.mean(axis=0)
    return x, centred, centred.T @ centred / len(x)


def test_filter_is_a_chebyshev_polynomial():
    rnd = np.random.default_rng(1)
    values = np.array([9.0, 5.0, 2.0, 1.5, 0.3, 0.0])
    basis, _ = np.linalg.qr(rnd.standard_normal((6, 6)))
    matrix = basis * values @ basis.T
    out = chebyshev_filter(lambda q: matrix @ q, basis, matrix @ basis, 2.0, 7)
    ours = np.abs(np.diag(basis.T @ out))
    t = np.abs(np.polynomial.chebyshev.chebval(values - 1, [0] * 7 + [1]))
    assert np.allclose(ours / ours[0], t / t[0], rtol=1e-9, atol=1e-12)
    # At most 1 on the unwanted part, large above.
    assert (t[2:] <= 1 + 1e-9).all() and t[1] > 1e5


@pytest.mark.parametrize("gap", [0.5, 0.97])
def test_iteration_finds_the_largest_eigenvalues(gap):
    rnd = np.random.default_rng(2)
    values = gap ** np.arange(90)
    basis, _ = np.linalg.qr(rnd.standard_normal((90, 90)))
    matrix = basis * values @ basis.T
    found, vectors, residual = subspace_iteration(lambda q: matrix @ q, 90)
    assert residual < 1e-13 and np.allclose(found, values[:8], rtol=1e-12)
    assert np.allclose(np.abs(np.sum(vectors * basis[:, :8], axis=0)), 1, atol=1e-12)


def test_whitened_rows(spark):
    rnd = np.random.default_rng(3)
    vectors = rnd.standard_normal((400, 40)) * np.linspace(2, 0.1, 40) + 3
    x, centred, v = covariance(vectors)
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1][:8], basis[:, ::-1][:, :8]
    rows = scaled_vectors(frame(spark, vectors))
    model = fit_whitening(rows)
    assert np.allclose(model.values, values, rtol=1e-12) and model.residual < 1e-13
    assert model.n == 400 and model.sums == tuple(int(s) for s in x.sum(axis=0))
    got = whiten(rows, model).toPandas().sort_values(["vec_id", "component"])
    z = got["whitened"].to_numpy().reshape(400, 8)
    want = centred @ basis / np.sqrt(values)
    assert np.allclose(np.abs(z), np.abs(want), atol=1e-9)
    assert np.allclose(z.T @ z / 400, np.eye(8), atol=1e-9) and (got["identity_error"] < 1e-9).all()
    assert np.allclose(got["explained"].to_numpy()[:8], values / np.trace(v), rtol=1e-9)
    exact = [sum((400 * int(c) - s) ** 2 for c, s in zip(row, model.sums)) for row in x]
    assert got["deviation"].tolist()[::8] == exact


def test_short_vectors_take_few_passes(spark):
    """The covariance is summed once; longer vectors are multiplied by passes, to the same components."""
    vectors = np.random.default_rng(4).standard_normal((300, 48)) * np.linspace(2, 1, 48)
    rows = scaled_vectors(frame(spark, vectors))
    formed, passed = fit_whitening(rows), fit_whitening(rows, widest=47)
    assert formed.passes <= 2 < passed.passes
    assert np.allclose(formed.values, passed.values, rtol=1e-12) and max(formed.residual, passed.residual) < 1e-13
    assert np.allclose(np.abs(np.sum(formed.vectors * passed.vectors, axis=0)), 1, atol=1e-10)
    assert np.isclose(formed.trace, passed.trace, rtol=1e-12) and formed.identity_error < 1e-9


def test_odd_rows(spark):
    """Unusable vectors go; equal or single ones have no component; repeated rows count each."""
    nan, inf = float("nan"), float("inf")
    good = [[1, 2, 0], [2, 1, 0], [4, 4, 0], [0, 3, 0], [0, 3, 0]]
    bad = [None, [], [1, None, 2], [nan, 0, 0], [0, inf, 0], [1e30, 0, 0], [1, 2], [1, 2, 3, 4]]
    df = frame(spark, good + bad, [1, 2, None, 4, 4, *range(10, 18)])
    rows = whiten_embeddings(df).collect()
    # The third entry never varies: two components.
    assert len(rows) == 10 and {r.component for r in rows} == {1, 2} and {r.n for r in rows} == {5}
    assert sorted({r.vec_id for r in rows}, key=str) == [1, 2, 4, None]
    assert abs(sum({r.component: r.explained for r in rows}.values()) - 1) < 1e-9
    assert whiten_embeddings(frame(spark, [[1, 2]])).count() == 0
    assert whiten_embeddings(frame(spark, [[1, 2]] * 4)).count() == 0
    assert whiten_embeddings(df.limit(0)).count() == 0
    assert whiten_embeddings(df.filter("embedding is null")).count() == 0


def test_deviations_beyond_a_long(spark):
    rows = whiten_embeddings(frame(spark, [[-4e12], [4e12], [4e12]])).collect()
    assert [r.deviation for r in rows] == [None] * 3 and {r.n for r in rows} == {3}
    assert sorted(round(r.whitened, 6) for r in rows) in ([-1.414214, 0.707107, 0.707107], [-0.707107, -0.707107, 1.414214])
