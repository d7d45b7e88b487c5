"""op11 against numpy's eigenvectors, and its parts on matrices that are hard for them."""

import numpy as np
import pytest

from tessella.llm import whitening as w

KIND = "vec_id long, embedding array<double>, cell string, x int, n int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "a", 1, 2) for i, v in enumerate(vectors)], KIND)


def matrix(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 2, 2, 1, 0, 0], [1e6, 1, 1 - 1e-9, 1e-3, 1e-6], list(np.linspace(60, 70, 40)), [150, *np.linspace(66, 66.5, 63)]])
def test_components_are_the_eigenvectors(values):
    v = matrix(np.random.default_rng(3), np.array(values, float))
    e, u = w.top_components(v, 4)
    want = np.sort(values)[::-1][: len(e)]
    assert len(e) == min(4, int((np.array(values) > 0).sum()))
    assert np.allclose(e, want, rtol=1e-9, atol=1e-9 * want[0])
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12
    assert np.linalg.norm(v @ u - u * e, axis=0).max() < 1e-11 * max(values)


def test_inertia_counts_also_where_the_diagonal_is_zero():
    assert w.inertia_above(np.array([[0.0, 1], [1, 0]]), 0) == 1
    assert w.inertia_above(np.zeros((3, 3)), 0) == 0
    v = matrix(np.random.default_rng(1), np.arange(20.0))
    assert [w.inertia_above(v, s - 0.5) for s in (0, 5, 19, 20)] == [20, 15, 1, 0]


def test_rows_equal_plain_whitening(spark):
    rng = np.random.default_rng(5)
    vectors = [list(v) for v in rng.standard_normal((300, 20)) @ np.diag(np.linspace(0.1, 1, 20))]
    vectors += vectors[:40] + [None, [float("nan")] * 20, [None] * 20, [float("inf")] * 20, [1.0] * 3]
    got = w.whiten(frame(spark, vectors)).collect()
    x = np.array([np.floor(64 * np.array(v)).astype(int) + 1000000 for v in vectors[:340]])
    fit = np.unique(x, axis=0)
    v = np.cov(fit.T, bias=True)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    assert len(got) == 340 * 16 and {r.vec_id for r in got} == set(range(340))
    white = (x - fit.sum(0) / len(fit)) @ u / np.sqrt(e)
    mine = np.zeros((340, 16))
    for r in got:
        mine[r.vec_id, r.component - 1] = r.whitened
        assert r.n == len(fit) and r.identity_error < 1e-9
        assert r.deviation == int(((len(fit) * x[r.vec_id] - fit.sum(0)) ** 2).sum()) == int(r.deviation_wide)
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12
    signs = np.sign((mine * white).sum(0))
    assert np.abs(mine - white * signs).max() < 1e-8


def test_few_vectors_have_few_components_and_none_have_none(spark):
    assert {r.component for r in w.whiten(frame(spark, [[1, 0, 0], [0, 1, 0], [1, 1, 0]])).collect()} == {1, 2}
    for few in ([], [None], [[1, 2]], [[1, 2], [1, 2]], [[]], [[float("nan")]]):
        out = w.whiten(frame(spark, few))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide"] and out.count() == 0


def test_large_numbers_stay_exact(spark):
    vectors = [[1e12, 0.0], [0.0, 5e11], [0.0, 0.0]]
    x = [[int(64 * c) + 1000000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in w.whiten(frame(spark, vectors)).collect():
        want = sum((3 * c - s) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True))
        assert int(r.deviation_wide) == want and r.deviation is None
