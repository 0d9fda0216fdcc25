from fractions import Fraction

import numpy as np
import pytest

from lakeops.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x string, n int, component string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, "clash", 7, "clash") for i, v in data], SCHEMA)


def brute(data, k=16):
    """By numpy's symmetric eigensolver on the exact covariance."""
    ok = [(i, [int(np.floor(64 * float(c))) + 1000000 for c in v]) for i, v in data
          if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in ok})
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    centred = [[n * a - b for a, b in zip(x, s)] for x in fit]
    v = np.array([[float(Fraction(sum(c[i] * c[j] for c in centred), n ** 3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for at, (i, x) in enumerate(ok):
        c = [n * a - b for a, b in zip(x, s)]
        w = (np.array([float(Fraction(q, n)) for q in c]) @ u) / np.sqrt(e)
        out[at] = (i, n, sum(q * q for q in c), w, e / np.trace(v))
    return out


def vectors(seed, n, dim, mean=0.0):
    rng = np.random.default_rng(seed)
    spread = np.linspace(1.5, 0.05, dim)
    return [(i, (mean + rng.normal(0, spread)).tolist()) for i in range(n)]


def compare(spark, data):
    want = sorted(brute(data).values(), key=lambda r: r[0])
    got = {}
    for r in whitening.whiten(frame(spark, data)).collect():
        got.setdefault(r.vec_id, []).append(r)
    assert sorted(got) == [w[0] for w in want]
    rows = [sorted(got[w[0]], key=lambda r: r.component) for w in want]
    assert all([r.component for r in own] == list(range(1, len(want[0][3]) + 1)) for own in rows)
    g, w = np.array([[r.whitened for r in own] for own in rows]), np.array([r[3] for r in want])
    sign = np.sign((g * w).sum(axis=0))
    assert np.abs(g * sign - w).max() < 1e-8 * max(1, np.abs(w).max())
    for own, r in zip(rows, want):
        assert {(o.n, o.deviation) for o in own} == {(r[1], r[2])}
        assert np.allclose([o.explained for o in own], r[4], rtol=1e-10)
    errors = {o.identity_error for own in rows for o in own}
    assert len(errors) == 1 and errors.pop() < 1e-9


@pytest.mark.parametrize("dim,mean", [(24, 0.0), (16, 3e5), (5, -2.0), (1, 0.5)])
def test_matches_a_dense_solver(spark, dim, mean):
    compare(spark, vectors(dim, 150, dim, mean))


def test_repeats_weigh_once(spark):
    data = vectors(3, 60, 6)
    compare(spark, data + [(1000 + i, data[7][1]) for i in range(80)])


def test_dropped_rows_and_null_ids(spark):
    data = vectors(4, 40, 4)
    bad = [(100, None), (101, [None] * 4), (102, [1.0, float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0, 0.0])]
    a = {(r.vec_id, r.component, r.deviation) for r in whitening.whiten(frame(spark, data)).collect()}
    b = {(r.vec_id, r.component, r.deviation) for r in whitening.whiten(frame(spark, data + bad)).collect()}
    assert a == b
    out = whitening.whiten(frame(spark, data[1:] + [(None, data[0][1])])).where("vec_id is null")
    assert out.count() == 4


def test_rank_and_lengths(spark):
    """A copied and a constant dimension add no component; lengths are apart."""
    data = [(i, [v[0], v[1], v[0], 2.5]) for i, v in vectors(5, 50, 2)]
    other = [(1000 + i, v) for i, v in vectors(6, 30, 3)] + [(2000, [])]
    rows = whitening.whiten(frame(spark, data + other)).collect()
    assert {r.component for r in rows if r.vec_id < 1000} == {1, 2}
    assert {r.component for r in rows if 1000 <= r.vec_id < 2000} == {1, 2, 3}
    assert {r.n for r in rows if r.vec_id >= 1000} == {30} and all(r.vec_id < 2000 for r in rows)
    assert max(r.identity_error for r in rows) < 1e-9


def test_few_rows(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [0.5, 0.25])] * 3)).collect() == []
    assert {r.component for r in whitening.whiten(frame(spark, vectors(8, 3, 8))).collect()} == {1, 2}


def test_huge_entries(spark):
    data = [(i, [float(i) * 1e30, float(i % 3)]) for i in range(9)]
    rows = whitening.whiten(frame(spark, data)).collect()
    assert len(rows) == 18 and all(np.isfinite(r.whitened) for r in rows)
    assert {r.deviation for r in rows} == {None}


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for top in (100, 1 << 25, 1 << 40):
        z = rng.integers(-top, top, (200, 5))
        assert (whitening.products(z) == z.astype(object).T @ z.astype(object)).all()


def test_factor_and_rotation():
    rng = np.random.default_rng(2)
    graded = rng.normal(size=(40, 12)) * np.logspace(0, -7, 12)
    v = (graded.T @ graded).astype(np.longdouble)
    order, l = whitening.pivoted_cholesky(v)
    assert np.allclose((l @ l.T).astype(float), v[order][:, order].astype(float), rtol=1e-12, atol=1e-25)
    assert (np.triu(l, 1) == 0).all() and (np.diff(np.diag(l)) <= 0).all()
    turned = whitening.one_sided_jacobi(l).astype(float)
    norms = np.linalg.norm(turned, axis=0)
    cosines = (turned / norms).T @ (turned / norms)
    assert np.abs(cosines - np.eye(12)).max() < 1e-14
    assert np.allclose(np.sort(norms), np.sort(np.linalg.svd(graded, compute_uv=False)), rtol=1e-9)
