"""Whitening against a dense eigenvalue solver, with edge cases."""

import math

import numpy as np
import pytest
from conftest import SMALL

from tablemill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component string"


def brute(vectors, count=4):
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for v in good), default=0)
    x = [[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (d - len(v)) for v in good]
    fit = [list(r) for r in set(map(tuple, x))]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    cov = (np.array(fit, float) - mean).T @ (np.array(fit, float) - mean) / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    return {
        "n": n, "deviation": [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x],
        "e": e[:count], "trace": np.trace(cov), "white": (np.array(x, float) - mean) @ v[:, :count],
    }


def check(spark, vectors, close=1e-9):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in enumerate(vectors)], SCHEMA).repartition(3)
    rows = whitening.whiten(df).collect()
    want = brute(vectors)
    good = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    k = len(want["e"])
    assert len(rows) == k * len(good) and len({r.identity_error for r in rows}) == 1
    by = {(r.vec_id, r.component): r for r in rows}
    live = [c for c in range(k) if want["e"][c] > 1e-9 * max(want["trace"], 1)]
    for c in range(k):
        got = [by[i, c + 1] for i in good]
        assert [r.n for r in got] == [want["n"]] * len(good)
        assert [r.deviation for r in got] == want["deviation"]
        if c not in live:
            assert all(r.whitened is None and r.explained == 0 for r in got)
            continue
        assert abs(got[0].explained - want["e"][c] / want["trace"]) < 1e-10
        distance = np.array([r.whitened for r in got])
        alone = all(abs(want["e"][c] - o) > 1e-6 * want["e"][c] for j, o in enumerate(want["e"]) if j != c)
        if alone:
            theirs = want["white"][:, c] / math.sqrt(want["e"][c])
            assert min(np.abs(distance - theirs).max(), np.abs(distance + theirs).max()) < close
    if live:
        assert rows[0].identity_error < 1e-9


def test_random(spark):
    rng = np.random.default_rng(1)
    check(spark, [[float(x) for x in row] for row in rng.normal(size=(300, 12)) * np.linspace(1, 3, 12)])


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    some = [[0.1, 0.2, -0.5], None, [nan, 0.0, 0.0], [inf, 1.0, 1.0], [None, 1.0, 1.0], [0.1, 0.2, -0.5], [], [0.0, 0.0, 0.0], [1.0], [1e30, 0.5]]
    check(spark, some[:9])
    rows = whitening.whiten(spark.createDataFrame([(None, v, "", "") for v in some], SCHEMA)).collect()
    # Entries beyond 64 bits take the end of their range; no exact square of those fits 64 bits.
    assert len(rows) == 3 * 6 and all(r.n == 4 and r.vec_id is None for r in rows)
    assert any(r.deviation is None for r in rows)


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 5, [[0.0] * 6] * 2, [[float(i)] for i in range(9)], [[i * 0.5] * 3 for i in range(7)]])
def test_without_variance(spark, vectors):
    check(spark, vectors)


def test_equal_eigenvalues(spark):
    """Any basis of the shared space, the same for all rows."""
    vectors = [[s if i == j else 0.0 for j in range(6)] for i in range(6) for s in (2.0, -2.0)]
    check(spark, vectors)


def test_nothing_usable(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "", ""), (2, [], "", "")], SCHEMA)).count() == 0


def test_rounds_of_triangles(spark, monkeypatch):
    """More tasks than one round takes, and blocks of a few rows."""
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", 24)
    rng = np.random.default_rng(5)
    check(spark, [[float(x) for x in row] for row in rng.normal(size=(120, 8))])


def test_embeddings(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id")
    check(spark, [r.embedding for r in df.collect()])


def test_solver():
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 9, 40, 120):
        for kind in range(6):
            a = rng.normal(size=(3 * max(d, 3), d))
            if kind == 1:
                a = a * np.logspace(0, -14, d)
            elif kind == 2:
                a[:, d // 2 :] = a[:, :1]
            elif kind == 3:
                a = np.zeros((d, d))
            elif kind == 4:
                a = np.vstack([np.eye(d)] * 2)
            elif kind == 5:
                a = np.round(a * 2) * 1e150
            r = np.linalg.qr(a, mode="r")
            r = np.vstack([r, np.zeros((d - len(r), d))])
            roots, v = whitening.directions(r, min(4, d))
            scale = max(np.abs(r).max(), 1e-300)
            s = np.linalg.svd(r / scale, compute_uv=False)
            assert np.abs(np.sqrt(roots) / scale - s).max() < 1e-13 * max(s[0], 1)
            assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-12
            left = (r / scale).T @ (r / scale @ v) - v * (roots[: v.shape[1]] / scale / scale)
            assert np.abs(left).max() < 1e-12 * max(s[0], 1) ** 2


def test_small_singular_values():
    """Graded matrices: small values to full relative accuracy (exact ones by fractions)."""
    from fractions import Fraction

    a, b = np.array([1.0, 1e-5, 1e-10]), np.array([1e-3, 1e-8])
    roots = whitening.dqds(a, b)
    product = Fraction(1)
    for x in a:
        product *= Fraction(float(x)) ** 2
    assert abs(math.prod(roots) / float(product) - 1) < 1e-14
