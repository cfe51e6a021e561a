"""Whitening against numpy on the whole matrix and against exact fractions."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from odpanel.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x string, w0 string, n string, cell string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "w", "n", "c") for i, v in vectors], SCHEMA)


def exact(vectors):
    """n, S, exact covariances and the deviations, by fractions."""
    xs = {i: [math.floor(256 * c) for c in v] for i, v in vectors}
    fit = sorted({tuple(x) for x in xs.values()})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    cov = [[float(Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit), n ** 3))
            for b in range(d)] for a in range(d)]
    dev = {i: sum((n * x[k] - sums[k]) ** 2 for k in range(d)) for i, x in xs.items()}
    return n, sums, np.array(cov), dev, xs


def check(rows, vectors, count):
    n, sums, cov, dev, xs = exact(vectors)
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    assert len(rows) == len(vectors) * count
    signs = {}
    for r in rows:
        k = r.component - 1
        assert r.n == n
        assert r.deviation_exact == (dev[r.vec_id] if dev[r.vec_id] < 10 ** 38 else None)
        assert r.deviation == (dev[r.vec_id] if dev[r.vec_id] < 1 << 63 else None)
        assert r.explained == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
        centred = np.array([float(Fraction(n * x - s, n))
                            for x, s in zip(xs[r.vec_id], sums, strict=True)])
        want = centred @ vecs[:, k] / math.sqrt(values[k])
        if abs(want) > 1e-6:
            sign = signs.setdefault(k, np.sign(want * r.whitened))
            assert r.whitened * sign == pytest.approx(want, rel=1e-6, abs=1e-7)
        assert r.identity_error < 1e-9


def test_random_vectors(spark):
    rng = random.Random(3)
    vectors = [(i, [rng.gauss(0.2 * k, 0.1 + k) for k in range(6)]) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(50)]        # copies count once
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors, 4)


def test_large_entries_are_exact(spark):
    rng = random.Random(4)
    for size in (1e9, 1e14, 1e16):
        vectors = [(i, [rng.uniform(-size, size) for _ in range(3)]) for i in range(40)]
        check(whitening.whiten(frame(spark, vectors)).collect(), vectors, 3)


def test_left_out_rows_and_odd_shapes(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [0.5, 1.0]), (2, [1.5, -2.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]),
               (6, [inf, 0.0]), (7, [-0.0, 0.25]), (None, [1.0, 1.0]), (1, [3.0, 0.5]),
               (8, [2.0])]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert sorted((r.vec_id or 0) for r in rows) == sorted([1, 1, 2, 7, 0, 1, 1, 2, 7, 0, 8, 8])
    assert {r.n for r in rows} == {6}
    same = whitening.whiten(frame(spark, [(i, [0.5, 0.5]) for i in range(3)])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {
        (1, 0, None, 0.0, None)}
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(frame(spark, [])).collect() == []


def test_limbs_hold_any_sum():
    for total in (0, 1, -1, 2 ** 90 + 7, -(2 ** 300) + 5):
        assert sum(v << (whitening.LIMB * k)
                   for k, v in enumerate(whitening._limbs(total))) == total
    rng = np.random.default_rng(1)
    m = rng.integers(-(1 << 61), 1 << 61, (50, 3))
    assert whitening._square_sums(m) == [sum(int(x) ** 2 for x in m[:, k]) for k in range(3)]
    small = m >> 40
    assert whitening._square_sums(small) == [sum(int(x) ** 2 for x in small[:, k])
                                             for k in range(3)]
    assert whitening._sums(m) == [sum(int(x) for x in m[:, k]) for k in range(3)]


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    check(whitening.whiten(df).collect(), vectors, 4)
