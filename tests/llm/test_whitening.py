"""Whitening against numpy's eigenvectors of the covariance, exact sums, and vectors that take no part."""

import math

import numpy as np
import pytest

from ledgerloom.llm import whitening
from ledgerloom.llm.common import written


def brute(vectors, components=4):
    """Results per vector from the plain covariance of the distinct grid rows."""
    ok = [(i, [math.floor(256 * c) for c in v]) for i, v in vectors
          if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(x) for _, x in ok}), dtype=float)
    mean = distinct.mean(axis=0)
    values, axes = np.linalg.eigh((distinct - mean).T @ (distinct - mean) / len(distinct))
    order = [k for k in np.argsort(-values) if values[k] > values.max() * 1e-12][:components]
    n, sums = len(distinct), [int(s) for s in distinct.sum(axis=0)]
    return n, {(i, tuple(x)): (sum((n * a - b) ** 2 for a, b in zip(x, sums)),
               [((np.array(x) - mean) @ axes[:, k] / math.sqrt(values[k]), values[k] / values.sum()) for k in order]) for i, x in ok}


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, -1.0, 7) for i, v in vectors], "vec_id long, embedding array<double>, whitened double, n int").repartition(3)


def drawn(rows, size, rank=None, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(rows, rank or size)) @ (rng.normal(size=(rank or size, size)) * np.linspace(3, 0.1, size))
    return [(i, [float(c) for c in v]) for i, v in enumerate(base)]


def compare(spark, vectors, components=4):
    got = whitening.whiten(frame(spark, vectors), components).collect()
    n, expected = brute(vectors, components)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(got) == sum(len(parts) for _, parts in expected.values())
    signs = {}
    for (i, x), (deviation, parts) in expected.items():
        rows = by_row[(i, deviation)]
        assert sorted(rows) == list(range(1, len(parts) + 1))
        for k, (value, explained) in enumerate(parts, 1):
            r = rows[k][0]
            assert r.n == n and r.explained == pytest.approx(explained, rel=1e-8) and r.identity_error < 1e-8
            if abs(value) > 1e-6:
                sign = signs.setdefault(k, math.copysign(1, value * r.whitened))
                assert r.whitened == pytest.approx(sign * value, abs=1e-6)
    return got


def test_components_match_the_covariance(spark):
    compare(spark, drawn(400, 12))


def test_ill_conditioned_and_low_rank_rows(spark):
    compare(spark, drawn(200, 10, rank=3))
    stretched = [(i, [c * 10.0 ** (3 - k) for k, c in enumerate(v)]) for i, v in drawn(300, 5)]
    compare(spark, stretched, components=3)


def test_rows_that_take_no_part_and_repeated_rows(spark):
    vectors = drawn(60, 4)
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [1.0, float("nan"), 2.0, 3.0]),
           (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [1e300, 0.0, 0.0, 0.0]), (906, [1.0, 2.0])]
    twice = vectors + [(500 + i, v) for i, v in vectors[:20]] + vectors[:5] + [(None, vectors[0][1])]
    got = whitening.whiten(frame(spark, twice + odd)).collect()
    assert {r.vec_id for r in got} == {i for i, _ in twice} and len(got) == 4 * len(twice)
    assert {r.n for r in got} == {60}
    n, expected = brute(vectors)
    assert {(r.vec_id, r.deviation) for r in got} >= {(i, d) for (i, _), (d, _) in expected.items()}


def test_constant_columns_few_rows_and_empty_tables(spark):
    compare(spark, [(i, [float(i), 5.0, -float(i * i)]) for i in range(6)])
    assert len(whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [0.0, 2.0])])).collect()) == 2
    for few in ([], [(1, [1.0, 2.0])], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whiten(frame(spark, few))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_are_exact(spark):
    big = [(i, [float(2 ** 40 + i), float(-(2 ** 41) + 3 * i * i)]) for i in range(9)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, big)).collect()}
    xs = [[256 * int(c) for c in v] for _, v in big]
    sums = [sum(x[k] for x in xs) for k in range(2)]
    assert got == {i: sum((9 * a - s) ** 2 for a, s in zip(xs[i], sums)) for i in range(9)}
    far = [(0, [2.0 ** 44, 0.0]), (1, [-(2.0 ** 44), 1.0]), (2, [0.0, 5.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame(spark, far)).collect()}
    assert got[0] is None and got[1] is None and got[2] is not None


def test_factor_is_triangular_and_reproduces_the_products(spark):
    rows = written(frame(spark, drawn(150, 6)).select(whitening.on_grid(frame(spark, drawn(1, 6)), "embedding").alias("x")), "t")
    x = np.array([r.x for r in rows.collect()])
    r = whitening.factor(rows, len(x), [int(s) for s in x.sum(axis=0)])
    c = x - x.mean(axis=0)
    assert np.allclose(r.T @ r, c.T @ c, rtol=1e-10)
    upper = np.triu(np.random.default_rng(1).normal(size=(6, 6))) + 4 * np.eye(6)
    assert np.allclose(whitening.solve(c, upper) @ upper, c)
