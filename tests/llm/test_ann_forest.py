import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import ann_forest as af

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, v string, leaf string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 0.5, 9, "x", "y") for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors, k):
    good = {i: np.array(v, dtype=np.float32).astype(float) for i, v in vectors
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8}
    out = {}
    for q in good:
        if q % 5 == 0:
            s = sorted((-float((v @ good[q]) / np.sqrt((v @ v) * (good[q] @ good[q]))), i) for i, v in good.items() if i != q)
            out[q] = s[:k]
    return out


def messy():
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in np.float32(rng.standard_normal(8))]) for i in range(400)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(150)]             # a hot vector: ties by id
    vectors += [(2000, None), (2005, [0.0] * 8), (2010, [float("nan")] + [1.0] * 7), (2015, [float("inf")] * 8), (2020, [None] + [1.0] * 7),
                (2025, []), (2030, [1.0, 2.0]), (None, [1.0] * 8)]
    return vectors


def test_forest_that_opens_all_leaves_is_exact(spark):
    vectors = messy()
    got = {}
    for r in af.neighbours(table(spark, vectors), F.col("vec_id") % 5 == 0, recall=1.0, leaf=16, block=50).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = brute(vectors, 5)
    assert set(got) == set(expected)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and q not in [i for _, i, _ in found]
        scores = [s for _, _, s in found]
        assert scores == sorted(scores, reverse=True)
        for _, i, s in found:
            hits += any(i == j and abs(s + t) < 1e-12 for t, j in expected[q])
    assert hits >= 0.97 * 5 * len(expected)
    # equal vectors are ordered by id
    assert [i for _, i, _ in got[0]] == [1000, 1001, 1002, 1003, 1004]


def test_few_and_no_candidates(spark):
    two = af.neighbours(table(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0])]), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in two] == [(0, 1, 1)] and abs(two[0].score - 0.5 ** 0.5) < 1e-12
    assert af.neighbours(table(spark, [(0, [1.0, 0.0])]), F.col("vec_id") == 0).collect() == []
    assert af.neighbours(table(spark, [(0, None)]), F.col("vec_id") == 0).collect() == []
    repeated = af.neighbours(table(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])]), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.vec_id) for r in repeated] == [(0, 1)]


def test_recall_on_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((30, 8))
    vectors = [(i, [float(x) for x in np.float32(centre[i % 30] + 0.3 * rng.standard_normal(8))]) for i in range(3000)]
    expected = brute(vectors, 5)
    found = {(r.query_id, r.vec_id) for r in af.neighbours(table(spark, vectors), F.col("vec_id") % 5 == 0).collect()}
    assert sum((q, i) in found for q, near in expected.items() for _, i in near) >= 0.9 * 5 * len(expected)


def test_scores_of_extreme_vectors(spark):
    rng = np.random.default_rng(8)
    plain = rng.standard_normal((60, 8))
    size = [1e-300, 1e-200, 1.0, 1e200, 1e300, 3e-320]
    data = [(i, [float(x) for x in v * size[i % 6]]) for i, v in enumerate(plain)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = af.neighbours(frame, F.col("vec_id") % 5 == 0, recall=1.0).collect()
    exact = np.array([[x / max(map(abs, v)) for x in v] for _, v in data])
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    assert len(got) == 60
    for q in range(0, 60, 5):
        near = exact @ exact[q]
        near[q] = -2
        found = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [i for _, i, _ in found] == list(np.argsort(-near)[:5])
        assert all(abs(s - near[i]) < 1e-12 for _, i, s in found)
