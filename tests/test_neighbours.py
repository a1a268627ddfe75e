"""Exact neighbours with bounds against all pairs."""

import numpy as np
import pytest

from cytoloom.operators import knn


def brute(points, k):
    ids, v = np.array([p[0] for p in points]), np.array([p[1] for p in points], float)
    out = set()
    for i, row in enumerate(v):
        d = ((row - v) ** 2).sum(axis=1)
        near = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out |= {(int(ids[i]), int(ids[j]), round(float(d[j]), 9), r + 1) for r, j in enumerate(near)}
    return out


def clustered(n=1500, clusters=12, dims=16, seed=2):
    rng = np.random.default_rng(seed)
    centers = 10 * rng.standard_normal((clusters, dims))
    return [(int(i), (centers[rng.integers(clusters)] + rng.standard_normal(dims)).tolist()) for i in rng.permutation(n)]


def found(spark, points, k, **how):
    df = spark.createDataFrame(points, "id long, vec array<double>").repartition(5)
    return {(r["a"], r["b"], round(r["d2"], 9), r["rk"]) for r in knn.knn(df, k, **how).collect()}


def test_clustered_points_visit_less_than_half(spark):
    points, report = clustered(), {}
    assert found(spark, points, 6, block=100, report=report) == brute(points, 6)
    assert report["blocks"] >= 15 and report["visits"] < 0.5 * report["of"], report


def test_copies_ties_and_far_rows(spark):
    """A third are copies of one row, many distances tie, and some rows are far from all."""
    rng = np.random.default_rng(5)
    points = [[0.0, 0.0, 0.0]] * 150 + rng.integers(0, 4, (250, 3)).astype(float).tolist() + [[1e6, 0.0, 0.0], [0.0, -1e6, 3.0], [1e6, 1.0, 0.0]]
    points = list(enumerate(points))
    report = {}
    assert found(spark, points, 5, block=40, report=report) == brute(points, 5)
    assert report["blocks"] >= 10


@pytest.mark.parametrize("whole", [2**22, 2000])
def test_rows_of_many_dimensions_move_once_for_each_large_block(spark, monkeypatch, whole):
    """Bounds rule out nothing there, so no row is sent to each of the small blocks."""
    monkeypatch.setattr(knn, "WHOLE", whole)
    rng = np.random.default_rng(7)
    points = rng.standard_normal((700, 32))
    points[600:] = points[5]
    points = list(enumerate((points / np.linalg.norm(points, axis=1, keepdims=True)).tolist()))
    asked = []
    all_pairs = knn._all_pairs
    monkeypatch.setattr(knn, "_all_pairs", lambda *a: asked.append(1) or all_pairs(*a))
    assert found(spark, points, 6, block=40) == brute(points, 6) and asked


def test_targets_far_from_the_origin_and_copies(spark):
    rng = np.random.default_rng(8)
    v = 1e7 + rng.standard_normal((300, 8))
    v[100:200] = v[0]
    assert len(knn._targets(np.arange(300), v, 4)) == 204
    points = list(enumerate(v.tolist()))
    assert found(spark, points, 5, block=30) == brute(points, 5)


@pytest.mark.parametrize(("n", "k", "block"), [(1, 3, 10), (4, 9, 2), (30, 12, 5), (60, 3, 60)])
def test_few_points(spark, n, k, block):
    points = clustered(n, 3, 4, n)
    assert found(spark, points, k, block=block) == brute(points, k)


def test_nothing(spark):
    assert found(spark, [], 3) == set()
