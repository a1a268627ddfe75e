"""The neighbour map: its curve, weights, graph, and what of the neighbours it keeps."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoloom.operators import embedding, knn, neighbour_map
from cytoloom.plans import catalog

from test_neighbours import clustered


def test_curve_is_the_least_squares_fit():
    x = np.linspace(0, 3, 300)[1:]
    y = np.where(x < 0.5, 1.0, np.exp(-(x - 0.5)))
    off = lambda a, b: ((1 / (1 + a * x ** (2 * b)) - y) ** 2).sum()
    a, b = neighbour_map.curve(0.5)
    assert (round(a, 2), round(b, 2)) == (0.58, 1.33) and all(off(a, b) <= off(a * s, b * t) for s in (0.99, 1, 1.01) for t in (0.99, 1, 1.01))


def test_weights_add_up_to_the_chosen_total():
    rng = np.random.default_rng(1)
    d = np.sort(rng.random((50, 15)) + 0.1, axis=1)
    w = neighbour_map.memberships(d, 15)
    assert np.abs(w.sum(axis=1) - math.log2(15)).max() < 1e-6 and (w[:, 0] == 1).all() and (np.diff(w, axis=1) <= 0).all()
    copies = neighbour_map.memberships(np.array([[0.0, 0, 0], [0, 0, np.inf], [np.inf] * 3]), 3)
    assert copies.tolist() == [[1, 1, 1], [1, 1, 0], [0, 0, 0]]


def test_graph_has_each_pair_once(spark):
    points = spark.createDataFrame(clustered(200, 4, 5), "id long, vec array<double>")
    near = knn.knn(points, 6).cache()
    rows = neighbour_map.fuzzy_graph(near, 6).collect()
    directed = {}
    for a in {r["a"] for r in near.collect()}:
        mine = sorted((r["rk"], r["b"], r["d2"]) for r in near.where(F.col("a") == a).collect()) if a < 20 else None
        if mine:
            w = neighbour_map.memberships(np.sqrt([[m[2] for m in mine]]), 6)[0]
            directed |= {(a, m[1]): x for m, x in zip(mine, w)}
    got = {frozenset((r["a"], r["b"])): r["w"] for r in rows}
    assert len(got) == len(rows) == len({frozenset((r["a"], r["b"])) for r in near.collect()})
    for (a, b), u in directed.items():
        if b < 20:
            v = directed.get((b, a), 0.0)
            assert abs(got[frozenset((a, b))] - (u + v - u * v)) < 1e-12
    assert max(np.unique([r["a"] for r in rows], return_counts=True)[1]) <= 6


@pytest.fixture(scope="module")
def crowd(spark):
    """Points of 20 groups in 12 dimensions, their neighbours, and their first two principal components."""
    points = clustered(600, 20, 12, 3)
    v = np.array([p for _, p in points])
    c = v - v.mean(axis=0)
    start = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    near = knn.knn(spark.createDataFrame(points, "id long, vec array<double>"), 10).cache()
    return near, spark.createDataFrame([(i, float(x), float(y)) for (i, _), (x, y) in zip(points, start)], "id long, x double, y double").cache()


@pytest.mark.parametrize("block", [4096, 150])
def test_keeps_more_neighbours_than_principal_components(spark, crowd, block):
    near, start = crowd
    graph = neighbour_map.fuzzy_graph(near, 10).cache()
    plane = lambda p: knn.knn_plane(p, 10)
    before = neighbour_map.kept(near, plane(start))
    after = neighbour_map.kept(near, plane(neighbour_map.layout(graph, start, rounds=10, block=block)))
    print(block, before, after)
    assert after > before + 0.05


def test_same_map_for_any_partitioning(spark, crowd):
    near, start = crowd
    graph = neighbour_map.fuzzy_graph(near, 10).cache()
    runs = [sorted(map(tuple, neighbour_map.layout(graph.repartition(p), start.repartition(p), rounds=2, epochs=8, block=100).collect())) for p in (1, 5)]
    assert runs[0] == runs[1]


def test_hubs_lone_points_and_nothing(spark):
    hub = spark.createDataFrame([(i, 0, 1.0) for i in range(1, 300)], "a long, b long, w double")
    start = spark.range(301).selectExpr("id", "cos(id) as x", "sin(id) as y")
    got = {r["id"]: r for r in neighbour_map.layout(hub, start, rounds=3, epochs=12, block=40).collect()}
    assert len(got) == 301 and all(math.isfinite(r["x"]) for r in got.values())
    assert (got[300]["x"], got[300]["y"]) == pytest.approx(tuple(10 / max(max(abs(math.cos(i)), abs(math.sin(i))) for i in range(301)) * f(300) for f in (math.cos, math.sin)))
    assert neighbour_map.layout(hub.limit(0), start.limit(0)).count() == 0
    assert neighbour_map.layout(hub.limit(0), start).count() == 301


def test_query_places_all_vectors(spark, sf):
    got = catalog.QUERIES["m3_neighbour_map"](spark, sf)
    points = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    near = knn.knn(points, 14).cache()
    v = np.array([r["vec"] for r in points.orderBy("id").collect()], float)
    c = v - v.mean(axis=0)
    plane = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    before = neighbour_map.kept(near, knn.knn_plane(spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(plane)], "id long, x double, y double"), 14))
    assert got.count() == len(v) and neighbour_map.kept(near, knn.knn_plane(got, 14)) > 1.5 * before


def test_cells_of_one_kind_meet_in_the_map(spark):
    """Three kinds of cells by their genes; one cell without counts."""
    rng = np.random.default_rng(8)
    rows = [(f"c{i}", f"g{10 * (i % 3) + g}", int(rng.integers(1, 9))) for i in range(150) for g in rng.choice(10, 7, replace=False)]
    counts, genes = spark.createDataFrame(rows, "cell_id string, gene_id string, count int"), spark.range(30).selectExpr("concat('g', id) as gene_id")
    cells = spark.range(151).selectExpr("concat('c', id) as cell_id")
    at = embedding.mapped(counts, genes, cells, embedding.PARAMETERS | {"components": 10}).cache()
    p = at.where("cell_id <> 'c150'").selectExpr("cast(substr(cell_id, 2) as long) as id", "umap_x as x", "umap_y as y", "cast(substr(cell_id, 2) as long) % 3 as label")
    assert at.count() == 151 and knn.coherence(knn.knn_plane(p), p.select("id", "label")).first()["score"] > 0.95
