"""Points some length apart: rounds against acceptance one by one."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cytoloom.operators import align, derive, spatial


def one_by_one(points, apart):
    """Ids of (id, x, y) that are accepted in order."""
    kept = {}
    side = apart / math.sqrt(2)
    for i, x, y in sorted(points):
        gx, gy = math.floor(x / side), math.floor(y / side)
        near = (kept.get((gx + a, gy + b)) for a in range(-2, 3) for b in range(-2, 3))
        if not any(k and (x - k[1]) ** 2 + (y - k[2]) ** 2 < apart**2 for k in near):
            kept[gx, gy] = (i, x, y)
    return sorted(k[0] for k in kept.values())


@pytest.mark.parametrize("n, apart, parts", [(20_000, 110.0, 3), (2_000, 700.0, 1), (500, 1.0, 4)])
def test_rounds_equal_the_order_of_darts(spark, n, apart, parts):
    darts = align.random_points(spark, n, (-1000.0, -500.0, 3000.0, 2500.0), "t")
    want = one_by_one([tuple(r) for r in darts.collect()], apart)
    assert sorted(r["id"] for r in spatial.spaced(darts.repartition(parts), apart).collect()) == want


def test_ids_along_a_line_and_merged_tables(spark, monkeypatch):
    monkeypatch.setattr(spatial, "MERGED", 3)
    line = [(i, 10.0 * i, 0.0) for i in range(60)]
    got = spatial.spaced(spark.createDataFrame(line, "id long, x_um double, y_um double"), 25.0)
    assert sorted(r["id"] for r in got.collect()) == one_by_one(line, 25.0) == list(range(0, 60, 3))


def test_ties_copies_planes_and_what_has_no_place(spark):
    nan = float("nan")
    rows = [("a", 1, 0.0, 0.0), ("a", 1, 0.0, 0.0), ("a", 1, 50.0, 0.0), ("a", 2, 10.0, 0.0), ("a", 3, 49.99, 100.0), ("b", 2, 10.0, 0.0), ("b", None, 0.0, 0.0), (None, 1, 0.0, 0.0), ("b", 5, nan, 0.0), ("b", 6, 0.0, None)]
    df = spark.createDataFrame(rows, "plane string, id int, x_um double, y_um double").withColumn("p", F.lit("clash"))
    got = spatial.spaced(df, 50.0, by=("plane",))
    assert sorted((r["plane"], r["id"], r["x_um"]) for r in got.collect()) == [("a", 1, 0.0), ("a", 1, 50.0), ("a", 3, 49.99), ("b", 2, 10.0)]
    assert spatial.spaced(df.limit(0), 50.0).count() == 0
    with pytest.raises(ValueError):
        spatial.spaced(df, 0.0)


def test_a_hot_place(spark):
    rng = random.Random(5)
    rows = [(i, 0.0 + rng.random(), rng.random()) if i % 3 else (i, rng.uniform(-400, 400), rng.uniform(-400, 400)) for i in range(6000)]
    got = spatial.spaced(spark.createDataFrame(rows, "id long, x_um double, y_um double"), 20.0)
    assert sorted(r["id"] for r in got.collect()) == one_by_one(rows, 20.0)


def test_centers_do_not_overlap(spark):
    tissue = spark.range(160 * 160).select((F.col("id") % 160 * 25.0).alias("x_um"), (F.floor(F.col("id") / 160) * 25.0).alias("y_um"))
    centers = derive.pick_cores(tissue, 250.0, 1, 4000)
    assert len(centers) > 10 and centers == derive.pick_cores(tissue.repartition(7), 250.0, 1, 4000)
    assert all(math.hypot(a - c, b - d) >= 600 for i, (a, b) in enumerate(centers) for c, d in centers[:i])
