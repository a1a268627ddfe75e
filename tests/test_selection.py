"""Exact medians and other places of groups, by rounds."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cytoloom.operators import selection


@pytest.mark.parametrize("cells", [64, 3])
def test_medians_equal_sorting(spark, monkeypatch, cells):
    monkeypatch.setattr(selection, "CELLS", cells)
    rng = random.Random(cells)
    groups = {"wide": [rng.random() * 10.0 ** rng.randint(-5, 12) for _ in range(3000)], "two": [1.0] * 45 + [2.0] * 45, "one": [5.0], "far": [0.0] * 3 + [1e300, -1e300], None: [3.0, 1.0], "ties": [float(rng.randint(0, 9)) for _ in range(501)]}
    rows = [(g, v) for g, of in groups.items() for v in of] + [("one", None), ("empty", None)]
    rng.shuffle(rows)
    got = {r["g"]: r["m"] for r in selection.median(spark.createDataFrame(rows, "g string, v double").repartition(4), ["g"], "v", "m").collect()}
    assert got == {g: pytest.approx(statistics.median(of), rel=1e-15) for g, of in groups.items()}


def test_any_places_and_no_groups(spark):
    v = [random.Random(1).randint(-50, 50) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in v], "v int")
    got = {r["place"]: r["x"] for r in selection.order_statistics(df, [], "v", lambda n: F.array(F.lit(0), F.lit(7), n - 1)).collect()}
    assert got == {0: min(v), 7: sorted(v)[7], 399: max(v)}
    assert selection.median(df.limit(0).withColumn("g", F.lit(1)), ["g"], "v").count() == 0


def test_nan_is_above_all(spark):
    got = selection.median(spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double").withColumn("g", F.lit(1)), ["g"], "v").first()
    assert got["median"] == 2.0
    only = selection.median(spark.createDataFrame([(float("nan"),)], "v double").withColumn("g", F.lit(1)), ["g"], "v").first()
    assert math.isnan(only["median"])


def test_first_round_leaves_few_of_distinct_values(spark, monkeypatch):
    kept, real = [], selection.staged

    def watch(df, name):
        back = real(df, name)
        if name == "selection-left":
            kept.append(back.count())
        return back

    monkeypatch.setattr(selection, "staged", watch)
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7).alias("v"))
    got = {r["g"]: r["median"] for r in selection.median(df, ["g"], "v").collect()}
    rows = df.collect()
    assert got == {g: pytest.approx(statistics.median(r["v"] for r in rows if r["g"] == g), rel=1e-15) for g in (0, 1)}
    assert max(kept) < 20_000 / 8


def test_nearly_all_values_equal_and_zeros_of_both_signs(spark):
    rows = [("a", 5.0)] * 2000 + [("a", 1.0), ("a", 2.0), ("z", -0.0), ("z", 0.0), ("z", -0.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["place"]): repr(r["x"]) for r in selection.order_statistics(df, ["g"], "v", lambda n: F.array(F.lit(0), F.lit(1), F.lit(2))).collect()}
    assert got == {("a", 0): "1.0", ("a", 1): "2.0", ("a", 2): "5.0", ("z", 0): "0.0", ("z", 1): "0.0", ("z", 2): "0.0"}
