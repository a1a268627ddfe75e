import random

import pytest
from pyspark.sql import functions as F

from cytoloom.functions import affine, codec, text
from cytoloom.plans import catalog


def column(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_slugs(spark):
    got = [r[0] for r in column(spark, ["T cells (CD8+)", "--A__b", "Ünïcode 3", "", None], "string").select(text.slug(F.col("v"))).collect()]
    assert got == ["t-cells-cd8", "a-b", "ünïcode-3", "", None]


def test_repeated_symbols_are_numbered(spark):
    df = spark.createDataFrame([(1, "Abc"), (2, "abc"), (3, "X"), (4, "ABC")], "i int, s string")
    got = [r["symbol"] for r in text.number_repeats(df, "s", "i").orderBy("i").collect()]
    assert got == ["Abc", "abc-2", "X", "ABC-3"]


def test_identifiers_pad_but_never_cut(spark):
    got = [r[0] for r in column(spark, [1, 12, 1234]).select(text.padded("C", F.col("v"), 3)).collect()]
    assert got == ["C001", "C012", "C1234"]


def test_shade(spark):
    assert [r[0] for r in column(spark, ["#FFFFFF", "#000000", "#0a1B2c"], "string").select(text.shade(F.col("v"))).collect()] == ["#8C8C8C", "#000000", "#050E18"]


@pytest.mark.parametrize("path,bad", [("raw/transcripts.parquet", True), ("morphology_focus/x.tif", True), ("a/cells.zarr.zip", True), ("cells.parquet", False), ("mytranscripts.csv", False), ("a/transcripts.zarr.zip/b", True)])
def test_forbidden(spark, path, bad):
    assert spark.range(1).select(text.forbidden(F.lit(path))).first()[0] is bad


def test_morton_corners(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (65535, 65535)], "x int, y int")
    assert [r[0] for r in df.select(codec.morton(F.col("x"), F.col("y"))).collect()] == [0, 1, 2, 3, 0xFFFFFFFF]


def test_quantiser_error_and_clipping(spark):
    rng = random.Random(1)
    df = column(spark, [rng.uniform(-3.2, 22500) for _ in range(5000)], "double")
    lo, hi = F.lit(-3.2), F.lit(22500.0)
    scale = codec.quant_scale(lo, hi)
    q = codec.quant_encode(F.col("v"), lo, scale)
    worst, step = df.select(F.max(F.abs(codec.quant_decode(q, lo, scale) - F.col("v"))), F.max(scale)).first()
    assert worst <= step / 2 + 1e-9
    assert [r[0] for r in column(spark, [-1e9, 1e9], "double").select(q).collect()] == [0, 65535]


def leb128(n):
    out = bytearray()
    while True:
        out.append(n & 127 | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return out.hex()


def test_varints(spark):
    values = [0, 1, 127, 128, 16383, 16384, 2**21, 2**28 + 5, 2**32 - 1]
    rows = column(spark, values).select("v", F.lower(codec.varint_hex(F.col("v"))).alias("h"), codec.varint_length(F.col("v")).alias("n")).collect()
    assert all(r["h"] == leb128(r["v"]) and r["n"] == len(r["h"]) // 2 for r in rows)
    joined = "".join(leb128(v) for v in values)
    assert spark.range(1).select(codec.varint_decode(F.lit(joined))).first()[0] == values
    assert spark.range(1).select(codec.varint_decode(F.lit(""))).first()[0] == []


def test_remainders_of_products_past_64_bits(spark):
    values = [0, 1, 65535, 65536, 2**32 - 1, 2**32, 9_000_000, 2**40 + 12345, 2**63 - 1]
    got = column(spark, values).select("v", codec.product_u32(F.col("v"), F.col("v"), F.lit(1_200_007)).alias("p")).collect()
    assert [(r["v"], r["p"]) for r in got] == [(v, v * v * 1_200_007 % 2**32) for v in values]


def test_varint_query_of_large_keys(spark, tmp_path):
    spark.createDataFrame([(9_000_000, 1, 1_200_000), (7, 2, 3)], "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r["l_orderkey"]: r["code"] for r in catalog.QUERIES["c1_varints"](spark, str(tmp_path)).collect()}
    assert got == {k: leb128(k * k * p % 2**32) for k, p in ((9_000_000, 1_200_000), (7, 3))}


def test_affine_inverse(spark):
    m = [2.0, 0.5, 10.0, -0.25, 3.0, -7.0, 0.0, 0.0, 1.0]
    df = spark.createDataFrame([(m,)], "m array<double>")
    inv = df.select(affine.inverse(F.col("m"))).first()[0]
    product = [sum(m[3 * i + k] * inv[3 * k + j] for k in range(3)) for i in range(3) for j in range(3)]
    assert product == pytest.approx([1, 0, 0, 0, 1, 0, 0, 0, 1])


def test_color_differences_of_the_published_pairs(spark):
    """Pairs 1, 7, 16, 25 and 34 of the test data of Sharma, Wu and Dalal (2005)."""
    from cytoloom.functions import color

    rows = [(50.0, 2.6772, -79.7751, 50.0, 0.0, -82.7485, 2.0425), (50.0, 0.0, 0.0, 50.0, -1.0, 2.0, 2.3669), (50.0, 2.5, 0.0, 50.0, 0.0, -2.5, 4.3065), (60.2574, -34.0099, 36.2677, 60.4626, -34.1751, 39.4387, 1.2644), (2.0776, 0.0795, -1.135, 0.9033, -0.0636, -0.5514, 0.9082)]
    df = spark.createDataFrame(rows, "l1 double, a1 double, b1 double, l2 double, a2 double, b2 double, want double")
    side = lambda i: F.struct(*[F.col(f"{c}{i}").alias(c) for c in "lab"])
    got = df.select(color.difference(side(1), side(2)).alias("d"), "want").collect()
    assert all(abs(r["d"] - r["want"]) < 1e-4 for r in got)
    near = spark.createDataFrame([("x", "#FF0000"), ("y", "#FE0000"), ("z", "#0000FF")], "id string, color string")
    assert {(r["a"], r["b"]) for r in color.too_close(near).collect()} == {("x", "y")}
