import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cytoloom.llm import exact_dedup, mixing, sharding

DOCS = "doc_id bigint, text string, source string"
AWKWARD = [
    (1, "a b\tc", "x"), (2, "abc", "x"), (3, " a\nbc ", None), (4, None, "y"), (5, "", "y"), (6, " \x0b", None), (7, "ABC", "ä"), (None, "abc  ", "x"),
    (8, "word " * 3000, "x"), (9, "a b\tc", "x"), (10, " abc", "z"),
]


def norm(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


def expected_groups(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    return {(i, t): (min(groups[norm(t)])[2], len(groups[norm(t)])) for i, t, *_ in rows}


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, lambda n: F.unhex(F.lpad(F.hex((F.length(n) % 2).cast("long")), 2, "0"))])
def test_exact_groups_even_if_digests_collide(spark, digest):
    df = spark.createDataFrame(AWKWARD, DOCS).withColumn("n", F.lit(1)).withColumn("d", F.lit(2))
    got = exact_dedup.exact_groups(df, digest=digest).collect()
    want = expected_groups(AWKWARD)
    assert len(got) == len(AWKWARD)
    by_id = {i: v for (i, _), v in want.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == by_id[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
        assert r["text_sha256"] == hashlib.sha256(norm(next(t for i, t, _ in AWKWARD if i == r["doc_id"])).encode()).hexdigest()


@pytest.mark.parametrize("kind, ids", [("string", ["b", "a", "é", None]), ("bigint", [-(2**63), 2**63 - 1, 0, None]), ("binary", [b"\x00", b"\xff", b"", None]), ("date", None)])
def test_ids_of_any_orderable_type(spark, kind, ids):
    import datetime

    ids = ids or [datetime.date(2020, 1, 2), datetime.date(1, 1, 1), None]
    rows = [(i, "a b") for i in ids] + [(ids[0], "other")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, f"doc_id {kind}, text string")).collect()
    least = min(i for i in ids if i is not None)
    assert all(r["keep_id"] == least and r["kept"] == (r["doc_id"] == least) for r in got if r["group_size"] > 1)
    assert sorted(r["group_size"] for r in got) == [1] + [len(ids)] * len(ids)


def test_the_local_stage_folds_copies_before_the_exchange(spark):
    """The map side of the first aggregation leaves one row for each text and task."""
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "5 as n", "concat('text ', id % 3) as norm", "unhex(hex(id % 3)) as d")
    plan = exact_dedup.local_folds(df, 32)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        folded = plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(folded) == 4 * 3 and sum(r["c"] for r in folded) == 4000
    assert text.index("partial_min") > text.index("Exchange")  # below the exchange, that is before it


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_repeated_rows_are_all_kept(spark):
    got = exact_dedup.exact_groups(spark.createDataFrame([(1, "a", "x")] * 3 + [(2, "a", "x")], DOCS)).collect()
    assert sorted((r["doc_id"], r["kept"], r["group_size"]) for r in got) == [(1, True, 4)] * 3 + [(2, False, 4)]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 5000])
def test_the_walk_is_a_permutation(spark, n):
    got = [r[0] for r in spark.range(n).selectExpr(f"{sharding.place_sql('id', n, 11)} as p").collect()]
    assert sorted(got) == list(range(n))
    assert got == [sharding.place(i, n, 11) for i in range(n)]
    assert n < 10 or got != [sharding.place(i, n, 12) for i in range(n)]


def test_shards_are_even_and_slots_have_no_gaps(spark):
    df = spark.createDataFrame(AWKWARD * 9, DOCS)
    rows = sharding.shard(df, 7).collect()
    assert len(rows) == 99
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        t = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 16, zlib.crc32(t))
    assert sorted(map(len, by.values())) == [14] * 6 + [15] and all(sorted(s) == list(range(len(s))) for s in by.values())
    key = lambda rs: sorted((str(r["doc_id"]), r["text"] or "", r["shard"], r["slot"]) for r in rs if r["doc_id"])
    again = sharding.shard(df.repartition(3), 7).collect()
    assert [k[2:] for k in key(again)] == [k[2:] for k in key(rows)]


def test_rows_that_differ_in_other_columns_alone_keep_their_numbers(spark):
    df = spark.createDataFrame([(1, "same", i % 7, {"k": i}) for i in range(60)] + [(2, "x" * 300_000, 0, {})], "doc_id int, text string, extra int, m map<string,int>")
    one, two = (sharding.shard(d, 5).collect() for d in (df, df.repartition(9, F.rand(1))))
    key = lambda rows: sorted((r["extra"], str(r["m"]), r["row_no"]) for r in rows)
    assert key(one) == key(two)


def test_shards_of_nothing_and_clashing_names(spark):
    assert sharding.shard(spark.createDataFrame([], DOCS), 3).count() == 0
    clash = sharding.shard(spark.createDataFrame([(1, "a", 2, 9)], "doc_id int, text string, Slot int, other int"), 3)
    assert clash.columns == ["doc_id", "text", "other", "size", "text_crc32", "row_no", "shard", "slot"] and clash.first()["slot"] == 0


def fill(sizes, share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    t, open_ = {}, set(sizes)
    left = share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > cap * sizes[s] + 1e-9}
        if not over:
            return t | {s: left * w[s] / total for s in open_}
        for s in over:
            t[s] = cap * sizes[s]
            left -= t[s]
        open_ -= over
    return t


@pytest.mark.parametrize("seed", range(4))
def test_water_filling_equals_repeated_clamping(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([3, 50, 400, 9000]) for s in ["a", "B", "ü", "z9", None, "z10"]}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(mixing.weigh(rows)).collect()}
    want = fill(sizes)
    assert all(got[s] == pytest.approx(want[s]) for s in sizes)


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "b", "c", None])) for i in range(3000)] + [(None, None, "a"), (7, "", None)]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(-1) for c in ("weight", "s", "size", "rest", "cut", "before", "whole", "target", "__h", "source_size")})
    m = mixing.mix(df).cache()
    assert m.count() == len(rows) and m.where("copies > 2 or copies < 0").count() == 0
    for r in m.groupBy("source", "target", "source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) <= 30
        assert r["target"] <= 2 * r["source_size"]
    again = mixing.mix(df.repartition(5))
    assert m.select("doc_id", "copies").exceptAll(again.select("doc_id", "copies")).count() == 0
    assert mixing.repeat(m, df.columns).count() == m.agg(F.sum("copies")).first()[0]


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, None, None), (2, " ", "a")], DOCS)).agg(F.sum("size")).first()[0] == 0
