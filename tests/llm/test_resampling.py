"""Importance resampling against a plain version."""

import hashlib
import math
import random
import zlib
from collections import Counter

import pytest

from cytoloom.llm import resampling
from cytoloom.llm.decontaminate import words


def plain(docs, target, n=1, buckets=10_000, seed=2024, least=20, percent=10):
    """(id, text, n_features, weight, score, rank) of each document, in their order; ids are numbers."""
    grams = lambda t: [b" ".join(w[i : i + k]) for w in [words(t)] for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    s, t = Counter(), Counter()
    for text in (x for _, x in docs):
        s.update(zlib.crc32(g) % buckets for g in grams(text))
    for text in target:
        t.update(zlib.crc32(g) % buckets for g in grams(text))
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for id_, text in docs:
        g = grams(text)
        weight = sum(gain(zlib.crc32(x) % buckets) for x in g)
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        rows.append([id_, text, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((i for i, r in enumerate(rows) if len(words(r[1])) >= least), key=lambda i: (-rows[i][4], rows[i][0] is None, rows[i][0] or 0))
    rank = {i: p + 1 for p, i in enumerate(able[: len(able) * percent // 100])}
    return [(*r, rank.get(i)) for i, r in enumerate(rows)]


def corpus(seed=3, n=240):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "ÀB", "x" * 90]
    text = lambda: " ".join(rng.choice(vocabulary[: rng.choice([20, 303])]) for _ in range(rng.randint(1, 60)))
    docs = [(i, text()) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "  ,;\n "), (n + 3, "The THE the " * 8), (n + 4, "W1,w2;W3 " * 5000)]
    return docs, [text() for _ in range(25)] + [None, "", "w1 w2 w3"]


def key(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize(("n", "buckets", "head"), [(1, 10_000, resampling.HEAD), (1, 50, 3), (3, 1000, 40), (2, 10_000, resampling.HEAD)])
def test_equal_to_a_plain_version(spark, n, buckets, head):
    docs, target = corpus()
    got = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), n=n, buckets=buckets, head=head, percent=30)
    assert key(tuple(r) for r in got.select("doc_id", "text", "n_features", "weight", "score", "rank").collect()) == key(plain(docs, target, n, buckets, percent=30))


def test_gathering_in_small_parts(spark, monkeypatch):
    docs, target = corpus(5, 60)
    monkeypatch.setattr(resampling, "GATHERED", 10)
    got = resampling.dictionary(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("cast(text as binary) as t").where("t is not null"), 2, 100)
    want = Counter(g for _, t in docs for g in resampling.features(words(t), 2))
    assert {bytes(r["feature"]): (r["c"], r["bucket"]) for r in got.collect()} == {g: (c, zlib.crc32(g) % 100) for g, c in want.items()}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    same = "one two three four five six seven eight nine ten " * 2
    docs = [(None, same, "a"), (None, None, None), (7, same, "b"), (7, same, "b"), (7, same + "eleven", "c"), (9, same, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, rank string").selectExpr("doc_id", "text", "rank", "upper(text) as `a.b`", "map('k', rank) as m", "1 as uid", "2 as __t")
    target = spark.createDataFrame([("one two",)], "text string")
    got = resampling.resample(df, target, percent=100).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "a.b", "m", "uid", "__t", "n_features", "weight", "score", "rank"}
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5] and [r["rank"] for r in got if r["text"] is None] == [None]
    want = plain([(a, b) for a, b, _ in docs], ["one two"], percent=100)
    assert key((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == key((r[0], *r[2:5]) for r in want)
    by = lambda rows: [(r[0], r[1]) for r in sorted(rows, key=lambda r: r[2])]
    assert by((r["doc_id"], r["score"], r["rank"]) for r in got if r["rank"]) == by((r[0], r[4], r[5]) for r in want if r[5])
    drawn = resampling.draw(df, target, percent=60)
    assert drawn.columns == df.columns and drawn.count() == 3


def test_string_ids_and_other_names(spark):
    df = spark.createDataFrame([(f"d{i}", "alpha beta " * 12) for i in range(10)], "key string, body string")
    got = resampling.resample(df, spark.createDataFrame([("alpha",)], "body string"), id_col="key", text_col="body", target_text="body", percent=25, keep=["key"]).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2] and {r["n_features"] for r in got} == {24}


def test_empty_tables(spark):
    none, target = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(none, target).count() == 0
    got = resampling.resample(spark.createDataFrame([(1, "a b " * 10)], "doc_id long, text string"), none.select("text"), percent=100).first()
    assert (got["weight"], got["rank"]) == (plain([(1, "a b " * 10)], [])[0][3], 1)
    with pytest.raises(ValueError, match="buckets"):
        resampling.resample(none, target, buckets=0)


def test_ranks_do_not_depend_on_the_partitioning(spark):
    docs, target = corpus(9, 150)
    t = spark.createDataFrame([(t,) for t in target], "text string")
    runs = [key(tuple(r) for r in resampling.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(p), t, keep=["doc_id"], percent=50).collect()) for p in (1, 7)]
    assert runs[0] == runs[1]
