"""Closest names by an index of deletions, against all distances."""

import random

from pyspark.sql import functions as F

from cytoloom.operators import lookup
from cytoloom.staging import staged


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def names(rng, n, letters, longest):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_answers_equal_all_distances(spark):
    rng = random.Random(2)
    known = names(rng, 120, "abC", 7) + names(rng, 60, "xyzw", 30) + ["same", "SAME", "Same"]
    wanted = names(rng, 60, "abc", 7) + [k[:3] + k[4:] for k in known[120:150]] + ["unlike anything here", "", "sAme"]
    table = lookup.index(spark.createDataFrame([(k,) for k in known + [None]], "symbol string"))
    got = lookup.closest(table, spark.createDataFrame([(w,) for w in wanted + [None, wanted[0]]], "wanted string").repartition(3), 2).collect()
    lower = sorted({k.lower() for k in known})
    want = {(w, k, d, r) for w in {w.lower() for w in wanted} for r, (d, k) in enumerate(sorted((distance(w, k), k) for k in lower)[:2], 1)}
    assert {(r["wanted"], r["known"], r["distance"], r["rank"]) for r in got} == want and len(got) == len(want)
    assert {r["by_key"] for r in got} == {True, False}


def test_few_candidates_and_nothing_missed(spark):
    rng = random.Random(3)
    known = sorted(set(names(rng, 1500, "abcdefghijklmnop", 20)))
    wanted = [k[: (p := rng.randrange(len(k)))] + rng.choice("abcq") + k[p + rng.randint(0, 1) :] for k in rng.sample([k for k in known if k], 100)]
    near = {(w, k) for w in wanted for k in known if abs(len(w) - len(k)) <= 2 and distance(w, k) <= 2}
    table = lookup.index(spark.createDataFrame([(k,) for k in known], "symbol string"))
    keys = spark.createDataFrame([(w,) for w in set(wanted)], "wanted string").select("wanted", F.explode(lookup.deletions(F.col("wanted"))).alias("key"))
    met = {(r["wanted"], r["known"]) for r in keys.join(table, "key").select("wanted", "known").distinct().collect()}
    assert near <= met and len(met) < 0.05 * len(known) * len(wanted)


def test_names_unlike_any_meet_few(spark, monkeypatch):
    """Numbered copies of few names, as symbols are: the distances taken of unlike names are a small part of all."""
    known = [f"{a} {b}-{i}" for a in ("old", "large") for b in ("gear", "bolt") for i in range(2, 700)] + ["new rod", "hot rod", "old rod", "a\U0001f600b"]
    wanted = [f"g{i}q" for i in range(1000, 1040)] + ["\U0001f600", "zzz"]
    monkeypatch.setattr(lookup, "SEEDS", 20)
    df = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    met = lookup._far(df(known, "known"), df(wanted, "wanted"), 3)
    assert met.count() < 0.1 * len(known) * len(wanted)
    got = lookup.closest(lookup.index(df(known, "symbol")), df(wanted, "wanted"), 3).collect()
    want = {(w, k, d, r) for w in wanted for r, (d, k) in enumerate(sorted((distance(w, k), k) for k in known)[:3], 1)}
    assert {(r["wanted"], r["known"], r["distance"], r["rank"]) for r in got} == want and len(got) == len(want)


def test_long_names_and_nothing_known(spark):
    a, b = "x" * 5000, "x" * 2500 + "y" + "x" * 2500
    table = lookup.index(spark.createDataFrame([(a,), ("z",)], "symbol string"))
    asked = spark.createDataFrame([(b,)], "wanted string")
    assert [(r["known"], r["distance"], r["by_key"]) for r in lookup.closest(table, asked).collect()] == [(a, 1, True)]
    assert lookup.closest(table.limit(0), asked, 3).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deletions_are_no_broadcast(spark, monkeypatch):
    """A small table of names has many times as many deletions: the driver must not hold them, nor names."""
    plans = []
    monkeypatch.setattr(lookup, "staged", lambda df, name: plans.append(plan(df)) or staged(df, name))
    table = lookup.index(spark.createDataFrame([(f"name {i}",) for i in range(50)], "symbol string"))
    got = lookup.closest(table, spark.createDataFrame([("name 1x",), ("unlike",)], "wanted string"), 2)
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in [*plans, plan(got)])
    assert got.count() == 4


def test_kinds_too_many_to_send(spark, monkeypatch):
    rng = random.Random(5)
    known, wanted = sorted(set(names(rng, 80, "abcd", 9))), sorted(set(names(rng, 30, "xyab", 9)))
    df = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    monkeypatch.setattr(lookup, "KINDS", 1)
    monkeypatch.setattr(lookup, "SEEDS", 8)
    far = lookup._far(df(known, "known"), df(wanted, "wanted"), 3)
    assert "CartesianProduct" in plan(far)
    got = lookup.closest(lookup.index(df(known, "symbol")), df(wanted, "wanted"), 3, known=df(known, "known")).collect()
    want = {(w, k, d, r) for w in wanted for r, (d, k) in enumerate(sorted((distance(w, k), k) for k in known)[:3], 1)}
    assert {(r["wanted"], r["known"], r["distance"], r["rank"]) for r in got} == want and len(got) == len(want)


def test_ties_come_by_name(spark):
    """Numbered names tie at a distance; only those before the n-th found so far are measured."""
    known = [f"{a} rod-{i}" for a in ("hot", "old", "new") for i in range(2, 900)] + ["hot rod", "old rod", "new rod"]
    wanted = [f"g{i}q" for i in range(134560, 134600)]
    df = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    met = lookup._far(df(known, "known"), df(wanted, "wanted"), 3).collect()
    assert len(met) < 10 * len(wanted)
    best = {w: sorted((distance(w, k), k) for k in known)[:3] for w in wanted}
    assert {w: sorted((r["distance"], r["known"]) for r in met if r["wanted"] == w)[:3] for w in wanted} == best
