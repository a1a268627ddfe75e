"""Merkle trees of tables."""

import hashlib
import random

from pyspark.sql import functions as F

from cytoloom.operators import merkle

SCHEMA = "cell string, gene string, count int"


def plain(rows, depth):
    """{(level, node): (rows, hash)} of rows (cell, gene, count) keyed by the first two."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    text = lambda *v: ",".join("n" if x is None else f"{len(str(x))}:{x}" for x in v)
    leaves = {}
    for c, g, n in rows:
        leaf = leaves.setdefault(sha(text(c, g))[:depth], {})
        h = sha(text(c, n, g))  # columns in order of name
        leaf[h] = leaf.get(h, 0) + 1
    level = {k: (sum(v.values()), sha("\n".join(sorted(f"{h} {t}" for h, t in v.items())))) for k, v in leaves.items()}
    out = {(depth, k): v for k, v in level.items()}
    for d in range(depth - 1, -1, -1):
        up = {}
        for k, v in level.items():
            up.setdefault(k[:d], []).append((k, v))
        level = {k: (sum(r for _, (r, _) in of), sha("\n".join(sorted(f"{n} {h}" for n, (_, h) in of)))) for k, of in up.items()}
        out |= {(d, k): v for k, v in level.items()}
    return out


def rows(n=600, seed=1):
    rng = random.Random(seed)
    return [(f"c{rng.randint(0, 80)}", rng.choice(["g1", "é", "", None, "a,b"]), rng.choice([None, 1, 2, 30])) for _ in range(n)]


def test_tree_equals_a_plain_one_for_any_partitioning(spark):
    r = rows()
    for depth, parts in ((0, 2), (1, 1), (2, 5)):
        got = merkle.tree(spark.createDataFrame(r, SCHEMA).repartition(parts), ["cell", "gene"], depth).collect()
        assert {(x["level"], x["node"]): (x["rows"], x["hash"]) for x in got} == plain(r, depth)


def test_one_changed_entry_is_found_through_the_tree(spark):
    r = [(f"c{i}", f"g{i % 7}", i % 5) for i in range(500)]
    other = [(c, g, n + (c == "c123")) for c, g, n in r]
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (r, other))
    trees = [merkle.tree(x, ["cell", "gene"], 2) for x in (a, b)]
    leaves = merkle.differing(*trees)
    assert len(leaves) == 1 and trees[0].where(F.col("node") == leaves[0]).first()["rows"] < 20
    assert sorted(map(tuple, merkle.changed(a, b, ["cell", "gene"], leaves).collect())) == [("c123", "g4", "one"), ("c123", "g4", "two")]
    assert merkle.differing(trees[0], merkle.tree(a.repartition(3), ["cell", "gene"], 2)) == [] and merkle.changed(a, a, ["cell"], []).count() == 0


def test_roots_tell_values_repeats_and_nulls_apart(spark):
    of = lambda *r: merkle.root(spark.createDataFrame(list(r), SCHEMA), leaf=1)
    seen = [of(), of(("a", "b", 1)), of(("a", "b", 1), ("a", "b", 1)), of(("ab", "", 1)), of(("a", None, 1)), of(("a", "n", 1)), of(("a", "b", 1), ("c", "d", 2))]
    assert len(set(seen)) == len(seen) and of(("c", "d", 2), ("a", "b", 1)) == seen[-1] and of() == hashlib.sha256(b"").hexdigest()
    assert [merkle.depth_for(n, 10) for n in (0, 10, 11, 160, 161, 10**12)] == [0, 0, 1, 1, 2, 8]


def test_a_leaf_is_never_one_list(spark, monkeypatch):
    """Rows of a leaf pass in order through its hash; no aggregate gathers them."""
    import hashlib

    from cytoloom.operators import merkle

    gathered = []
    monkeypatch.setattr(merkle.F, "collect_list", lambda c, f=merkle.F.collect_list: gathered.append(c) or f(c))
    df = spark.range(3000).selectExpr("id % 700 as a", "id % 3 as b").repartition(5)
    root = merkle.tree(df, ["a"], 0).collect()
    rows = sorted(f"{r['row']} {r['times']}" for r in merkle.hashed(df, ["a"], 0).collect())
    assert not gathered and [(r["rows"], r["hash"]) for r in root] == [(3000, hashlib.sha256("\n".join(rows).encode()).hexdigest())]
