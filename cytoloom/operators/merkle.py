"""A Merkle tree over a table's rows: its root is the table's fingerprint, and its nodes lead to what differs.

A row's leaf is named by the first hex digits of the hash of its key, so a changed value stays
in its leaf, and neither order nor partitioning matters. A leaf's hash is that of the hashes
of its distinct rows, in order, with how often each occurs; a node above has sixteen children
at most and the hash of their names and hashes. All hashes are SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import staged

#: Rows of a leaf, about; digits of a leaf's name at most.
LEAF, DEEPEST = 4096, 8


def written(*columns: str) -> Column:
    """Columns as one text that no other values give: each with its length, null as n."""
    one = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("n"))
    return F.concat_ws(",", *map(one, columns))


def _sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def hashed(df: DataFrame, key: list[str], depth: int) -> DataFrame:
    """(leaf, row, times): the distinct rows' hashes. Copies of a row fold before anything meets."""
    rows = df.select(_sha(written(*key)).substr(1, depth).alias("leaf"), _sha(written(*sorted(df.columns))).alias("row"))
    return rows.groupBy("leaf", "row").agg(F.count("*").alias("times"))


def depth_for(rows: int, leaf: int = LEAF) -> int:
    """Digits of leaves of some `leaf` rows."""
    depth = 0
    while depth < DEEPEST and rows > leaf * 16**depth:
        depth += 1
    return depth


def _leaves(rows: DataFrame) -> DataFrame:
    """(node, rows, hash) of the leaves: rows come sorted by Spark, and a leaf's hash takes them in as they pass, so no task holds a leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, total, sha = None, 0, None
        for batch in batches:
            done = []
            for name, row, times in zip(*(c.to_pylist() for c in batch.columns)):
                if name != leaf:
                    if sha:
                        done.append((leaf, total, sha.hexdigest()))
                    leaf, total, sha = name, 0, hashlib.sha256()
                else:
                    sha.update(b"\n")
                total += times
                sha.update(f"{row} {times}".encode())
            if done:
                yield made(done)
        if sha:
            yield made([(leaf, total, sha.hexdigest())])

    def made(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["node", "rows", "hash"])

    return rows.repartition("leaf").sortWithinPartitions("leaf", "row").select("leaf", "row", "times").mapInArrow(run, "node string, rows bigint, hash string")


def tree(df: DataFrame, key: list[str], depth: int) -> DataFrame:
    """(level, node, rows, hash) of all nodes, the root at level 0 with an empty name. An empty table has a root alone, of no children."""
    level = staged(_leaves(hashed(df, key, depth)), "merkle-leaves")  # every level above is made of it
    out = level.select(F.lit(depth).alias("level"), "node", "rows", "hash")
    for d in range(depth - 1, -1, -1):
        line = F.concat("node", F.lit(" "), "hash")
        # sixteen children at most, which folds of the children's hashes bring together
        level = level.groupBy(F.expr(f"substr(node, 1, {d})").alias("node")).agg(F.sum("rows").alias("rows"), _sha(F.array_join(F.sort_array(F.collect_list(line)), "\n")).alias("hash"))
        out = out.unionByName(level.select(F.lit(d).alias("level"), "node", "rows", "hash"))
    return out


def root(df: DataFrame, key: list[str] | None = None, leaf: int = LEAF) -> str:
    """The fingerprint of a table: of its rows, whatever their order, and its schema. key: all columns by default."""
    found = tree(df, key or df.columns, depth_for(df.count(), leaf)).where("level = 0").first()
    return found["hash"] if found else _EMPTY


#: Root of a table without rows: SHA-256 of nothing. (fixed value)
_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def differing(one: DataFrame, two: DataFrame) -> list[str]:
    """Names of the leaves in which two trees of one depth differ, in order, found from the root down: of a level only children of nodes that differ are compared."""
    nodes: list[str] | None = None
    depth = max(t.agg(F.max("level")).first()[0] or 0 for t in (one, two))
    for level in range(depth + 1):
        a, b = (t.where(F.col("level") == level).select("node", F.col("hash").alias(n)) for t, n in ((one, "a"), (two, "b")))
        both = a.join(b, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        if nodes is not None:
            both = both.where(F.expr(f"substr(node, 1, {level - 1})").isin(nodes) if nodes else F.lit(False))
        nodes = sorted(r["node"] for r in both.select("node").collect())
    return nodes or []


def changed(one: DataFrame, two: DataFrame, key: list[str], leaves: list[str]) -> DataFrame:
    """(*key, only_in): rows of the named leaves that are in one of the tables more often than in the other."""
    depth = len(leaves[0]) if leaves else 0
    columns = sorted(one.columns)

    def own(df: DataFrame) -> DataFrame:
        inside = df.where(_sha(written(*key)).substr(1, depth).isin(leaves)) if leaves else df.limit(0)
        return inside.select(*columns)

    a, b = own(one), own(two)
    return a.exceptAll(b).select(*key, F.lit("one").alias("only_in")).unionByName(b.exceptAll(a).select(*key, F.lit("two").alias("only_in")))
