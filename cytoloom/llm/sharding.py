"""Sharding by a Feistel permutation with cycle walking over global row numbers, in DataFrame and SQL operations only.

Global row numbers come without a sort in one task: rows fall into a fixed number of buckets
by a hash of their values, the buckets' counts give each bucket's first number, and a window
within the bucket numbers its rows. The numbers depend on the rows alone, not on how the
input is split, so a task that runs again gives the same numbers. Row r goes to place
p = permute(r); its shard is p mod shards and its slot p div shards: shard sizes differ by
one row at most, slots have no gaps, and whoever knows (r, rows, seed) can compute both.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import restored, safe, staged, table

PRIME = 2_147_483_647
ROUNDS = 6
#: Steps of a walk. Fewer than this many numbers lie outside the domain up to 4,096 rows, so no walk is longer; with more rows at most one number in 64 lies outside, and a longer walk would raise an error.
WALK = 64
#: Buckets of the row numbering: a constant, so that the table of offsets is bounded and can be broadcast.
BUCKETS = 16_384


def keys(seed: int) -> list[tuple[int, int, int]]:
    """Round keys from the seed by a linear congruential rule."""
    x, out = seed % 2**64, []
    for _ in range(ROUNDS):
        k = []
        for _ in range(3):
            x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
            k.append((x >> 33) % (PRIME - 1) + 1)
        out.append(tuple(k))
    return out


def halves(n: int) -> tuple[int, int]:
    """Moduli a and b, both below 2^31, with a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(n))
    return a, -(-max(n, 1) // a)


def feistel_sql(x: str, n: int, seed: int) -> str:
    """SQL for a permutation of 0 .. a*b-1: the halves, in Z_a and Z_b, take turns to be shifted by a keyed hash of the other."""
    a, b = halves(n)
    rounds = ", ".join(f"named_struct('a', {k[0]}L, 'b', {k[1]}L, 'c', {k[2]}L)" for k in keys(seed))
    hashed = f"element_at(transform(transform(array((s.q * k.a + k.b) % {PRIME}L), t -> ((t ^ shiftright(t, 15)) % {PRIME}L) * k.c % {PRIME}L), t -> t ^ shiftright(t, 13)), 1)"
    return (
        f"aggregate(array({rounds}), named_struct('p', ({x}) % {a}L, 'q', ({x}) div {a}L, 'm', {a}L, 'o', {b}L), "
        f"(s, k) -> named_struct('p', s.q, 'q', (s.p + {hashed}) % s.m, 'm', s.o, 'o', s.m), s -> s.q * {a}L + s.p)"
    )


def place_sql(x: str, n: int, seed: int) -> str:
    """SQL for a permutation of 0 .. n-1: cycle walking, that is feistel_sql() again until the number is below n."""
    a, b = halves(n)
    steps = max(1, min(a * b - n, WALK))
    walk = f"aggregate(sequence(1, {steps}), {feistel_sql(x, n, seed)}, (acc, i) -> CASE WHEN acc < {n}L THEN acc ELSE {feistel_sql('acc', n, seed)} END)"
    return f"element_at(transform(array({walk}), v -> CASE WHEN v < {n}L THEN v ELSE CAST(raise_error('the cycle walk did not end') AS BIGINT) END), 1)"


def place(x: int, n: int, seed: int) -> int:
    """place_sql() for one number, for callers without Spark."""
    a, b = halves(n)
    while True:
        p, q, m, o = x % a, x // a, a, b
        for k in keys(seed):
            t = (q * k[0] + k[1]) % PRIME
            t = ((t ^ (t >> 15)) % PRIME) * k[2] % PRIME
            p, q, m, o = q, (p + (t ^ (t >> 13))) % m, o, m
        x = q * a + p
        if x < n:
            return x


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of safe(); those with maps, which have no hash, as JSON."""
    mapped = ["map<" in f.dataType.simpleString() for f in df.schema]
    return F.xxhash64(*[F.to_json(F.struct(f"__c{i}")) if m else F.col(f"__c{i}") for i, m in enumerate(mapped)])


def shard(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 4) -> DataFrame:
    """df with size, text_crc32, row_no, shard and slot; the law is `rows`.

    Row numbers follow (bucket of id and crc, id, crc, size, text hash, hash of all columns),
    so a task that runs again numbers its rows as before. Rows equal in all these are
    interchangeable and share a bucket; null ids and texts are values like any other, texts
    of any length count whole. An empty table gives an empty result; columns of df of the
    added names are replaced.
    """
    rows = df.select(*safe(df, df.columns), F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"))
    text = F.col("__text")
    rows = rows.withColumns({"size": F.octet_length(text).cast("long") + 16, "text_crc32": F.crc32(text), "__hash": F.xxhash64(text), "__row": row_hash(df)})
    rows = rows.withColumn("__bucket", ((F.crc32(F.coalesce(F.col("__id").cast("string"), F.lit("")).cast("binary")) + F.col("text_crc32")) % BUCKETS).cast("int"))
    counts = staged(rows.groupBy("__bucket").agg(F.count("*").alias("c")), "shard-counts")
    n = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    before = F.sum("c").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__bucket", F.coalesce(before, F.lit(0)).alias("__first"))
    within = Window.partitionBy("__bucket").orderBy("__id", "text_crc32", "size", "__hash", "__row")
    numbered = rows.join(F.broadcast(offsets), "__bucket").withColumn("row_no", F.col("__first") + F.row_number().over(within) - 1)
    dealt = numbered.withColumn("__place", F.expr(place_sql("row_no", n, seed))).withColumns({"shard": (F.col("__place") % shards).cast("int"), "slot": F.expr(f"__place div {shards}")})
    return restored(dealt, df.columns, ["size", "text_crc32", "row_no", "shard", "slot"])


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    """40 shards of all documents under the law `rows`."""
    rows = shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_no")


def _oracle() -> str:
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({h}), 2), lambda i: ((instr('0123456789ABCDEF', {h}[i]) - 1) * 16 + instr('0123456789ABCDEF', {h}[i+1]) - 1)::bigint)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"
    rounds, last = [], "r0"
    for i, k in enumerate(keys(4)):
        t1 = f"(q * {k[0]} + {k[1]}) % {PRIME}"
        rounds.append(f"f{i} as (select *, {t1} as t from {last})")
        rounds.append(f"g{i} as (select *, (xor(t, t >> 15) % {PRIME}) * {k[2]} % {PRIME} as u from f{i})")
        rounds.append(f"r{i + 1} as (select x, q as p, (p + xor(u, u >> 13)) % {'a' if i % 2 == 0 else 'b'} as q, a, b, n from g{i})")
        last = f"r{i + 1}"
    return f"""
with recursive bits(i, k, v) as (select i, 0, i from range(256) t(i) union all select i, k+1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
 tab as (select list(v order by i) as tab from bits where k = 8),
 d as (select doc_id, octet_length(encode(coalesce(text,'')))::bigint + 16 as size, hex(encode(coalesce(text,''))) as h, hex(encode(coalesce(doc_id::varchar,''))) as ih from documents),
 c as (select doc_id, size, {crc.format(h="h")} as crc, {crc.format(h="ih")} as icrc from d, tab),
 o as (select doc_id, size, crc, row_number() over (order by (icrc + crc) % {BUCKETS}, doc_id nulls first, crc, size) - 1 as row_no from c),
 s as (select count(*) as n, floor(sqrt(count(*)))::bigint as a, ceil(count(*) / floor(sqrt(count(*))))::bigint as b from documents),
 r0 as (select x, x % a as p, x // a as q, a, b, n from s, range(0, (select a*b from s)) t(x)), {", ".join(rounds)},
 perm as (select x, q * a + p as y, n from {last}),
 w(r, x, n) as (select x, y, n from perm union all select w.r, perm.y, w.n from w join perm on perm.x = w.x where w.x >= w.n),
 pl as (select r, x as place from w where x < n)
select doc_id, size, crc::bigint as text_crc32, 'rows' as law, (place % 40)::int as shard, (place // 40)::bigint as slot, null::int as grown_shard, row_no::bigint as row_no from o join pl on pl.r = o.row_no
"""


OP4_SQL = _oracle()
