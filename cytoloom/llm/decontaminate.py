"""Benchmark decontamination: a prefix-filtered set join, verified over item-sized windows.

A benchmark item becomes windows of 10 consecutive words (one shorter window if it has
fewer), a window the set of its five-word shingles (a window of fewer words is one shingle).
A document that holds a window holds all of its shingles, so with the shingles ordered by
rarity - the number of windows that have them, then their hash - the necessary prefix is a
single one, the rarest. Its places in a document are the only candidates. Its offset in the
window bounds the start (positional bound), the window's length the end (length bound), and
the words from start to end are compared one by one.

A benchmark of at most SMALL bytes of text is an index that goes to the workers, and one pass
over the documents does all. A larger one stays in Spark: documents give their places whose
shingle is in a filter of FILTER_BITS bits, with the words around; these are joined with the
windows' prefix shingles and verified, and the hits join the documents by text.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import restored, safe, small, staged, table

#: Words of a shingle.
SHINGLE = 5
#: Bytes of benchmark text up to which an index of it, some 100 bytes for a byte, is sent to the workers.
SMALL = 2_000_000
#: Bits of the filter of prefix shingles; a constant, whatever the benchmark.
FILTER_BITS = 2**24
#: Bytes to word bytes: A-Z lower-cased; other ASCII that is neither digit nor letter separates. Bytes of non-ASCII characters are word bytes.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes | str | None) -> list[bytes]:
    """[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z; null has none."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(FOLD).split()


def spans(n: int, size: int) -> range:
    """Starts of the windows of an item of n words; each has min(n, size) words."""
    return range(max(1, n - size + 1) if n else 0)


def shingles(words: list[bytes]) -> list[bytes]:
    """The shingles of a window, by offset."""
    k = min(SHINGLE, len(words))
    return [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]


def number(shingle: bytes) -> int:
    """Spark's xxhash64 of a string."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingle, seed=42)).astype(np.int64))


def prefix_index(items: list[tuple[str, bytes]], size: int) -> dict[bytes, dict[tuple[bytes, ...], list]]:
    """First word -> {rarest shingle of a window: [(its offset there, the window, its items)]}."""
    windows: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in spans(len(w), size):
            windows[tuple(w[i : i + size])].add(item)
    count: Counter = Counter(s for window in windows for s in set(shingles(list(window))))
    index: dict = defaultdict(lambda: defaultdict(list))
    for window, of in windows.items():
        every = shingles(list(window))
        offset = min(range(len(every)), key=lambda i: (count[every[i]], number(every[i]), i))
        rare = tuple(every[offset].split(b" "))
        index[rare[0]][rare].append((offset, list(window), sorted(of)))
    return {head: dict(of) for head, of in index.items()}


def hits(doc: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set[str]]:
    """Occurrences of windows in a document, as merged word ranges, and the items they are of."""
    ranges, items, n = [], set(), len(doc)
    for at in [i for i, w in enumerate(doc) if w in index]:
        of_head = index[doc[at]]
        for k in range(1, SHINGLE + 1):
            for offset, window, of in of_head.get(tuple(doc[at : at + k]), ()) if at + k <= n else ():
                start = at - offset
                end = start + len(window)
                if start >= 0 and end <= n and doc[start:end] == window:
                    ranges.append((start, end))
                    items.update(of)
    return merge(ranges), items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType()))]


def _sent(rows: DataFrame, keep: list[str], items: list[tuple[str, bytes]], size: int) -> DataFrame:
    """FOUND of every row by an index of the items in the workers."""
    index = rows.sparkSession.sparkContext.broadcast(prefix_index(items, size))

    def find(batches):
        for batch in batches:
            lengths, hit, found = [], [], []
            for text in batch.column(len(keep)):
                w = words(text.as_py())
                ranges, of = hits(w, index.value)
                lengths.append(len(w))
                hit.append(sum(b - a for a, b in ranges))
                found.append(sorted(of))
            new = [pa.array(lengths, pa.int64()), pa.array(hit, pa.int64()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], names=[*keep, "n_words", "n_hit", "items"])

    return rows.mapInArrow(find, T.StructType([*rows.select(*keep).schema.fields, *FOUND]))


def _windows(items: DataFrame, size: int) -> DataFrame:
    """(win, item): windows of items (i, t), their words joined by a space."""

    def cut(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(text)
                starts = spans(len(w), size)
                for at in range(0, len(starts), 10_000):
                    win = [b" ".join(w[i : i + size]).decode() for i in starts[at : at + 10_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(win, pa.string()), pa.array([item] * len(win), pa.string())], names=["win", "item"])

    return items.mapInArrow(cut, "win string, item string").distinct()


def _prefixes(windows: DataFrame) -> DataFrame:
    """(h, win, offset): the rarest shingle of each window, as a number, and its offset there."""
    each = windows.select("win").distinct().select("win", F.split("win", " ").alias("w"))
    each = each.select("win", F.posexplode(F.expr(f"transform(sequence(0, greatest(size(w) - {SHINGLE}, 0)), i -> xxhash64(array_join(slice(w, i + 1, {SHINGLE}), ' ')))")).alias("offset", "h"))
    each = staged(each, "decontaminate-shingles")
    counts = staged(each.select("win", "h").distinct().groupBy("h").agg(F.count("*").alias("c")), "decontaminate-counts")
    return each.join(counts, "h").groupBy("win").agg(F.min(F.struct("c", "h", "offset")).alias("p")).select("p.h", "win", "p.offset")


def _joined(rows: DataFrame, keep: list[str], items: DataFrame, size: int) -> DataFrame:
    """FOUND of every row by a join on prefix shingles."""
    windows = staged(_windows(items, size), "decontaminate-windows")
    prefixes = staged(_prefixes(windows), "decontaminate-prefixes")
    # the filter: at most FILTER_BITS / 64 rows come here
    word = F.pmod(F.shiftrightunsigned("h", 6), F.lit(FILTER_BITS // 64)).cast("int")
    bits = prefixes.select(word.alias("i"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("b")).groupBy("i").agg(F.bit_or("b").alias("b"))
    got = bits.toArrow()
    table_ = np.zeros(FILTER_BITS // 64, np.uint64)
    table_[got["i"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    lengths = sorted({r[0] for r in prefixes.select(F.least(F.size(F.split("win", " ")), F.lit(SHINGLE))).distinct().collect()})  # SHINGLE values at most
    shared = rows.sparkSession.sparkContext.broadcast(table_)

    def places(batches):
        mask = shared.value
        for batch in batches:
            key, at, h, base, near = [], [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                w = words(text.as_py())
                for k in lengths:
                    found = np.fromiter((xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), seed=42) for i in range(len(w) - k + 1)), np.uint64, max(0, len(w) - k + 1))
                    place = ((found >> np.uint64(6)) % np.uint64(len(mask))).astype(np.int64)
                    for i in np.flatnonzero((mask[place] >> (found & np.uint64(63))) & np.uint64(1)).tolist():
                        key.append(d)
                        at.append(i)
                        h.append(int(found[i].astype(np.int64)))
                        base.append(max(0, i - size))
                        near.append(b" ".join(w[base[-1] : i + size]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(at, pa.int32()), pa.array(h, pa.int64()), pa.array(base, pa.int32()), pa.array(near, pa.string())], names=["key", "at", "h", "base", "near"])

    key = F.unhex(F.sha2("__text", 256))
    candidates = staged(rows.select(key.alias("key"), "__text").where("__text is not null").mapInArrow(places, "key binary, at int, h bigint, base int, near string").distinct(), "decontaminate-places")
    start = F.col("at") - F.col("offset")
    length = F.size(F.split("win", " "))
    same = (start >= F.col("base")) & (F.array_join(F.slice(F.split("near", " "), F.greatest(start - F.col("base") + 1, F.lit(1)), length), " ") == F.col("win"))
    occur = staged(candidates.join(small(prefixes, size=F.octet_length("win")), "h").where(same).select("key", start.alias("a"), (start + length).alias("b"), "win").distinct(), "decontaminate-hits")
    # one row for each word of a document that is hit, so the lists hold a document at most
    hit = occur.select("key", F.explode(F.sequence("a", F.col("b") - 1)).alias("x")).groupBy("key").agg(F.count_distinct("x").alias("n_hit"))
    of = occur.select("key", "win").distinct().join(small(windows, size=F.octet_length("win") + F.octet_length("item")), "win").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    result = staged(hit.join(of, "key"), "decontaminate-result")

    def count(batches):
        for batch in batches:
            n = pa.array([len(words(t.as_py())) for t in batch.column(len(keep))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], batch.column(len(keep) + 1), n], names=[*keep, "key", "n_words"])

    counted = rows.select(*keep, "__text", key.alias("key")).mapInArrow(count, T.StructType([*rows.select(*keep).schema.fields, T.StructField("key", T.BinaryType()), T.StructField("n_words", T.LongType())]))
    none = F.array().cast("array<string>")
    return counted.join(small(result, size=F.octet_length(F.array_join("items", ","))), "key", "left").select(*keep, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


def mark(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = 10, most: int = SMALL, keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with n_words, n_hit and items (sorted ids of items with occurring windows).

    Null texts have no words; an empty benchmark marks nothing; repeated items count once by
    id, a null id is an empty one. Every word of a document, however long, and every window
    of the benchmark takes part; repeated rows give repeated results, an empty table an
    empty one. Columns of df of the added names are replaced, other columns pass through.

    most: bytes of benchmark text up to which its index goes to the workers.
    """
    columns = df.columns if keep is None else keep
    rows = df.select(*safe(df, columns), F.col(text_col).cast("binary").alias("__text"))
    keep = [f"__c{i}" for i in range(len(columns))]
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(item_text).cast("binary").alias("t")).where("t is not null")
    if (items.agg(F.sum(F.octet_length("t") + F.octet_length("i"))).first()[0] or 0) <= most:
        found = _sent(rows, keep, [(r["i"], bytes(r["t"])) for r in items.collect()], size)
    else:
        found = _joined(rows, keep, items, size)
    return restored(found, columns, ["n_words", "n_hit", "items"])


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    rows = mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP6_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
     b as (select item_id, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
     bs as (select item_id, w, least(10, len(w)) as l, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0),
     bw as (select distinct item_id, l, array_to_string(w[i:i+l-1], ' ') as k from bs),
     ls as (select distinct l from bw),
     ds as (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i from d, ls where len(w) >= l),
     h as (select ds.doc_id, ds.i, ds.l, bw.item_id from ds join bw on ds.l = bw.l and array_to_string(ds.w[ds.i:ds.i+ds.l-1], ' ') = bw.k),
     p as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(i, i+l)) as x from h) group by doc_id),
     it as (select doc_id, list_sort(list(distinct item_id::varchar)) as items from h group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(p.n_hit, 0)::bigint as n_hit, coalesce(len(it.items), 0)::bigint as n_items,
       sha256(coalesce(array_to_string(it.items, ','), '')) as items_sha256, coalesce(p.n_hit, 0) > 0 as contaminated
from d left join p using (doc_id) left join it using (doc_id)
"""
