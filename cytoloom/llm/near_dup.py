"""Near-duplicate classes by Order MinHash, verified by banded alignment.

1. Texts that are equal to the byte count once. Each distinct text has bucket keys: the components
   of its sketch, each of two minimum occurrence-labelled five-word k-mers in text order (shorter
   texts: three-word k-mers, and segments of which any two near ones share one), and a bag,
   its word counts in 256 bins.
2. Texts that agree in a key share a bucket. A bucket's leader is the least of its texts in a
   hashed order; members meet the leader only, through an aggregate and a join, so a bucket
   of any size gives no more pairs than rows.
3. Pairs are verified on whole texts: word edit similarity of at least 0.8, by banded
   alignment. Texts of a leader with many partners go out once for each share of them.
4. Members that differ from their leader (texts that share a passage and little else, or a
   second class in the bucket) are compared with each other, and with the members that match
   it, by length, bag, sets of neighbouring words, which feel order, and, for the latter,
   the distances of both from the leader, which bound that between them: blocks of a bounded
   number of rows, each pair of blocks a task. Bags and sets move here, texts don't. Pairs that may
   be near are aligned in tiles: a task has the texts of some rows and columns of the pairs'
   matrix, each once, so what moves and comes out are texts and links, not pairs. Where a task finds very many, as in a second class, each
   text has its best partner first, and the group comes again, with the pairs left between
   classes that these links didn't join; after some such rounds all that is left comes at
   once, in a stream. No bucket is capped or dropped.
5. Classes are the connected components of the verified links, and copies join their text.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sketches
from .common import discard, small, staged, table
from .decontaminate import words
from .graph import components

SIMILARITY = 0.8
#: Rows of a block of bags.
BLOCK = 4096
#: Partners of a leader that one copy of its text serves.
SHARE = 256
#: Pairs for each text above which a task of the comparison gives the best ones first, and the rounds in which it may.
DENSE, ROUNDS = 256, 8
#: Texts of a side of a tile, and their words, at most (one text may have more).
TILE, WORDS = 128, 2**19


def key_of(text: Column) -> Column:
    """Identity of a distinct text: 96 bits."""
    return F.substring(F.unhex(F.md5(text)), 1, 12)


def _identified(df: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    """The columns, identity d and bytes t of every row's text; null counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return df.select(*columns, key_of(text).alias("d"), text.alias("t"))


def sketched(df: DataFrame, text_col: str) -> DataFrame:
    """(d, n, keys, bag) of every row's text: identity, number of words, bucket keys and bag."""

    def run(batches):
        known = sketches.Words()
        for batch in batches:
            counts, keys, bags = [], [], []
            for t in batch.column(1):
                w = words(t.as_py())
                numbers = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
                counts.append(len(w))
                keys.append(sketches.keys(numbers, SIMILARITY))
                bags.append(sketches.bag(numbers))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(bags, pa.binary())], names=["d", "n", "keys", "bag"])

    return _identified(df, text_col).mapInArrow(run, "d binary, n int, keys array<bigint>, bag binary")


def _led(distinct: DataFrame) -> DataFrame:
    """(key, d, n, leader, ln), staged: members of buckets of two texts and more, with the bucket's leader; without the leaders themselves.

    The first aggregate moves whole numbers only; buckets of one text, which most are, end there.
    """
    rows = distinct.select(F.explode("keys").alias("key"), "d", "n").withColumn("h", F.xxhash64("d"))
    shared = staged(rows.groupBy("key").agg(F.min("h").alias("least"), F.count("*").alias("c")).where("c > 1").select("key", "least"), "near-shared")
    buckets = staged(rows.join(shared, "key"), "near-buckets")
    discard(shared)
    leaders = staged(buckets.where("h = least").select("key", F.col("d").alias("leader"), F.col("n").alias("ln")), "near-leaders")  # plain sides, which adaptive execution splits at a hot bucket
    led = staged(buckets.where("h <> least").select("key", "d", "n").join(leaders, "key"), "near-led")
    discard(buckets, leaders)
    return led


def _close(a: str, b: str) -> Column:
    """Lengths that allow the similarity."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b) - 1e-6


def _aligned(pairs: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """(a, b, n, ok, edits) of staged distinct pairs (a, b), staged: words of b, whether the texts are similar, and sketches.edits(). a is the one that may have many partners."""
    hot = staged(pairs.groupBy("a").agg(F.count("*").alias("c")).where(F.col("c") > SHARE), "near-hot")
    salt = F.when(F.col("c").isNull(), 0).otherwise(F.pmod(F.xxhash64("b"), F.ceil(F.col("c") / SHARE)))
    pairs = staged(pairs.join(small(hot), "a", "left").select("a", "b", salt.cast("int").alias("salt")), "near-pairs")
    # the texts that pairs need; copies fold before the shuffle
    needed = staged(pairs.select(F.explode(F.array("a", "b")).alias("d")).distinct(), "near-needed")
    texts = _identified(df, text_col).join(small(needed), "d", "left_semi").dropDuplicates(["d"])
    leaders = pairs.select("a", "salt").distinct().join(texts.select(F.col("d").alias("a"), F.col("t").alias("ta")), "a")
    both = pairs.join(texts.select(F.col("d").alias("b"), F.col("t").alias("tb")), "b").join(leaders, ["a", "salt"])

    def run(batches):
        recent: OrderedDict[bytes, list[bytes]] = OrderedDict()
        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            found, n = [], []
            for i in range(batch.num_rows):
                k = a[i].as_py()
                if k not in recent:
                    recent[k] = words(ta[i].as_py())
                    if len(recent) > 4:
                        recent.popitem(last=False)
                other = words(tb[i].as_py())
                n.append(len(other))
                found.append(sketches.edits(recent[k], other, SIMILARITY))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(n, pa.int32()), pa.array([x for x, _ in found], pa.bool_()), pa.array([x for _, x in found], pa.int32())], names=["a", "b", "n", "ok", "edits"])

    out = staged(both.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary, n int, ok boolean, edits int"), "near-aligned")
    discard(hot, pairs, needed)
    return out


def _ordered(df: DataFrame, text_col: str, needed: DataFrame) -> DataFrame:
    """(d, grams) of the texts in needed (d)."""

    def run(batches):
        known = sketches.Words()
        for batch in batches:
            every = [words(t.as_py()) for t in batch.column(1)]
            found = [sketches.grams(np.fromiter(map(known.__getitem__, w), np.uint64, len(w))) for w in every]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["d", "grams"])

    return _identified(df, text_col).join(small(needed), "d", "left_semi").mapInArrow(run, "d binary, grams binary").dropDuplicates(["d"])


def _rooted(rows: DataFrame, roots: DataFrame, column: str = "d", name: str = "root") -> DataFrame:
    """rows with the class so far of the text in a column."""
    known = roots.select(F.col("u").alias(column), F.col("v").alias("__v"))
    return rows.join(known, column, "left").withColumn(name, F.coalesce("__v", column)).drop("__v")


def _leftovers(led: DataFrame, tested: DataFrame, roots: DataFrame) -> DataFrame:
    """(g, k, side, d, off): texts to compare. Groups of side 0, of bucket k, are the rejected members of a bucket, to be compared with each other;
    else the members that a leader rejected (side 1) and those that match it (side 2), with bounds of their distances from it.

    A rejected member whose distance from the leader exceeds what two steps can make up, one
    to a member that matches and one from there, meets none of them.
    """
    good = tested.where("ok").select(F.col("a").alias("leader"), F.col("b").alias("d"), "n", F.col("edits").alias("off"))
    bad = tested.where("not ok").select(F.col("a").alias("leader"), F.col("b").alias("d"), F.col("edits").alias("off"))
    left = led.join(good.select("leader", "d"), ["leader", "d"], "left_anti").join(bad, ["leader", "d"], "left")
    left = staged(left.withColumn("off", F.coalesce("off", F.abs(F.col("n") - F.col("ln")))), "near-rejected")  # not aligned: lengths too different
    # of buckets with the same rejected members one is enough
    h = F.xxhash64("d")
    several = left.groupBy("key").agg(F.count("*").alias("c"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).where("c > 1").groupBy("c", "x", "s").agg(F.min("key").alias("key")).select("key")
    each = left.select("key", "d").join(several, "key").select(F.hex(F.col("key")).alias("g"), F.col("key").alias("k"), F.lit(0).alias("side"), "d", F.lit(0).alias("off"))

    reach = good.groupBy("leader").agg(F.max("off").alias("most"), F.max("n").alias("longest"))
    outside = left.select("leader", "d", "n", "off").distinct().join(reach, "leader").where(F.col("off") - F.col("most") <= (1 - SIMILARITY) * F.greatest("n", "longest") + 1e-6)
    outside = _rooted(_rooted(outside.select("leader", "d", "off"), roots), roots, "leader", "c").where("root <> c").select("leader", "d", "off")
    inside = good.join(outside.select("leader").distinct(), "leader", "left_semi")
    side = lambda rows, s: rows.select(F.hex("leader").alias("g"), F.lit(None).cast("long").alias("k"), F.lit(s).alias("side"), "d", "off")
    return each.unionByName(side(outside, 1)).unionByName(side(inside, 2))


def _candidates(items: DataFrame, bags: DataFrame, roots: DataFrame, dense: int | None) -> DataFrame:
    """(tile, d, label, at, partners, g), staged: tiles of pairs of items of a group that are of different classes and may be similar by length, bag and order.

    A tile's row is a text, by its place `at`, with the places of its partners: rows are texts,
    not pairs, of which there may be as many as the square of a class. g is null there.
    bags (d, n, bag, grams, buckets): buckets are the groups of side 0 that a text is in. A pair comes
    from the least of those that both are in, from others only if there is none. A task that
    finds more than `dense` pairs for each text gives the best of each, and a row
    of its group g alone.
    """
    # class and bag join once for each text, not for each of its groups, of which it has some for each of its keys
    texts = staged(_rooted(items.groupBy("d").agg(F.collect_list(F.struct("g", "k", "side", "off")).alias("in")), roots), "near-members")
    each = lambda rows, *c: rows.select("d", "root", *c, F.explode("in").alias("x")).select("d", "root", *c, "x.*")
    count = lambda s: F.sum(F.when(F.col("side") == s, 1).otherwise(0))
    blocks = lambda s: F.greatest(F.lit(1), F.ceil(count(s) / BLOCK)).cast("int")
    groups = each(texts).groupBy("g").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), blocks(0).alias("b0"), blocks(1).alias("b1"), blocks(2).alias("b2")).where("r0 <> r1")
    wanted = staged(groups.select("g", "b0", "b1", "b2"), "near-groups")
    groups = small(wanted)
    rows = each(texts.join(bags, "d"), "n", "bag", "grams", "buckets").join(groups, "g")
    own = F.pmod(F.xxhash64("d"), F.when(F.col("side") == 0, F.col("b0")).when(F.col("side") == 1, F.col("b1")).otherwise(F.col("b2"))).cast("int")
    others = F.when(F.col("side") == 0, F.col("b0")).when(F.col("side") == 1, F.col("b2")).otherwise(F.col("b1"))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    i = F.when(F.col("side") == 0, F.least("own", "other")).when(F.col("side") == 1, F.col("own")).otherwise(F.col("other"))
    j = F.when(F.col("side") == 0, F.greatest("own", "other")).when(F.col("side") == 1, F.col("other")).otherwise(F.col("own"))
    rows = rows.withColumns({"i": i, "j": j}).select("g", "i", "j", "k", "side", "own", "d", "n", "root", "bag", "grams", "off", "buckets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches))  # two blocks at most
        own, n, side, off = (group[c].to_numpy() for c in ("own", "n", "side", "off"))
        d, root, grams = (group[c].to_pylist() for c in ("d", "root", "grams"))
        bags = np.frombuffer(b"".join(group["bag"].to_pylist()), np.uint8).reshape(len(d), -1)
        coarse = bags.reshape(len(d), 32, -1).sum(axis=2, dtype=np.int32)
        label = np.unique(np.array([r.hex() for r in root]), return_inverse=True)[1]
        each = side[0] == 0
        first = np.flatnonzero(own == group["i"][0].as_py() if each else side == 1)
        first = first[np.argsort(n[first], kind="stable")]
        second = np.flatnonzero(own == group["j"][0].as_py() if each else side == 2)
        second = second[np.argsort(n[second], kind="stable")]
        lengths = n[second]
        bucket, of = group["k"][0].as_py(), {}
        twice = each and group["i"][0].as_py() == group["j"][0].as_py()  # a block with itself: pairs come from both ends

        def buckets(x: int) -> frozenset[int]:
            if x not in of:
                of[x] = frozenset(group["buckets"][x].as_py())
            return of[x]

        def partners() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            """Of each text of the first block those of the second that may be near, and bounds of their distances."""
            for x in first:
                lo = np.searchsorted(lengths, SIMILARITY * n[x] - 1e-6)
                hi = np.searchsorted(lengths, n[x] / SIMILARITY + 1e-6, side="right")
                near = second[lo:hi]
                near = near[label[near] != label[x]]
                if not each:  # off: of x at least so many edits from the leader, of the others at most
                    near = near[off[x] - off[near] <= (1 - SIMILARITY) * np.maximum(n[near], n[x]) + 1e-6]
                if len(near):
                    near, moved = sketches.possible(x, near, bags, coarse, n, SIMILARITY)
                if len(near):
                    fits = sketches.in_order(x, near, grams, n, SIMILARITY)
                    near, moved = near[fits], moved[fits]
                own_pairs = np.array([min(buckets(x) & buckets(y), default=None) == bucket for y in near], bool)
                if own_pairs.any():
                    yield x, near[own_pairs], moved[own_pairs]

        def blocks(texts: np.ndarray) -> dict[int, int]:
            """The number of each text's part of a side: TILE texts, or WORDS words, at most."""
            out, number, count, held = {}, 0, 0, 0
            for x in texts.tolist():
                if count == TILE or count and held + n[x] > WORDS:
                    number, count, held = number + 1, 0, 0
                out[x], count, held = number, count + 1, held + int(n[x])
            return out

        def tiles(pairs: dict[tuple[int, int], set[tuple[int, int]]], again: bool = False) -> pa.RecordBatch:
            """A row for each text of a tile, with the places of its partners there."""
            out = []
            for (p, q), both in pairs.items():
                at: dict[int, int] = {}
                others: dict[int, list[int]] = {}
                for x, y in sorted(both):
                    for z in (x, y):
                        at.setdefault(z, len(at))
                    others.setdefault(x, []).append(at[y])
                out += [(f"{name}/{p}/{q}", d[x], int(label[x]), i, others.get(x, []), None) for x, i in at.items()]
            out += [(None, None, None, None, None, group["g"][0].as_py())] * again
            types = (pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["tile", "d", "label", "at", "partners", "g"])

        name = "/".join(str(group[c][0].as_py()) for c in ("g", "i", "j"))
        mine, other = blocks(first), blocks(second)
        rank = {x: i for i, x in enumerate(second.tolist())}
        found: dict[tuple[int, int], set[tuple[int, int]]] = {}
        bests: dict[tuple[int, int], set[tuple[int, int]]] = {}

        def add(into: dict, x: int, y: int) -> None:
            if twice and rank[x] > rank[y]:
                x, y = y, x
            into.setdefault((mine[x], other[y]), set()).add((x, y))

        total, many, part = 0, False, 0
        for x, near, moved in partners():
            x = int(x)
            if dense is not None:
                add(bests, x, int(near[np.argmin(moved / np.maximum(n[near], n[x]))]))
                total += len(near)
                many = many or total > (2 if twice else 1) * dense * len(first)
            elif mine[x] != part:  # all that is left goes in a stream
                yield tiles(found)
                found, part = {}, mine[x]
            if many:
                found = {}
                continue
            for y in near.tolist():
                if not twice or rank[x] < rank[y]:
                    add(found, x, y)
        yield tiles(bests if many else found, many)

    out = staged(rows.groupBy("g", "i", "j").applyInArrow(compare, "tile string, d binary, label int, at int, partners array<int>, g string"), "near-candidates")
    discard(texts, wanted)
    return out


def _tile_links(tiles: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """(u, v), staged: similar texts of the staged tiles of _candidates(), each tile in a task. A pair that the links of its tile already join isn't aligned."""
    needed = staged(tiles.select("d").distinct(), "near-needed")
    texts = _identified(df, text_col).join(small(needed), "d", "left_semi").dropDuplicates(["d"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, label, split, partners = {}, {}, {}, {}
        for batch in batches:  # TILE texts, or WORDS words, of two sides
            for at, k, c, t, p in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                d[at], label[at], split[at], partners[at] = k, c, words(t), p
        parent = {c: c for c in label.values()}

        def top(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        links = []
        for x in sorted(partners):
            for y in partners[x]:
                one, two = top(label[x]), top(label[y])
                if one != two and sketches.edits(split[x], split[y], SIMILARITY)[0]:
                    parent[one] = two
                    links.append((d[x], d[y]))
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in links], pa.binary()) for i in (0, 1)], names=["u", "v"])

    rows = tiles.join(texts, "d").select("tile", "at", "d", "label", "t", "partners")
    out = staged(rows.groupBy("tile").applyInArrow(align, "u binary, v binary"), "near-links")
    discard(needed)
    return out


def _classes(df: DataFrame, text_col: str) -> DataFrame:
    """(u, v): every distinct text that isn't the least of its class, by identity, with that least one."""
    found = sketched(df, text_col)
    distinct = staged(found.groupBy("d").agg(*[F.first(c).alias(c) for c in ("n", "keys", "bag")]), "near-distinct")
    led = _led(distinct)
    pairs = staged(led.where(_close("n", "ln")).select(F.col("leader").alias("a"), F.col("d").alias("b")).distinct(), "near-close")
    tested = _aligned(pairs, df, text_col)
    discard(pairs)
    links = lambda rows: rows.where("ok").select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = components(links(tested))
    items = staged(_leftovers(led, tested, roots), "near-leftovers")
    discard(led)
    if not items.limit(1).count():
        return roots
    buckets = items.where("side = 0").groupBy("d").agg(F.collect_list("k").alias("buckets"))
    needed = staged(items.select("d").distinct(), "near-needed")
    bags = distinct.select("d", "n", "bag").join(needed, "d", "left_semi").join(_ordered(df, text_col, needed), "d")
    bags = staged(bags.join(buckets, "d", "left").withColumn("buckets", F.coalesce("buckets", F.array().cast("array<bigint>"))), "near-bags")
    discard(distinct)
    found, round_ = True, 0
    discard(tested)
    while items.limit(1).count():
        # without a link the next round would find the same again, so it takes all pairs, as the last one does
        tiles = _candidates(items, bags, roots, DENSE if found and round_ < ROUNDS else None)
        new = _tile_links(tiles.where("g is null"), df, text_col)
        found = new.limit(1).count() > 0
        if found:
            before, roots = roots, components(roots.unionByName(new))
            discard(before)
        again = staged(tiles.where("g is not null").select("g").distinct(), "near-again")
        old = (items, tiles, new, again)
        items = staged(items.join(small(again), "g", "left_semi"), "near-leftovers")
        discard(*old)
        round_ += 1
    discard(items, needed, bags)
    return roots


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, class_id, class_size, root, d) for every row: class_id is the least id of the row's class, d and root identify its text and class.

    A null text counts as empty. Texts without words are near their exact copies only.
    Texts are read whole, whatever their length; a worker holds a few at once. Rows with
    equal ids keep their own classes; a null id counts as the largest. An empty table gives
    an empty result. Other columns of df are not read.
    """
    roots = _classes(df, text_col)
    mine = staged(_rooted(_identified(df, text_col, F.col(id_col).alias("id")).select("id", "d"), roots), "near-rows")
    classes = staged(mine.groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size")), "near-classes")  # as for leaders
    return mine.join(classes, "root").select(F.col("id").alias(id_col), "class_id", "class_size", "root", "d")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each class, that of class_id; of rows that repeat its id and text one stays."""
    found = near_classes(df, id_col, text_col).where(F.col(id_col).eqNullSafe(F.col("class_id")))
    chosen = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).alias("i"), "d")).alias("c")).select(F.col("c.i").alias("__i"), F.col("c.d").alias("__k"))
    rows = df.withColumn("__d", key_of(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    same = F.col(id_col).eqNullSafe(F.col("__i")) & (F.col("__d") == F.col("__k"))
    return rows.join(chosen, same, "left_semi").dropDuplicates([id_col, "__d"]).select(*df.columns)


def op10_near_dup(spark, sf_dir: str) -> DataFrame:
    """Class of every document; kept marks the one of each class that stays."""
    found = near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))
