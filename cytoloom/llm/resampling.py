"""Importance resampling towards a target: documents drawn by how much likelier the target's features make them.

Features are all runs of 1 to n words. A document's weight is the sum of its features' gains;
a feature's gain is that of its bucket, the logarithm of the bucket's smoothed share in the
target over that in the documents. The draw takes the highest weights after each has got a
seeded Gumbel term, which is a draw without replacement in proportion to exp(weight).

The dictionary of distinct features does the work that depends on strings:

1. Tasks fold the features they read and one shuffle adds them up, so the dictionary has each
   distinct string once, and each is hashed once. Buckets are sums over the dictionary.
2. Gains of the buckets join the dictionary, which joins the features of each document. The
   dictionary grows with the corpus, so it is never sent whole: its head, features with at
   least 1/HEAD of all occurrences and at most WIDE bytes (so HEAD of them at most, whatever
   the corpus), goes to the workers and serves most of the features that documents hold. The
   others join by shuffle, where no key can hold more than 1/HEAD of the occurrences, but for
   strings of more than WIDE bytes.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import restored, safe, staged, table
from .decontaminate import words
from .sharding import row_hash

#: Most entries of the head, and bytes of a feature in it: some 30 MB.
HEAD, WIDE = 2**19, 64
#: Distinct features that a task gathers before it hands them on.
GATHERED = 200_000
#: Most buckets; their gains are broadcast.
BUCKETS = 2**20


def features(doc: list[bytes], n: int) -> list[bytes]:
    """All runs of 1 to n consecutive words, joined by one space."""
    return doc + [b" ".join(doc[i : i + k]) for k in range(2, n + 1) for i in range(len(doc) - k + 1)]


def dictionary(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """(feature, c, bucket) of texts (t binary): each distinct feature once, with its occurrences."""

    def fold(batches):
        def rows(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["feature", "c"])

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(features(words(text.as_py()), n))
                if len(counts) >= GATHERED:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    counted = texts.mapInArrow(fold, "feature binary, c bigint").groupBy("feature").agg(F.sum("c").alias("c"))
    return counted.withColumn("bucket", (F.crc32("feature") % buckets).cast("int"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket, from two dictionaries."""
    sums = lambda d, name: d.groupBy("bucket").agg(F.sum("c").alias(name))
    both = sums(source, "s").join(sums(target, "t"), "bucket", "full").na.fill(0, ["s", "t"])
    both = staged(both, "resampling-buckets")
    total = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(both, "bucket", "left").na.fill(0, ["s", "t"])
    share = ((F.col("t") + 1.0) * (total["s"] + float(buckets))) / ((F.col("s") + 1.0) * (total["t"] + float(buckets)))
    return every.select("bucket", F.floor(1000 * F.ln(share)).cast("long").alias("gain"))


def gumbel(id_: Column, seed: int) -> Column:
    """A seeded Gumbel term in thousandths, from the id as text; a null id is an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column], keep: list[str]) -> DataFrame:
    """(*keep, rank): places of rows in an order, from 1, without a task that sorts them all.

    Rows are dealt to ranges of the order; a range starts where those before it end.
    """
    n = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.struct(*order)] if len(order) > 1 else order
    dealt = staged(rows.select(*keep, order[0].alias("o")).repartitionByRange(n, "o").withColumn("part", F.spark_partition_id()), "resampling-ranges")
    before = F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = dealt.groupBy("part").agg(F.count("*").alias("c")).select("part", F.coalesce(before, F.lit(0)).alias("first"))  # one row for each range
    own = F.row_number().over(Window.partitionBy("part").orderBy("o"))
    return dealt.join(F.broadcast(first), "part").select(*keep, (F.col("first") + own).cast("long").alias("rank"))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", n: int = 1, buckets: int = 10_000, seed: int = 2024, least: int = 20, percent: int = 10, keep: list[str] | None = None, head: int = HEAD) -> DataFrame:
    """df (or its columns `keep`) with n_features, weight, score and rank.

    n_features counts features with repeats. score is the weight with its Gumbel term. Of the
    documents of at least `least` words, `percent` of a hundred are drawn (rounded down), those
    of the highest scores, ties to the smaller id; rank is their place from 1, null for the
    others. A null text has no words, as an empty one: weight 0. A null id is as an empty
    text in the seed and after all others in ties; rows equal in score and id are ordered
    by a hash of all their kept columns and their text. Repeated rows are documents of their
    own. An empty table gives an empty result; an empty target makes all its shares equal.
    Texts of any length count whole. Columns of df of the added names are replaced, others
    pass through.

    head: most features that go to the workers; the result doesn't depend on it.
    """
    if not 0 < buckets <= BUCKETS:
        raise ValueError(f"buckets: 1 to {BUCKETS}")
    columns = df.columns if keep is None else keep
    rows = df.select(*safe(df, columns), df[f"`{id_col}`"].alias("__id"), df[f"`{text_col}`"].cast("binary").alias("__t"))
    keep = [f"__c{i}" for i in range(len(columns))]

    source = staged(dictionary(rows.select("__t").where("__t is not null"), n, buckets), "resampling-dictionary")
    of_target = staged(dictionary(target.select(F.col(target_text).cast("binary").alias("t")).where("t is not null"), n, buckets), "resampling-target")
    gains = bucket_gains(source, of_target, buckets)
    gained = source.join(F.broadcast(gains), "bucket")  # at most BUCKETS rows
    total = source.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    in_head = (F.col("c") * head >= total) & (F.octet_length("feature") <= WIDE)
    got = gained.where(in_head).select("feature", "gain").toArrow()  # at most `head` rows of WIDE bytes
    sent = df.sparkSession.sparkContext.broadcast(dict(zip(got["feature"].to_pylist(), got["gain"].to_pylist())))

    def weigh(batches):
        known = sent.value
        for batch in batches:
            n_words, n_features, weight, left, times = [], [], [], [], []
            for text in batch.column(len(kept)):
                doc = words(text.as_py())
                each = Counter(features(doc, n))
                n_words.append(len(doc))
                n_features.append(each.total())
                weight.append(sum(known[f] * c for f, c in each.items() if f in known))
                left.append([f for f in each if f not in known])
                times.append([each[f] for f in left[-1]])
            new = [*[pa.array(x, pa.int64()) for x in (n_words, n_features, weight)], pa.array(left, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *new], names=[*kept, *names])

    kept, names = [*keep, "__id", "__row"], ["n_words", "n_features", "weight", "left", "times"]
    rows = rows.select(*keep, "__id", F.xxhash64("__t", row_hash(rows.select(*keep))).alias("__row"), "__t")
    types = (T.LongType(), T.LongType(), T.LongType(), T.ArrayType(T.BinaryType()), T.ArrayType(T.LongType()))
    schema = T.StructType([*rows.select(*kept).schema.fields, *[T.StructField(k, t) for k, t in zip(names, types)]])
    docs = staged(rows.mapInArrow(weigh, schema).withColumn("uid", F.monotonically_increasing_id()), "resampling-documents")

    others = docs.select("uid", F.explode(F.arrays_zip("left", "times")).alias("x")).select("uid", F.col("x.left").alias("feature"), "x.times")
    more = others.join(gained.where(~in_head).select("feature", "gain"), "feature").groupBy("uid").agg(F.sum(F.col("gain") * F.col("times")).alias("more"))
    whole = docs.drop("left", "times").join(more, "uid", "left").withColumn("weight", F.col("weight") + F.coalesce("more", F.lit(0))).drop("more")
    whole = staged(whole.withColumn("score", F.col("weight") + gumbel(F.col("__id"), seed)), "resampling-scores")

    able = whole.where(F.col("n_words") >= least)
    places = ranked(able, [(-F.col("score")).alias("s"), F.col("__id").isNull().alias("u"), F.col("__id"), F.col("__row")], ["uid"])
    drawn = places.where(F.col("rank") <= able.count() * percent // 100)
    return restored(whole.join(drawn, "uid", "left"), columns, ["n_features", "weight", "score", "rank"])


def draw(df: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The rows of df that resample() draws, whole, without what it adds."""
    named = [f"c{i}" for i in range(len(df.columns))]
    whole = df.select(F.struct(*[df[f"`{c}`"].alias(n) for c, n in zip(df.columns, named)]).alias("row"), *[df[f"`{parameters.get(k, d)}`"].alias(d) for k, d in (("id_col", "doc_id"), ("text_col", "text"))])
    rest = {k: v for k, v in parameters.items() if k not in ("id_col", "text_col", "keep")}
    return resample(whole, target, keep=["row"], **rest).where("rank is not null").select(*[F.col(f"row.{n}").alias(c) for c, n in zip(df.columns, named)])


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    rows = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def _oracle() -> str:
    words_ = r"regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: ((instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i+1]) - 1)::bigint)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"
    byte = lambda i: f"(instr('0123456789abcdef', x[{i}]) - 1)::bigint * {16 ** (8 - i)}"
    return f"""
with recursive bits(i, k, v) as (select i, 0, i from range(256) t(i) union all select i, k+1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
 tab as (select list(v order by i) as tab from bits where k = 8),
 d as materialized (select doc_id, {words_} as w from documents),
 ds as materialized (select f, count(*) as c from (select unnest(w) as f from d) group by f),
 bs as materialized (select f, count(*) as c from (select unnest({words_}) as f from benchmark) group by f),
 dict as materialized (select f, {crc} % 10000 as b from (select f, hex(encode(f)) as h from (select f from ds union select f from bs)), tab),
 s as (select b, sum(c) as s from ds join dict using (f) group by b), t as (select b, sum(c) as t from bs join dict using (f) group by b),
 tot as (select (select coalesce(sum(c),0) from ds)::double as ss, (select coalesce(sum(c),0) from bs)::double as tt),
 gain as (select r.b, floor(1000*ln((coalesce(t,0)+1)::double*(ss+10000)/((coalesce(s,0)+1)::double*(tt+10000))))::bigint as gain from range(10000) r(b) left join s using (b) left join t using (b), tot),
 wt as (select doc_id, sum(gain)::bigint as weight from (select doc_id, unnest(w) as f from d) join dict using (f) join gain using (b) group by doc_id),
 sc as (select doc_id, len(w)::bigint as n_features, coalesce(weight,0) as weight, substr(sha256('2024:' || doc_id),1,8) as x from d left join wt using (doc_id)),
 g as (select *, weight + floor(-1000*ln(-ln((({" + ".join(byte(i) for i in range(1, 9))}) + 0.5e0)/4294967296.0e0)))::bigint as score from sc),
 o as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from g where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10*n//100 then place end as rank from g left join o using (doc_id)
"""


OP12_SQL = _oracle()
