"""Closest names by edits: an index of deletions joined by key, and bounds by shared characters for what it can't settle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged

#: Edits that the index answers, and the first characters of a name that its keys are of.
EDITS, PREFIX = 2, 12
#: Names that bound an open name's distance, and bits of a set of characters.
SEEDS, BITS = 512, 256
#: Kinds of open names that are sent to all tasks at most; more meet the known ones as a product of partitions.
KINDS = 2**16


def deletions(c: Column, edits: int = EDITS, prefix: int = PREFIX) -> Column:
    """What is left of a name's first characters after at most so many are deleted, each once.

    Of two names within `edits` edits each other's first characters leave one common string:
    what both keep, cut to the shorter. So names that share none are further apart.
    """
    every = last = F.array(F.substring(c, 1, prefix))
    for _ in range(edits):
        one = lambda s: F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))).otherwise(F.array().cast("array<string>"))
        last = F.array_distinct(F.flatten(F.transform(last, one)))
        every = F.array_union(every, last)
    return every


def _spread(df: DataFrame) -> DataFrame:
    """Dealt to four tasks for each core: names are few bytes, so Spark would make some hundred thousands one task's, and what is made of them takes long."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def distinct(names: DataFrame, name: str = "symbol") -> DataFrame:
    """(known): the distinct names, case ignored, without null."""
    return names.where(F.col(name).isNotNull()).select(F.lower(name).alias("known")).distinct()


def index(names: DataFrame, name: str = "symbol", edits: int = EDITS) -> DataFrame:
    """(key, known): deletions of the distinct names, case ignored; null names have none. Worth keeping as a table for many lookups."""
    return _spread(distinct(names, name)).select(F.explode(deletions(F.col("known"), edits)).alias("key"), "known")


def _letters(c: Column) -> Column:
    """A name's characters in order, the same of all names that have the same ones."""
    return F.array_join(F.array_sort(F.split(c, "")), "")


def _sets(df: DataFrame, letters: str, name: str) -> DataFrame:
    """Adds the length of letters, its characters' bits (first of a kind, second of a kind, ...) and how many characters got no bit of their own."""
    every = F.split(letters, "")
    slots = F.transform(every, lambda x, i: F.pmod(F.xxhash64(x, i - F.array_position(every, x)), F.lit(BITS)).cast("int"))
    df = df.withColumn("__slots", slots).withColumns({f"{name}_n": F.length(letters), f"{name}_more": F.size("__slots") - F.size(F.array_distinct("__slots"))})
    word = lambda i: F.aggregate("__slots", F.lit(0).cast("long"), lambda a, x: F.when((x >= 64 * i) & (x < 64 * i + 64), a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x - 64 * i))).otherwise(a))
    return df.withColumns({f"{name}_{i}": word(i) for i in range(BITS // 64)}).drop("__slots")


def _far(every: DataFrame, open_: DataFrame, n: int) -> DataFrame:
    """(wanted, known, distance): pairs among which are the n closest known names of each open one.

    Of two names one has at least as many edits from the other as the longer has characters
    that both don't share, which is the same for all names of the same characters. So only
    kinds of names meet all others, and a name's distances are taken where that bound and the
    known name come before the distance and name of the n-th of some short names and some
    others. A kind's first name stands for its names in that order.
    """
    seeds = every.orderBy(F.length("known"), "known").limit(SEEDS // 2).unionByName(every.orderBy(F.xxhash64("known"), "known").limit(SEEDS // 2)).distinct()
    seeds = seeds.agg(F.collect_list("known").alias("seeds"))  # one row
    met = F.sort_array(F.transform("seeds", lambda s: F.struct(F.levenshtein(F.col("wanted"), s).alias("d"), s.alias("known"))))
    nth = _spread(open_).crossJoin(F.broadcast(seeds)).select("wanted", F.try_element_at(met, F.lit(n)).alias("nth"))
    most = F.when(F.col("nth").isNull(), F.struct(F.lit(2**31 - 1).alias("d"), F.lit("").alias("known"))).otherwise(F.col("nth"))
    asked = staged(nth.select("wanted", most.alias("most"), _letters(F.col("wanted")).alias("w")), "lookup-open")
    named = staged(_spread(every).select("known", _letters(F.col("known")).alias("k")), "lookup-kinds")
    a = staged(_sets(asked.groupBy("w").agg(F.max("most").alias("w_most")), "w", "w"), "lookup-asked-sets")
    b = _spread(staged(_sets(named.groupBy("k").agg(F.min("known").alias("first")), "k", "k"), "lookup-known-sets"))
    both = sum((F.bit_count(F.col(f"w_{i}").bitwiseAND(F.col(f"k_{i}"))) for i in range(1, BITS // 64)), F.bit_count(F.col("w_0").bitwiseAND(F.col("k_0"))))
    bound = F.greatest("w_n", "k_n") - both - F.least("w_more", "k_more")
    within = lambda d, known, most: (d < F.col(f"{most}.d")) | ((d == F.col(f"{most}.d")) & (F.col(known) <= F.col(f"{most}.known")))
    sent = F.broadcast(a) if a.count() <= KINDS else _spread(a).hint("shuffle_replicate_nl")
    kinds = b.join(sent, within(bound, "first", "w_most")).select("w", "k", "first", bound.alias("bound"))
    pairs = asked.hint("merge").join(kinds, "w").where(within(F.col("bound"), "first", "most")).select("wanted", "most", "k", "bound")
    pairs = named.hint("merge").join(pairs, "k").where(within(F.col("bound"), "known", "most"))
    return pairs.select("wanted", "known", "most", F.levenshtein("wanted", "known").alias("distance")).where(within(F.col("distance"), "known", "most")).drop("most")


def closest(table: DataFrame, wanted: DataFrame, n: int = 1, name: str = "wanted", edits: int = EDITS, known: DataFrame | None = None) -> DataFrame:
    """(wanted, known, distance, rank, by_key): the n closest known names of each distinct wanted one, by distance, then name.

    table: index() with the same edits. known: distinct() of the same names, where it is at
    hand; else they are taken from the table. A wanted name with n known ones within its edits
    has its answer, as the index misses none of these. The others are measured against the known
    names that enough characters are shared with, spread over tasks, each of which keeps n of
    a wanted name before the shuffle.
    by_key tells which way an answer came. Null names and an empty index give no rows; case is
    ignored; of fewer than n known names all are given.

    Joins by key or name are never broadcasts: a table of names is small, and its deletions,
    which Spark takes for as small, are not. Keys meet by their hashes; the distance tells those
    apart that only share a hash.
    """
    asked = staged(wanted.where(F.col(name).isNotNull()).select(F.lower(name).alias("wanted")).distinct(), "lookup-wanted")
    hashed = F.xxhash64("key").alias("h")
    keys = _spread(asked).select("wanted", F.explode(deletions(F.col("wanted"), edits)).alias("key")).select("wanted", hashed)
    close = F.levenshtein("wanted", "known", edits)  # -1 beyond
    near = table.select(hashed, "known").hint("merge").join(keys, "h").select("wanted", "known", close.alias("distance")).where("distance >= 0").distinct()
    order = Window.partitionBy("wanted").orderBy("distance", "known")  # each task keeps n of a name before it shuffles
    ranked = staged(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n), "lookup-near")
    settled = ranked.groupBy("wanted").agg(F.count("*").alias("c")).where(F.col("c") >= n)
    open_ = staged(asked.join(settled.hint("merge"), "wanted", "left_anti"), "lookup-unsettled")
    every = table.select("known").distinct() if known is None else known
    far = _far(staged(every, "lookup-known"), open_, n).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.join(settled.hint("merge"), "wanted", "left_semi").withColumn("by_key", F.lit(True)).unionByName(far.withColumn("by_key", F.lit(False)))
