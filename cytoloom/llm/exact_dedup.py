"""Exact deduplication by skew-safe combining, in DataFrame operations only.

A first pass over the texts leaves a narrow row (id, length, digest) for each. A digest that
occurs once is a text without copies; the other stages see the rest only:

1. Locally: rows are grouped by digest, whole text and the task that read them. The map side
   of this aggregation folds all copies that a task has read into one row.
2. Salted: the exchange of that aggregation, with tasks dealt to salts, merges what the
   tasks of a salt found. A group of any size is spread over the salts.
3. Globally: the winners of the salts merge by digest and whole text.

Each stage groups by the text itself beside its digest, so two texts with one digest never
merge. Rows learn their group through a narrow join on the digest; where one digest has
several texts (a collision) those rows join on digest and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, small, staged, table


def normalised(text: Column) -> Column:
    """Without ASCII white space."""
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def sha256_digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def local_folds(rows: DataFrame, salts: int) -> DataFrame:
    """(d, norm, salt, best, c): rows (id, n, norm, d) folded by task, then by salt. best is the least of an ordered struct, so ids of any orderable type do."""
    best = F.min(F.struct((-F.col("n")).alias("shorter"), F.col("id").isNull().alias("unknown"), "id"))
    task = F.pmod(F.spark_partition_id(), F.lit(salts))
    return rows.withColumn("salt", task).groupBy("d", "norm", "salt").agg(best.alias("best"), F.count("*").alias("c"))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32, digest=sha256_digest) -> DataFrame:
    """One row for each row of df: its group of equal texts and the row that stays.

    Texts are equal when identical after deletion of ASCII white space; null counts as
    empty. The longest original text stays (code points), then the smallest id; a null id
    is larger than any other. Ids may be of any orderable type and any value. Rows that
    repeat both id and length of the row that stays are all marked kept, as nothing tells
    them apart. Texts are compared whole, whatever their length. An empty table gives an
    empty result. Columns: id_col, keep_id, group_size, kept, text_sha256. Other columns of
    df are not read.

    digest: from normalised text to a grouping digest; any function gives right results.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    wide = df.select(F.col(id_col).alias("id"), F.length(text).alias("n"), normalised(text).alias("norm"))
    hashed = F.lit(None).cast("binary") if digest is sha256_digest else sha256_digest(F.col("norm"))  # if the digest isn't the hash to return
    wide = wide.select("id", "n", "norm", digest(F.col("norm")).alias("d"), hashed.alias("sha"))
    rows = staged(wide.drop("norm"), "exact-rows")
    copied = staged(rows.groupBy("d").agg(F.count("*").alias("c")).where("c > 1").select("d"), "exact-copied")

    salted = local_folds(wide.join(small(copied), "d", "left_semi"), salts)
    # one exchange by digest serves both the merge by text and the count of texts a digest has
    merged = salted.repartition("d").groupBy("d", "norm").agg(F.min("best").alias("best"), F.sum("c").alias("group_size"))
    texts = F.count("*").over(Window.partitionBy("d"))
    winners = merged.select("d", texts.alias("texts"), "norm", F.col("best.id").alias("keep_id"), (-F.col("best.shorter")).alias("keep_n"), "group_size")
    winners = staged(winners.withColumn("norm", F.when(F.col("texts") > 1, F.col("norm"))), "exact-winners")

    collided = winners.where("texts > 1").drop("texts")
    parts = rows.join(small(winners.where("texts = 1").drop("norm", "texts")), "d", "left")
    if collided.limit(1).count():
        parts = parts.join(collided.select("d").distinct(), "d", "left_anti").unionByName(wide.join(collided, ["d", "norm"]).drop("norm"))
    copy = F.col("group_size").isNotNull()
    return parts.select(
        F.col("id").alias(id_col),
        F.when(copy, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (~copy | (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n")))).alias("kept"),
        F.lower(F.hex(F.coalesce("sha", "d"))).alias("text_sha256"),
    )


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
with n as (select doc_id, length(coalesce(text,'')) as n, regexp_replace(coalesce(text,''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
     g as (select *, first_value(doc_id) over (partition by norm order by n desc, doc_id) as keep_id, count(*) over (partition by norm) as group_size from n)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from g
"""
