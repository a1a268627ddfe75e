"""Corpus pipeline: quality, near-duplicates, benchmark decontamination, source mix, shards.

Every stage takes all that its predecessor kept and returns the columns of documents; the
last adds the shard of each row. Stages are written as Parquet and read again in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoloom.llm import decontaminate, mixing, near_dup, quality, sharding
from cytoloom.llm.common import staged, table


def whole(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and every row as one value, so that columns of any name pass through."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores 0.5 or more."""
    field = quality.train(docs, table(spark, sf_dir, "labels"), usable=quality.fold(F.col("doc_id")) != 1)
    return quality.score(whole(docs, "text"), field, keep=["row"]).where("score >= 0.5").select("row.*")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the least id."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.mark(whole(docs, "text"), table(spark, sf_dir, "benchmark"), keep=["row"]).where("n_hit = 0").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat(mixing.mix(whole(docs, "doc_id", "text", "source")), ["row.*"])


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard of 40 and its slot in it; columns of these names are replaced."""
    return sharding.shard(docs, 40)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: A trained field and banded alignment have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
