"""A ledger of incoming text documents: place, size and hash of each, and what the text checks find in it.

    python -m jobs.document_ledger --documents DIR --out OUT --checkpoint DIR [--config jobs/document_ledger.toml]

Releases are pinned by the hashes of their files; this job does so for documents that arrive
over time. It is a stream over the Parquet files at DIR that takes what is there and ends:
the checkpoint knows the files that were taken, so each run reads new files alone. Results
are two tables below OUT:

- ledger: a row for each document that came, partitioned by batch and family. A batch that is
  repeated after a failure has the same files and replaces its own partitions.
- families: files, bytes, distinct contents and findings of each family, and whether its
  budget holds; each run makes it anew from the ledger.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoloom.functions.text import slug
from cytoloom.operators import documents as checks
from cytoloom.operators import integrity

from . import common

log = logging.getLogger("jobs.document_ledger")


#: Columns of documents that are read; others are left alone, missing ones are null.
DOCUMENTS = "doc_id bigint, text string, lang string, source string"


@dataclass(frozen=True)
class Config:
    #: Files of a batch at most.
    files_per_batch: int = 64
    #: Lines of more code points are counted as long.
    long_line: int = 1000
    #: Bytes that a family may have.
    max_family_bytes: int = 5_000_000_000
    #: Files that a batch writes of a family at most.
    parts: int = 8


def ledger(docs: DataFrame, long_line: int = 1000) -> DataFrame:
    """(rel, family, bytes, sha256, doc_id, n_lines, n_long, n_dates) of documents (doc_id, text, lang, source).

    rel is the document's place in a release, family the slug of its source ('none' without
    letters or digits). A null text is an empty file. A document's row is made where it is
    read: the checks run over an array of its lines, nothing is shuffled.
    """
    name = lambda c: F.coalesce(F.nullif(slug(F.coalesce(c, F.lit(""))), F.lit("")), F.lit("none"))
    rel = F.concat_ws("/", F.lit("docs"), name(F.col("lang")), F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt")))
    files = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), name(F.col("source")).alias("family"), rel.alias("rel"))
    files = files.withColumn("lines", F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(F.split("text", "\n")))
    notes = {
        "n_lines": F.size("lines"),
        "n_long": F.size(F.filter("lines", lambda s: F.length(s) > long_line)),
        "n_dates": F.size(F.regexp_extract_all("text", F.lit(f"({checks.DATE})"), F.lit(1))),
    }
    return integrity.assets(files.withColumns({k: v.cast("long") for k, v in notes.items()}), "text", "doc_id", *notes)


def families(rows: DataFrame, most: int) -> DataFrame:
    """(family, files, bytes, contents, n_dates, n_long, within) of a ledger: contents are distinct hashes."""
    sums = rows.groupBy("family").agg(F.count_distinct("sha256").alias("contents"), F.sum("n_dates").alias("n_dates"), F.sum("n_long").alias("n_long"))
    return integrity.family_sizes(rows).join(sums, "family").withColumn("within", F.col("bytes") <= most)


def run(spark: SparkSession, documents: str, out: str, checkpoint: str, config: Config = Config()) -> DataFrame:
    """Takes the files that came since the last run and returns the whole ledger."""
    at, to = (f"{out.rstrip('/')}/{name}" for name in ("ledger", "families"))

    def put(batch: DataFrame, number: int, mode: str) -> DataFrame:
        rows = ledger(batch, config.long_line).withColumn("batch", F.lit(number).cast("long"))
        spread = rows.repartition("family", F.pmod(F.xxhash64("rel"), F.lit(config.parts)))  # narrow rows
        spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("batch", "family").parquet(at)
        return rows

    def take(batch: DataFrame, number: int) -> None:
        put(batch, number, "overwrite")

    nothing = put(spark.createDataFrame([], DOCUMENTS), 0, "append")  # so that the table is there before the first document
    stream = spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", config.files_per_batch).parquet(documents)
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    read = [(p["batchId"], p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]
    for number, n in read:
        log.info("read %s: batch %d, %d documents", documents, number, n)
    if not read:
        log.info("read %s: nothing new", documents)
    back = spark.read.schema(nothing.schema).parquet(at).select(*nothing.columns)
    families(back, config.max_family_bytes).write.mode("overwrite").parquet(to)
    for r in spark.read.parquet(to).orderBy("family").collect():  # a row for each source
        log.info("wrote %s family=%s: %d documents, %d bytes%s", at, r["family"], r["files"], r["bytes"], "" if r["within"] else f", over the budget of {config.max_family_bytes}")
    return back


def job(spark: SparkSession, documents: str, out: str, checkpoint: str, config: str | None = None) -> DataFrame:
    return run(spark, documents, out, checkpoint, common.config(spark, Config, config))


if __name__ == "__main__":
    raise SystemExit(common.main("document ledger", {"documents": "folder of Parquet files of documents, or a pattern", "out": "folder of the results", "checkpoint": "folder of the stream's checkpoint"}, job))
