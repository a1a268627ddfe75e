"""Hashes, manifests, budgets, reproducibility, and checks of files and documents."""

from __future__ import annotations

import hashlib
import json
import math
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merkle

SCHEMA_VERSION = 1
#: Families whose files are listed in an index of their own, which the manifest pins by hash.
INDEXED = ("expression", "he")
MAX_BYTES = 5_000_000_000


def assets(blobs: DataFrame, payload: str = "payload", *keep: str) -> DataFrame:
    """(rel, family, bytes, sha256, *keep) of (rel, family, payload, *keep)."""
    data = F.col(payload).cast("binary")
    return blobs.select("rel", "family", F.octet_length(data).cast("long").alias("bytes"), F.sha2(data, 256).alias("sha256"), *keep)


def family_sizes(assets_: DataFrame) -> DataFrame:
    return assets_.groupBy("family").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def over_budget(assets_: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    """(bytes, files, ok): one row."""
    return assets_.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count("*").alias("files")).withColumn("ok", F.col("bytes") <= most)


def differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """(rel, sha_one, sha_two) of files that are in one run only or differ."""
    a, b = one.select("rel", F.col("sha256").alias("sha_one")), two.select("rel", F.col("sha256").alias("sha_two"))
    return a.join(b, "rel", "full_outer").where(~F.col("sha_one").eqNullSafe(F.col("sha_two")))


def files(spark, path: str, pattern: str = "*") -> DataFrame:
    """(rel, bytes, md5, sha256) of the files below a path, read where tasks run."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return raw.select(F.col("path").alias("rel"), F.col("length").alias("bytes"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def size_matches(bytes_: Column, mb: Column) -> Column:
    """Within the rounding of a size given to a tenth of a megabyte."""
    return F.abs(bytes_ / 1e6 - mb) <= 0.05 + 1e-9


def verified(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(name, method, status) of expected (name, method, md5, mb) against found (name, bytes, md5): ok, MISMATCH or MISSING."""
    f = found.select("name", F.col("bytes").alias("f_bytes"), F.col("md5").alias("f_md5"))
    ok = F.when(F.col("method") == "md5", F.col("md5") == F.col("f_md5")).when(F.col("method") == "size", size_matches(F.col("f_bytes"), F.col("mb"))).otherwise(F.col("f_bytes") > 0)
    status = F.when(F.col("f_bytes").isNull(), "MISSING").when(F.coalesce(ok, F.lit(False)), "ok").otherwise("MISMATCH")
    return expected.join(f, "name", "left").select("name", "method", status.alias("status"))


def canonical_json(value: Any) -> str:
    """Sorted keys, no spaces, Unicode as it is, floats to ten significant digits, NaN as null."""

    def plain(v: Any) -> Any:
        if hasattr(v, "item") and not isinstance(v, (str, bytes)):
            v = v.item()
        if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
            return v
        if isinstance(v, float):
            return None if math.isnan(v) else float(f"{v:.10g}")
        if isinstance(v, dict):
            return {str(k): plain(x) for k, x in v.items()}
        return [plain(x) for x in v]

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def manifest(assets_: DataFrame, record: dict, counts: dict) -> dict:
    """The manifest; families of many files are listed in indexes whose hashes it has.

    Indexes are files of their own; the driver gets one hash for each family, and the files
    of the other families: tables, thumbnails, and five for each core.
    """
    listed = {r["rel"]: {"bytes": r["bytes"], "family": r["family"], "sha256": r["sha256"]} for r in assets_.where(~F.col("family").isin(*INDEXED, "index")).collect()}
    indexes = {r["family"]: {"bytes": r["bytes"], "files": r["files"], "sha256": r["sha256"]} for r in index_hashes(assets_).collect()}
    sizes = {r["family"]: {"bytes": r["bytes"], "files": r["files"]} for r in family_sizes(assets_).collect()}
    record = {k: v for k, v in record.items() if k != "release"}
    body = {"counts": counts, "dataset": record, "files": listed, "indexes": indexes, "schema_version": SCHEMA_VERSION, "sizes": sizes}
    return body | {"release": hashlib.sha256(canonical_json(body).encode()).hexdigest()[:12]}


def index_files(assets_: DataFrame) -> DataFrame:
    """(rel, family, payload, of, files, bytes): index files of the indexed families, a line "path bytes sha256" for each of their files.

    A family has up to 4,096 index files, by a hash of the path, each in order of path; so an
    index of any size is written in parallel, and a file is found by its path.
    """
    group = F.substring(F.md5(F.col("rel").cast("binary")), 1, 3)
    line = F.concat("rel", F.lit(" "), F.col("bytes").cast("string"), F.lit(" "), "sha256", F.lit("\n"))
    rows = assets_.where(F.col("family").isin(*INDEXED)).groupBy(F.col("family").alias("of"), group.alias("g")).agg(F.sort_array(F.collect_list(F.struct("rel", line.alias("l")))).alias("x"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    text = F.array_join(F.transform("x", lambda r: r["l"]), "")
    return rows.select(F.concat(F.lit("index/"), "of", F.lit("/"), "g", F.lit(".txt")).alias("rel"), F.lit("index").alias("family"), text.cast("binary").alias("payload"), "of", "files", "bytes")


def index_hashes(assets_: DataFrame) -> DataFrame:
    """(family, files, bytes, sha256) of indexed families: the hash of their index files' hashes, in order of path."""
    each = index_files(assets_).select("rel", "of", "files", "bytes", F.sha2("payload", 256).alias("h"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rel", "h"))), lambda x: x["h"]), "")  # 4,096 hashes at most
    return each.groupBy(F.col("of").alias("family")).agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.sha2(whole.cast("binary"), 256).alias("sha256"))


def manifest_ok(text: Column) -> Column:
    """A manifest has schema_version 1, a dataset name and an object of files."""
    return (
        (F.get_json_object(text, "$.schema_version") == str(SCHEMA_VERSION))
        & F.get_json_object(text, "$.dataset.name").isNotNull()
        & F.coalesce(F.get_json_object(text, "$.files").startswith("{"), F.lit(False))
    )


def table_hash(df: DataFrame) -> str:
    """A fingerprint of a table that does not depend on row order: its schema and the root of its Merkle tree."""
    return hashlib.sha256(f"{df.schema.simpleString()}|{merkle.root(df)}".encode()).hexdigest()


def repository_findings(paths: DataFrame, most: int = 5_000_000, data: tuple[str, ...] = ("parquet", "h5", "h5ad", "npz", "tif", "tiff", "zarr", "zip", "gz", "csv")) -> DataFrame:
    """(path, why) of files (path, bytes) that don't belong in a repository, outside fixtures/."""
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    why = F.when(ext.isin(*data), "data file").when(F.col("bytes") > most, "too large")
    return paths.where(~F.col("path").startswith("fixtures/")).withColumn("why", why).where("why is not null").select("path", "why")


def requirements(lines: DataFrame) -> DataFrame:
    """(id, priority, title) of Markdown table rows | ID | title | priority | ... of (n, line); the first row of an id counts."""
    cells = F.transform(F.split("line", r"\|"), lambda c: F.trim(c))
    rows = lines.where(F.trim("line").startswith("|")).select("n", cells.alias("c")).where(F.col("c")[1].rlike(r"^[A-Z]+-\d+$"))
    first = rows.groupBy(F.col("c")[1].alias("id")).agg(F.min(F.struct("n", "c")).alias("f"))
    return first.select("id", F.col("f.c")[3].alias("priority"), F.col("f.c")[2].alias("title"))


def untraced(requirements_: DataFrame, tests: DataFrame, priority: str = "Must") -> DataFrame:
    """Ids of requirements of a priority that no test line mentions."""
    said = tests.select(F.explode(F.regexp_extract_all("line", F.lit(r"([A-Z]+-\d+)"), F.lit(1))).alias("id")).distinct()
    return requirements_.where(F.col("priority") == priority).join(said, "id", "left_anti").select("id")
