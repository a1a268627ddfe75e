"""Files in the formats that datasets come in."""

from __future__ import annotations

import fnmatch
import re
import tomllib
from collections.abc import Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import SCHEMAS, Dataset, Record


def parquet_columns(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def csv_header(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def matrix_csv(spark: SparkSession, path: str) -> list[float]:
    """A 3 x 3 matrix without header, as nine numbers."""
    rows = spark.read.schema("a double, b double, c double").csv(path).limit(4).collect()
    if len(rows) != 3:
        raise ValueError("the matrix must have three rows")
    return [float(v) for r in rows for v in r]


def coo_from_compressed(df: DataFrame, major: str = "major", minor: str = "minor") -> DataFrame:
    """(major, minor, value) of a compressed sparse matrix in slices (first, indptr, indices, data).

    A slice holds the majors from `first` on; its indptr begins at 0 and has one number more
    than it has majors. A matrix of any size is as many rows as its slices.
    """
    runs = "transform(sequence(1, size(indptr) - 1), i -> named_struct('m', first + i - 1, 'a', indptr[i - 1], 'b', indptr[i]))"
    bounds = df.where("size(indptr) > 1").select("indices", "data", F.explode(F.expr(runs)).alias("s"))
    part = lambda c: F.slice(c, F.col("s.a").cast("int") + 1, (F.col("s.b") - F.col("s.a")).cast("int"))
    return bounds.where("s.b > s.a").select(F.col("s.m").alias(major), F.explode(F.arrays_zip(part("indices").alias("i"), part("data").alias("d"))).alias("x")).select(major, F.col("x.i").alias(minor), F.col("x.d").alias("value"))


def compressed_slices(coo: DataFrame, majors: DataFrame, size: int = 4096) -> DataFrame:
    """(first, indptr, indices, data): slices of `size` majors of the entries (major, minor, v). majors: (major), all of them, from 0 on."""
    rows = coo.groupBy("major").agg(F.sort_array(F.collect_list(F.struct("minor", "v"))).alias("r"))
    every = majors.join(rows, "major", "left").withColumn("first", F.floor(F.col("major") / size) * size)
    every = every.withColumn("r", F.coalesce("r", F.expr("cast(array() as array<struct<minor:bigint,v:bigint>>)")))
    every = every.withColumn("upto", F.sum(F.size("r")).over(Window.partitionBy("first").orderBy("major")))
    s = every.groupBy("first").agg(F.sort_array(F.collect_list(F.struct("major", "upto", "r"))).alias("a"))
    indptr = F.concat(F.array(F.lit(0).cast("long")), F.transform("a", lambda x: x["upto"]))
    flat = F.flatten(F.transform("a", lambda x: x["r"]))
    return s.select("first", indptr.alias("indptr"), F.transform(flat, lambda x: x["minor"]).alias("indices"), F.transform(flat, lambda x: x["v"]).alias("data"))


def compressed_arrays(path: str) -> dict[str, np.ndarray]:
    """data, indices, indptr and shape of an npz file, on the driver."""
    with np.load(path) as z:
        return {k: z[k] for k in ("data", "indices", "indptr", "shape")}


def gene_categories(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, category) of a panel file: targets that are genes and have an id."""
    return panel_genes(spark.read.option("multiLine", True).json(path))


def panel_genes(panel: DataFrame) -> DataFrame:
    t = panel.select(F.explode("payload.targets").alias("t"))
    return t.where((F.col("t.type.descriptor") == "gene") & F.col("t.type.data.id").isNotNull()).select(F.col("t.type.data.id").alias("gene_id"), F.col("t.source.category").alias("category"))


def members(lines: DataFrame) -> DataFrame:
    """(name, mb) of lines '8.6 MB  name'; kB and GB count as such, others go."""
    p = r"^\s*([0-9.]+)\s*(kB|MB|GB)\s+(\S.*?)\s*$"
    unit = F.regexp_extract("value", p, 2)
    scale = F.when(unit == "kB", 1e-3).when(unit == "GB", 1e3).otherwise(1.0)
    return lines.where(F.col("value").rlike(p)).select(F.regexp_extract("value", p, 3).alias("name"), (F.expr(f"try_cast(regexp_extract(value, r'{p}', 1) as double)") * scale).alias("mb"))


def md5_list(lines: DataFrame) -> DataFrame:
    """(name, md5) of lines 'hash  name'."""
    p = r"^\s*([0-9a-fA-F]{32})\s+\*?(\S.*?)\s*$"
    return lines.where(F.col("value").rlike(p)).select(F.regexp_extract("value", p, 2).alias("name"), F.lower(F.regexp_extract("value", p, 1)).alias("md5"))


def settings(lines: DataFrame) -> DataFrame:
    """(key, value) of lines KEY=value; comments and empty lines go, quotes around a value too."""
    p = r"^\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*$"
    return lines.where(F.col("value").rlike(p) & ~F.trim("value").startswith("#")).select(F.regexp_extract("value", p, 1).alias("key"), F.regexp_replace(F.regexp_extract("value", p, 2), r"""^(["'])(.*)\1$""", "$2").alias("value"))


def config(folder: str | Path, name: str) -> dict:
    """A TOML file by name; an unknown name lists the known ones."""
    path = Path(folder) / f"{name}.toml"
    if not path.exists():
        known = ", ".join(sorted(p.stem for p in Path(folder).glob("*.toml"))) or "none"
        raise FileNotFoundError(f"no dataset {name!r}; known: {known}")
    return tomllib.loads(path.read_text())


#: fixed values: patterns of raw files and folders that must not be read
FORBIDDEN = ("transcripts.*", "morphology*", "*.zarr.zip")


def forbidden(paths: Iterable[str]) -> list[str]:
    """Those of the paths of which some part is forbidden."""
    rule = re.compile("|".join(map(fnmatch.translate, FORBIDDEN)))
    return [p for p in paths if any(map(rule.match, p.split("/")))]


class Ledger:
    """Which raw files a run reads, by path, in order of their first use, with what they are."""

    def __init__(self) -> None:
        self.used: dict[str, str] = {}

    def admit(self, kind: str, path: str | Path) -> str:
        """The path as text, entered; a forbidden one is refused."""
        text = str(path)
        if forbidden([text]):
            raise PermissionError(f"{text} must not be read")
        return self.used.setdefault(text, kind) and text

    def check(self) -> None:
        """That nothing forbidden was read, whatever entered it: for the end of a run."""
        if broken := forbidden(self.used):
            raise PermissionError(f"forbidden files were read: {', '.join(broken)}")


def save(ds: Dataset, path: str) -> None:
    """All tables as Parquet below path, then the record, so a reader never finds half a dataset."""
    from ..operators.integrity import canonical_json

    for name in SCHEMAS:
        getattr(ds, name).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    spark = ds.cells.sparkSession
    spark.createDataFrame([(canonical_json(ds.record.__dict__),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/dataset.json")


def load(spark: SparkSession, path: str) -> Dataset:
    """A saved dataset with its strict schemas."""
    import json

    try:
        text = spark.read.text(f"{path}/dataset.json").first()["value"]
    except Exception as e:
        raise FileNotFoundError(f"no dataset at {path}; build its source first") from e
    tables = {n: spark.read.schema(s).parquet(f"{path}/{n}.parquet") for n, s in SCHEMAS.items()}
    return Dataset(**tables, record=Record(**json.loads(text)))


def records(df: DataFrame) -> DataFrame:
    """One JSON string for each row, NaN as null."""
    clean = [F.when(~F.isnan(c), F.col(c)).alias(c) if isinstance(t.dataType, (T.DoubleType, T.FloatType)) else F.col(c) for c, t in ((f.name, f) for f in df.schema)]
    return df.select(F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("json"))


class Adapters(dict):
    """Loaders (spark, config) -> Dataset by name."""

    def __missing__(self, name: str):
        raise KeyError(f"no adapter {name!r}; known: {', '.join(sorted(self))}")
