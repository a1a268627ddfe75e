"""Intermediate tables in the folder that driver and executors share, for work in rounds."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths alone: modules that use this one are pickled with their functions, which sessions can't be.
_ours: set[str] = set()


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without it (tests) gets a temporary folder, a cluster without it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", made := tempfile.mkdtemp(prefix="cytoloom-"))
    return made


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read again, so that a lost executor costs its tasks alone. The table goes with the process, or by drop()."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _ours.add(path)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def _delete(path: str) -> None:
    _ours.discard(path)
    spark = SparkSession.active()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Deletes tables of staged() that nothing reads any more."""
    for df in tables:
        _delete(df.staged_at)


def _leave() -> None:
    for path in list(_ours):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001  the session has ended: the folder's owner cleans up
            return


atexit.register(_leave)
