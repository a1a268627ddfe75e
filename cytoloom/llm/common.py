"""What the corpus operators share: reading tables, staging in the shared folder, checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the query contracts define it: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
#: Words of the contracts: [^\x20\x09-\x0D]+ (Java regular expression).
WORD = r"[^\x20\x09-\x0D]+"

_ours: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in spark.checkpoint.dir. Only a local session without that
    setting (tests) gets a temporary folder; a cluster without it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="cytoloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again.

    This cuts lineage: a lost executor costs the tasks it ran, not the steps before. The
    tables go when the Python process ends, or by discard().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cytoloom-{name}-{uuid.uuid4().hex}"
    _ours[path] = spark
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def _delete(path: str) -> None:
    spark = _ours.pop(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*staged_: DataFrame) -> None:
    """Deletes tables of staged() that nothing reads any more, as the rounds before the last."""
    for df in staged_:
        _delete(df.staged_at)


def _remove() -> None:
    for path in list(_ours):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001  the session has ended: the folder's owner cleans up
            return


atexit.register(_remove)


def small(df: DataFrame, rows: int = 200_000, size: Column | None = None, most: int = 16 * 2**20) -> DataFrame:
    """df with a broadcast hint if it has at most so many (narrow) rows, else df as it is.

    size: bytes of what has no bound in a row, as texts and lists; their sum is then at most
    `most` too. df should be staged, as this counts it. Without the hint Spark joins by
    shuffle, where adaptive execution splits hot keys.
    """
    if size is None:
        return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
    n, total = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and total <= most else df


def null_safe(a: DataFrame, b: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join on one column where null equals null; keeps a's column."""
    return a.join(b.withColumnRenamed(on, f"__{on}"), F.col(on).eqNullSafe(F.col(f"__{on}")), how).drop(f"__{on}")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def safe(df: DataFrame, columns: list[str]) -> list[Column]:
    """The columns under names of our own, so that no input can clash with what an operator adds."""
    return [df[f"`{c}`"].alias(f"__c{i}") for i, c in enumerate(columns)]


def restored(df: DataFrame, columns: list[str], added: list[str]) -> DataFrame:
    """Columns of safe() under their names again, and those an operator added; of equal names (in any case) the added one holds."""
    new = {x.lower() for x in added}
    return df.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns) if c.lower() not in new], *added)
