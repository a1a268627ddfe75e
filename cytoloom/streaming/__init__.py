"""An extension: the data model has no streams, but cells may arrive in files over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import CELLS


def cell_files(spark, path: str, per_trigger: int = 100) -> DataFrame:
    """Cells as a stream of Parquet files with the canonical schema."""
    return spark.readStream.schema(CELLS).option("maxFilesPerTrigger", per_trigger).parquet(path)


def running_counts(cells: DataFrame) -> DataFrame:
    """(core_id, cluster_id, n, transcripts) so far; state is one row for each pair, whatever the number of cells."""
    return cells.groupBy("core_id", "cluster_id").agg(F.count("*").alias("n"), F.sum("n_transcripts").alias("transcripts"))
