"""Expression profiles of the cell types of every core: what a study of patients or conditions compares.

    python -m jobs.core_profiles --tables TABLES --out OUT [--config jobs/core_profiles.toml]

Reads the tables at TABLES as a canonical dataset, checks its contract, and writes for each
core, cluster and gene how many cells have the gene, its counts and its mean display value.
OUT is Parquet, partitioned by section; a run replaces the partitions of the sections it
takes and leaves the others alone, so a run that is repeated, or cut off and started again,
ends with the same files' contents.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoloom.model import Dataset
from cytoloom.operators.expression import display_values
from cytoloom.operators.validation import require_valid
from cytoloom.sources import warehouse
from cytoloom.staging import staged

from . import common

log = logging.getLogger("jobs.core_profiles")


@dataclass(frozen=True)
class Config:
    #: Sections to take; none: all.
    sections: tuple[str, ...] | list[str] = ()
    #: Display values are ln(1 + scale_factor * count / total).
    scale_factor: float = 1e4
    #: Genes that fewer cells of a core's cluster have are left out of its profile.
    min_cells: int = 1
    #: Whether a broken rule of the data contract ends the job before it writes.
    check_contract: bool = True


def profiles(ds: Dataset, scale_factor: float = 1e4, min_cells: int = 1) -> DataFrame:
    """(section_id, core_id, cluster_id, gene_id, n_cells, counts, share, mean_value): share and mean are over all cells of the core's cluster.

    The groups, some thousands, get numbers, so that a value takes a number and not three names
    through the shuffle. Values fold by group and gene before it, and it is the last one: sizes
    and names are a small table, which joins by what Spark finds cheapest.
    """
    group = ["section_id", "core_id", "cluster_id"]
    cells = staged(ds.cells.select("cell_id", *group), "profile-cells")  # read for sizes and for names
    sizes = staged(cells.groupBy(*group).agg(F.count("*").alias("of")).withColumn("g", F.monotonically_increasing_id()), "profile-sizes")
    values = display_values(ds.expression.where("count > 0"), scale_factor).join(cells.join(sizes, group).select("cell_id", "g"), "cell_id")
    sums = values.groupBy("g", "gene_id").agg(F.count("*").alias("n_cells"), F.sum("count").alias("counts"), F.sum("v").alias("v"))
    return sums.where(F.col("n_cells") >= min_cells).join(sizes, "g").select(*group, "gene_id", "n_cells", "counts", F.round(F.col("n_cells") / F.col("of"), 6).alias("share"), F.round(F.col("v") / F.col("of"), 6).alias("mean_value"))


def run(spark: SparkSession, tables: str, out: str, config: Config = Config()) -> DataFrame:
    """Writes the profiles of the chosen sections and returns all that OUT then has."""
    ds = warehouse.load(spark, tables)
    known = {r["section_id"] for r in ds.sections.select("section_id").collect()}  # a section is a slide: some dozens
    if lost := set(config.sections) - known:
        raise ValueError(f"no sections {', '.join(sorted(lost))}; there are {', '.join(sorted(known))}")
    used = ds.cells.select("core_id").distinct()
    ds = ds.having(cores=ds.cores.join(used, "core_id", "left_semi").select(*ds.cores.columns))
    if config.check_contract:
        rules = require_valid(ds)
        log.info("read %s: %d rules of the contract hold", tables, len(rules))
    if config.sections:
        cells = ds.cells.where(F.col("section_id").isin(*config.sections))
        ds = ds.having(cells=cells, expression=ds.expression.join(cells.select("cell_id"), "cell_id", "left_semi"))
    rows = profiles(ds, config.scale_factor, config.min_cells)
    # rows of a section are spread over all tasks by group and gene, so its files are many and even without another shuffle
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("section_id").parquet(out)
    back = spark.read.schema(rows.schema).parquet(out)
    for r in back.groupBy("section_id").agg(F.count("*").alias("n"), F.count_distinct("core_id").alias("cores")).orderBy("section_id").collect():
        log.info("wrote %s section_id=%s: %d rows of %d cores%s", out, r["section_id"], r["n"], r["cores"], "" if not config.sections or r["section_id"] in config.sections else " (from before)")
    return back.select(*rows.columns)


def job(spark: SparkSession, tables: str, out: str, config: str | None = None) -> DataFrame:
    return run(spark, tables, out, common.config(spark, Config, config))


if __name__ == "__main__":
    raise SystemExit(common.main("core profiles", {"tables": "folder of the source tables", "out": "folder of the profiles"}, job))
