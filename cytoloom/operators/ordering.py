"""Cell layout: section, core, Z-order, identifier; and the ranges and codes that depend on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codec import NO_EMBEDDING, U16, morton, quant_decode, quant_encode, quant_scale
from ..model import Dataset


def section_quantisers(sections: DataFrame) -> DataFrame:
    """(section_id, q_offset, q_scale): one step for both axes, from the least to the greatest bound."""
    lo, hi = F.least("bounds_x0", "bounds_y0"), F.greatest("bounds_x1", "bounds_y1")
    return sections.select("section_id", lo.alias("q_offset"), quant_scale(lo, hi).alias("q_scale"))


def core_ranks(cores: DataFrame) -> DataFrame:
    """(core_id, core_rank) in order of section and core, from 0."""
    return cores.select("core_id", (F.row_number().over(Window.orderBy("section_id", "core_id")) - 1).alias("core_rank"))


def section_ranks(sections: DataFrame) -> DataFrame:
    return sections.select("section_id", (F.row_number().over(Window.orderBy("section_id")) - 1).alias("section_rank"))


def placed(ds: Dataset) -> DataFrame:
    """Cells with qx, qy, morton, section_rank, core_rank and idx, their place in the layout.

    The place is global without a task that sorts a whole core: cells are numbered within
    one of the 1,024 top Z-order squares of their core; squares start where those before
    them end, and cores likewise.
    """
    cells = ds.cells.join(section_quantisers(ds.sections), "section_id").join(core_ranks(ds.cores), "core_id").join(section_ranks(ds.sections), "section_id")
    cells = cells.withColumns({"qx": quant_encode(F.col("x_um"), F.col("q_offset"), F.col("q_scale")), "qy": quant_encode(F.col("y_um"), F.col("q_offset"), F.col("q_scale"))})
    cells = cells.withColumn("morton", morton(F.col("qx"), F.col("qy"))).withColumn("square", F.shiftright("morton", 22).cast("int"))
    core = ["section_rank", "core_rank"]
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    squares = cells.groupBy(*core, "square").agg(F.count("*").alias("c"))
    cores = squares.groupBy(*core).agg(F.sum("c").alias("n")).withColumn("core_first", F.coalesce(F.sum("n").over(before.orderBy(*core)), F.lit(0)))
    within_core = F.coalesce(F.sum("c").over(before.partitionBy(*core).orderBy("square")), F.lit(0))
    starts = squares.withColumn("w", within_core).join(cores, core).select(*core, "square", (F.col("w") + F.col("core_first")).alias("first"))
    own = F.row_number().over(Window.partitionBy(*core, "square").orderBy("morton", "cell_id")) - 1
    return cells.join(starts, [*core, "square"]).withColumn("idx", F.col("first") + own).drop("first", "square")


def core_ranges(placed_: DataFrame) -> DataFrame:
    """(core_id, first, end, contiguous): places of a core's cells, end excluded."""
    g = placed_.groupBy("core_id").agg(F.min("idx").alias("first"), (F.max("idx") + 1).alias("end"), F.count("*").alias("n"))
    return g.select("core_id", "first", "end", (F.col("end") - F.col("first") == F.col("n")).alias("contiguous"))


def _coded_embedding(cells: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Cells with the embedding's extent and their codes ux, uy. of: the same cells, if they are made with less work for the extent alone."""
    fit = (cells if of is None else of).where("has_umap").agg(*[f(c).cast("double").alias(f"{c}_{n}") for c in ("umap_x", "umap_y") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    both = cells.crossJoin(F.broadcast(fit))  # one row
    code = lambda c: F.when(F.col("has_umap"), quant_encode(F.col(c).cast("double"), F.col(f"{c}_lo"), quant_scale(F.col(f"{c}_lo"), F.col(f"{c}_hi"), U16 - 1))).otherwise(NO_EMBEDDING)
    return both.withColumns({"ux": code("umap_x"), "uy": code("umap_y")})


def embedding_codes(cells: DataFrame) -> DataFrame:
    """(cell_id, ux, uy): codes 0..65534 fitted to cells with an embedding; 65535 for the others."""
    return _coded_embedding(cells).select("cell_id", "ux", "uy")


def embedding_error(cells: DataFrame) -> DataFrame:
    """(share): the largest error of a decoded embedding coordinate as a share of its axis's range; 0 without embedded cells. One row."""
    lo, hi = (lambda c: F.col(f"{c}_lo")), (lambda c: F.col(f"{c}_hi"))
    off = lambda c, q: F.abs(quant_decode(F.col(q), lo(c), quant_scale(lo(c), hi(c), U16 - 1)) - F.col(c).cast("double")) / F.greatest(hi(c) - lo(c), F.lit(1e-9))
    return _coded_embedding(cells).where("has_umap").agg(F.coalesce(F.max(F.greatest(off("umap_x", "ux"), off("umap_y", "uy"))), F.lit(0.0)).alias("share"))


def quantisation_errors(ds: Dataset) -> DataFrame:
    """(section_id, max_err): largest error of a decoded coordinate, in micrometres."""
    c = placed(ds)
    err = lambda v, q: F.abs(quant_decode(F.col(q), F.col("q_offset"), F.col("q_scale")) - F.col(v))
    return c.groupBy("section_id").agg(F.max(F.greatest(err("x_um", "qx"), err("y_um", "qy"))).alias("max_err"))


def typed_columns(ds: Dataset) -> DataFrame:
    """(idx, qx, qy, ux, uy, cluster, core, ntx) as whole numbers, before they become bytes; more than 255 clusters are an error.

    The embedding's codes are added to the placed cells through its extent, one row, so the
    cells aren't joined with themselves.
    """
    clusters = ds.clusters.select("cluster_id", (F.row_number().over(Window.orderBy("order")) - 1).alias("cluster"))
    gate = F.when(F.col("cluster") > 254, F.raise_error(F.lit("more than 255 clusters do not fit a byte")).cast("int")).otherwise(F.col("cluster"))
    known = ds.cells.join(ds.sections.select("section_id"), "section_id", "left_semi").join(ds.cores.select("core_id"), "core_id", "left_semi")  # those that have a place
    return _coded_embedding(placed(ds), known).join(clusters, "cluster_id").select("idx", "qx", "qy", "ux", "uy", gate.alias("cluster"), F.col("core_rank").alias("core"), F.least("n_transcripts", F.lit(U16)).alias("ntx"))
