"""Synthetic datasets from a real one: round cores cut from tissue, replicated, dealt to patients."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import padded, replica, shade
from ..model import CELLS, CLUSTERS, CORES, EXPRESSION, SECTIONS, Dataset, Record, conform
from ..staging import drop, staged
from . import align, factor, spatial

GAP_UM, COVERAGE, BIN_UM, CANDIDATES = 100.0, 0.8, 50.0, 20_000
#: Singular vectors and starts of k-means for the split of a cluster.
LEADING, STARTS = 20, 10


@dataclass(frozen=True)
class Plan:
    seed: int = 0
    radius: float = 500.0
    sections: int = 1
    patients: int | None = None
    target_cells: int = 0
    min_cores: int = 0
    split_largest: int = 0
    name: str = "derived"


def pick_cores(cells: DataFrame, radius: float, seed: int, candidates: int = CANDIDATES) -> list[tuple[float, float]]:
    """Centers at least two radii and a gap apart whose disk is at least 80 % tissue.

    Candidates are seeded darts, drawn and judged in Spark and accepted in their order by
    spatial.spaced(); what comes to the driver are the centers, of which the tissue's box
    bounds the number.
    """
    box = cells.agg(*[f(c).alias(n) for c, f, n in (("x_um", F.min, "x0"), ("x_um", F.max, "x1"), ("y_um", F.min, "y0"), ("y_um", F.max, "y1"))]).first()
    if box["x0"] is None or box["x1"] - box["x0"] < 2 * radius or box["y1"] - box["y0"] < 2 * radius:
        return []
    inner = (box["x0"] + radius, box["y0"] + radius, box["x1"] - radius, box["y1"] - radius)
    darts = align.random_points(cells.sparkSession, candidates, inner, f"darts-{seed}")
    binned = darts.withColumn("bx", F.floor((F.col("x_um") - box["x0"]) / BIN_UM)).withColumn("by", F.floor((F.col("y_um") - box["y0"]) / BIN_UM))
    rb = int(math.ceil(radius / BIN_UM))
    share = spatial.coverage(binned, spatial.occupancy(cells, BIN_UM), int(radius // BIN_UM) if radius % BIN_UM == 0 else rb, "id").where(F.col("share") >= COVERAGE)
    chosen = spatial.spaced(darts.join(share, "id", "left_semi"), 2 * radius + GAP_UM)
    return [(r["x_um"], r["y_um"]) for r in chosen.orderBy("id").collect()]


def deal_patients(cores: int, patients: int | None, seed: int) -> list[str]:
    """Each patient at least one core, the others at random; 70 % of the cores by default."""
    n = patients or max(1, math.ceil(cores * 0.7))
    if n > cores:
        raise ValueError(f"{n} patients need as many cores at least; there are {cores}")
    rng = np.random.default_rng(seed + 1)
    owner = np.concatenate([np.arange(n), rng.integers(0, n, cores - n)])
    rng.shuffle(owner)
    return [f"P{o + 1:0{max(2, len(str(n)))}d}" for o in owner]


def split_largest(ds: Dataset, n: int, seed: int, starts: int = STARTS) -> tuple[DataFrame, DataFrame]:
    """(cells, labels) with each of the n largest clusters but 'unassigned' cut in two by k-means, the best of so many starts, over the leading singular vectors of its cells' display values."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from .expression import display_values

    names = ds.clusters.select("cluster_id", "label", "color", "order", "n_cells")
    if not n:
        return ds.cells, names.select("cluster_id", "label", "color", "order")
    largest = names.where(F.lower("label") != "unassigned").orderBy(F.col("n_cells").desc(), "order").limit(n)
    chosen = [r["cluster_id"] for r in largest.collect()]
    n_genes = ds.genes.count()
    genes = ds.genes.select("gene_id", F.expr("row_number() over (order by gene_id) - 1").alias("j"))
    values = display_values(ds.expression).join(genes, "gene_id").select(F.col("cell_id").alias("row"), "j", "v")
    cells = ds.cells
    parts = cells.where(~F.col("cluster_id").isin(chosen))
    for c in chosen:
        own = cells.where(F.col("cluster_id") == c)
        ids = own.select(F.col("cell_id").alias("row"))
        rows = staged(factor.sparse_rows(values.join(ids, "row", "left_semi"), ids), "split-rows")
        places = factor.places(rows, n_genes, LEADING, seed=seed)
        places = staged(places.withColumn("p", array_to_vector("p")), "split-places")
        drop(rows)
        best = min((KMeans(k=2, seed=seed + i, featuresCol="p").fit(places) for i in range(starts)), key=lambda m: m.summary.trainingCost)
        half = best.transform(places).select(F.col("row").alias("cell_id"), "prediction")
        cut = own.join(half, "cell_id").withColumn("cluster_id", F.concat(F.lit(f"{c}-sub-"), (F.col("prediction") + 1).cast("string")))
        parts = parts.unionByName(cut.select(*cells.columns))
    subs = F.when(F.col("cluster_id").isin(chosen), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    labels = names.withColumn("s", F.explode(subs)).select(
        F.when(F.col("s") > 0, F.concat("cluster_id", F.lit("-sub-"), F.col("s").cast("string"))).otherwise(F.col("cluster_id")).alias("cluster_id"),
        F.when(F.col("s") > 0, F.concat("label", F.lit(" · sub "), F.col("s").cast("string"))).otherwise(F.col("label")).alias("label"),
        F.when(F.col("s") == 2, shade(F.col("color"))).otherwise(F.col("color")).alias("color"),
        (F.col("order") * 2 + F.when(F.col("s") == 2, 1).otherwise(0)).alias("order"),
    )
    return parts, labels


def core_boxes(cores: DataFrame, cells: DataFrame, radius) -> DataFrame:
    """cores (core_id, nx, ny, ...) with bbox_x0 ...: the box of the core's disk and its cells. radius: a number or column."""
    extent = cells.groupBy("core_id").agg(*[f(c).alias(f"__{n}") for c, f, n in (("x_um", F.min, "x0"), ("y_um", F.min, "y0"), ("x_um", F.max, "x1"), ("y_um", F.max, "y1"))])
    x, y = F.col("nx"), F.col("ny")
    edges = {"bbox_x0": F.least("__x0", x - radius), "bbox_y0": F.least("__y0", y - radius), "bbox_x1": F.greatest("__x1", x + radius), "bbox_y1": F.greatest("__y1", y + radius)}
    return cores.join(extent, "core_id").withColumns(edges).drop(*[f"__{n}" for n in ("x0", "y0", "x1", "y1")])


def derive(ds: Dataset, plan: Plan) -> Dataset:
    """A dataset of round cores cut from ds, replicated until the plan's totals are met.

    Replicas turn by a seeded angle and move each cell by seeded normal noise of half a
    micrometre, drawn back into the core; both are hashes of core and cell, so any task gives
    the same cell the same place.
    """
    spark = ds.cells.sparkSession
    centers = pick_cores(ds.cells, plan.radius, plan.seed)
    if not centers:
        raise ValueError("no core fits the tissue")
    cells, labels = split_largest(ds, plan.split_largest, plan.seed)
    places = spark.createDataFrame([(i, *c) for i, c in enumerate(centers)], "base int, cx double, cy double")
    members = staged(spatial.within(cells, places, plan.radius).drop("d"), "derive-members")  # read for sizes, boxes, clusters, cells and counts; made from all cells
    sizes = {r["base"]: r["n"] for r in members.groupBy("base").agg(F.count("*").alias("n")).collect()}
    bases = spark.createDataFrame([(i, sizes.get(i, 0)) for i in range(len(centers))], "base int, n long")
    reps = sorted((r["rep"], r["base"]) for r in spatial.replicas(bases, plan.target_cells, plan.min_cores).collect())
    patients = deal_patients(len(reps), plan.patients, plan.seed)
    grid = {r["c"]: r for r in spatial.layout(len(reps), plan.sections, spark=spark).collect()}
    rows = [(c, base, rep, grid[c]["section"], patients[c], grid[c]["x"], grid[c]["y"]) for c, (rep, base) in enumerate(reps)]
    cores = spark.createDataFrame(rows, "c int, base int, rep int, section_id string, patient_id string, nx double, ny double").withColumn("core_id", padded("C", F.col("c") + 1, 3))

    unit = lambda *k: (F.pmod(F.xxhash64(F.lit(plan.seed), *k), F.lit(2**52)) + 0.5) / 2**52
    normal = lambda tag: 0.5 * F.sqrt(-2 * F.ln(unit(F.lit(tag), "core_id", "cell_id"))) * F.cos(2 * math.pi * unit(F.lit(tag + "'"), "core_id", "cell_id"))
    m = members.drop("section_id", "core_id", "patient_id").join(F.broadcast(cores), "base")  # the plan: some hundreds of rows
    turn = F.when(F.col("rep") > 0, 2 * math.pi * unit(F.lit("turn"), "core_id")).otherwise(0.0)
    dx, dy = F.col("x_um") - F.col("cx"), F.col("y_um") - F.col("cy")
    m = m.withColumns({"dx": F.when(F.col("rep") > 0, dx * F.cos(turn) - dy * F.sin(turn) + normal("x")).otherwise(dx), "dy": F.when(F.col("rep") > 0, dx * F.sin(turn) + dy * F.cos(turn) + normal("y")).otherwise(dy)})
    reach = staged(m.groupBy("core_id").agg(F.max(F.hypot("dx", "dy")).alias("reach")), "derive-reach")  # a row for each core
    m = m.join(reach, "core_id").withColumn("k", F.when(F.col("rep") > 0, plan.radius / F.greatest("reach", F.lit(plan.radius))).otherwise(1.0))
    m = m.withColumns({"x_um": F.col("nx") + F.col("dx") * F.col("k"), "y_um": F.col("ny") + F.col("dy") * F.col("k"), "source_id": F.col("cell_id")})
    m = m.withColumn("cell_id", F.concat("core_id", F.lit("-"), replica(F.col("cell_id"), F.col("rep"))))
    r = plan.radius
    new_cores = core_boxes(cores, m, r).select(
        "core_id", "section_id", "patient_id", F.lit("core").alias("kind"), F.col("nx").alias("center_x_um"), F.col("ny").alias("center_y_um"), F.lit(r).alias("radius_um"),
        "bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1",
    )
    per = -(-len(reps) // plan.sections)
    cols = math.ceil(math.sqrt(per))
    rows_ = -(-per // cols)
    new_sections = cores.select("section_id").distinct().select(
        "section_id", F.lit(None).cast("string").alias("he_image"), F.lit(None).cast("array<double>").alias("affine"), F.lit(None).cast("array<double>").alias("affine_source"),
        F.lit(0.2125).alias("pixel_size"), F.lit(None).cast("double").alias("he_pixel_size_um"), F.lit(0.0).alias("bounds_x0"), F.lit(0.0).alias("bounds_y0"),
        F.lit(2000.0 + cols * 1500.0).alias("bounds_x1"), F.lit(2000.0 + rows_ * 1500.0).alias("bounds_y1"),
    )
    new_cells = conform(m, CELLS)
    counts = new_cells.groupBy("cluster_id").agg(F.count("*").alias("n_cells"))
    order = F.expr("row_number() over (order by `order`) - 1")
    clusters = labels.join(counts, "cluster_id", "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0))).withColumn("order", order)
    new_expression = m.select("cell_id", F.col("source_id")).join(ds.expression.withColumnRenamed("cell_id", "source_id"), "source_id")
    return Dataset(conform(new_sections, SECTIONS), conform(new_cores, CORES), conform(clusters, CLUSTERS), ds.genes, new_cells, conform(new_expression, EXPRESSION), Record(plan.name, synthetic=True))


#: fixed values: side of the window, radius and centers of the cores in it, their patients, genes kept
WINDOW_UM, DISK_UM, DISKS, DISK_PATIENTS, TOP_GENES = 600.0, 130.0, ((150.0, 150.0), (450.0, 150.0), (150.0, 450.0), (450.0, 450.0)), ("P01", "P01", "P02", "P03"), 150


def cut_fixture(ds: Dataset, width: float = WINDOW_UM, radius: float = DISK_UM, disks=DISKS, patients=DISK_PATIENTS, top_genes: int = TOP_GENES) -> Dataset:
    """Round cores of the densest window, one section, with their most detected genes, transcripts counted over these.

    Coordinates begin at the window's corner.
    """
    spark = ds.cells.sparkSession
    window = spatial.densest(ds.cells, width).select((F.col("bx") * width).alias("wx"), (F.col("by") * width).alias("wy"))
    plan = spark.createDataFrame([(f"C{i + 1:03d}", p, x, y) for i, ((x, y), p) in enumerate(zip(disks, patients))], "core string, patient string, nx double, ny double")
    placed = plan.crossJoin(F.broadcast(window)).withColumns({"cx": F.col("nx") + F.col("wx"), "cy": F.col("ny") + F.col("wy")})  # one row
    own = spatial.within(ds.cells, placed, radius).withColumns({"x_um": F.col("x_um") - F.col("wx"), "y_um": F.col("y_um") - F.col("wy"), "section_id": F.lit("S1"), "core_id": F.col("core"), "patient_id": F.col("patient")})
    own = own.select(*ds.cells.columns)
    counts = ds.expression.join(own.select("cell_id"), "cell_id", "left_semi")
    top = counts.groupBy("gene_id").agg(F.count("*").alias("nnz")).orderBy(F.col("nnz").desc(), "gene_id").limit(top_genes).select("gene_id")
    counts = counts.join(F.broadcast(top), "gene_id", "left_semi")  # at most top_genes rows
    totals = counts.groupBy("cell_id").agg(F.sum("count").alias("t"))
    cells = conform(own.join(totals, "cell_id", "left").withColumn("n_transcripts", F.coalesce("t", F.lit(0))), CELLS)
    seen = cells.groupBy("cluster_id").agg(F.count("*").alias("seen"))
    clusters = ds.clusters.join(seen, "cluster_id").withColumn("n_cells", F.col("seen")).withColumn("order", F.expr("row_number() over (order by `order`) - 1"))
    box = {"bbox_x0": F.col("nx") - radius, "bbox_y0": F.col("ny") - radius, "bbox_x1": F.col("nx") + radius, "bbox_y1": F.col("ny") + radius}
    cores = plan.select(F.col("core").alias("core_id"), F.lit("S1").alias("section_id"), F.col("patient").alias("patient_id"), F.lit("core").alias("kind"), F.col("nx").alias("center_x_um"), F.col("ny").alias("center_y_um"), F.lit(radius).alias("radius_um"), *[v.alias(k) for k, v in box.items()])
    sections = ds.sections.orderBy("section_id").limit(1).withColumns({"section_id": F.lit("S1"), "bounds_x0": F.lit(0.0), "bounds_y0": F.lit(0.0), "bounds_x1": F.lit(width), "bounds_y1": F.lit(width)})
    return ds.having(cells=cells, expression=conform(counts, EXPRESSION), genes=ds.genes.join(F.broadcast(top), "gene_id", "left_semi"), cores=conform(cores, CORES), sections=conform(sections, SECTIONS), clusters=conform(clusters, CLUSTERS))
