"""From sources to canonical datasets: loaders (spark, config) by name."""

from __future__ import annotations

import json
import logging
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import affine
from ..functions.text import number_repeats, slug
from ..model import CELLS, CLUSTERS, CORES, EXPRESSION, GENES, SECTIONS, Dataset, Record, conform
from ..operators import derive, knn, spatial
from ..operators import embedding as embeddings
from . import files, warehouse

log = logging.getLogger("cytoloom.adapters")
#: Versions of the instrument's software whose files were tried. (fixed values)
VERSIONS = ("xenium-3.0.0.15",)
SECTION, PATIENT = "S1", "P01"


def check_version(version: str, known: tuple[str, ...] = VERSIONS) -> str:
    if version not in known:
        raise ValueError(f"files of {version!r} are not known; known: {', '.join(known)}")
    return version


def record_of(cfg, provenance: dict | None = None) -> Record:
    return Record(cfg.name, cfg.title, cfg.license, cfg.citation, provenance or {}, cfg.synthetic, cfg.visibility)


def genes_of(features: DataFrame, categories: DataFrame) -> DataFrame:
    """Genes of features (i, id, name, feature_type): gene features alone, repeated symbols numbered, panel by category."""
    own = number_repeats(features.where(F.col("feature_type") == "Gene Expression"), "name", "i")
    j = own.join(categories.select(F.col("gene_id").alias("id"), "category"), "id", "left")
    return conform(j.select(F.col("id").alias("gene_id"), "symbol", F.when(F.coalesce(F.col("category") == "base", F.lit(False)), "predesigned").otherwise("custom").alias("panel")), GENES)


def with_groups(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds label of groups (cell_id, group); cells without one have no transcripts and are 'Unassigned', a group that must exist.

    Columns of cells: cell_id, transcript_counts and others.
    """
    j = cells.join(groups.select("cell_id", F.col("group").alias("label")), "cell_id", "left")
    lost = j.where("label is null").agg(F.count("*").alias("n"), F.coalesce(F.bool_and(F.col("transcript_counts") == 0), F.lit(True)).alias("empty")).first()
    if lost["n"] and not (lost["empty"] and groups.where("group = 'Unassigned'").limit(1).count()):
        raise ValueError(f"{lost['n']} cells have no group")
    return j.withColumn("label", F.coalesce("label", F.lit("Unassigned")))


def clusters_of(groups: DataFrame) -> DataFrame:
    """Clusters of groups (cell_id, group, color, i): 'unassigned' last, else by size and name; a group's first colour holds."""
    g = groups.groupBy("group").agg(F.count("*").alias("n"), F.min_by("color", "i").alias("color"))
    place = F.row_number().over(Window.orderBy(F.lower("group") == "unassigned", F.col("n").desc(), "group")) - 1
    return g.select(slug(F.col("group")).alias("cluster_id"), F.col("group").alias("label"), F.upper("color").alias("color"), place.alias("order"))


def choose_embedding(cells: DataFrame, provided: DataFrame, recompute=None) -> tuple[DataFrame, dict]:
    """(cell_id, umap_x, umap_y) with the better neighbour coherence, the provided one on ties, and what was found.

    cells: (cell_id, cluster_id, n_transcripts). A cell with transcripts must be in the
    provided embedding, with numbers. recompute: a function from the cells that it covers,
    (cell_id), to another embedding of these and what is known of it; both are scored on
    them alone. Cells that it doesn't cover have no place in either.
    """
    known = provided.where(F.col("umap_x").isNotNull() & F.col("umap_y").isNotNull() & ~F.isnan("umap_x") & ~F.isnan("umap_y")).select("cell_id", "umap_x", "umap_y")
    if lost := cells.where("n_transcripts > 0").join(known, "cell_id", "left_anti").count():
        raise ValueError(f"the provided embedding misses {lost} cells with transcripts")
    covered = cells.join(known.select("cell_id"), "cell_id", "left_semi")
    made, about = {"provided": known.join(covered.select("cell_id"), "cell_id", "left_semi")}, {}
    if recompute is not None:
        again, about = recompute(covered.select("cell_id"))
        made["recomputed"] = again.join(covered.select("cell_id"), "cell_id", "left_semi").select("cell_id", "umap_x", "umap_y")
        if gaps := covered.join(made["recomputed"], "cell_id", "left_anti").count():
            raise ValueError(f"the recomputed embedding misses {gaps} cells")
    scores = {}
    for name, e in made.items():
        p = e.join(covered, "cell_id").select(F.xxhash64("cell_id").alias("id"), F.col("umap_x").cast("double").alias("x"), F.col("umap_y").cast("double").alias("y"), F.col("cluster_id").alias("label"))
        scores[name] = knn.coherence(knn.knn_plane(p), p.select("id", "label")).first()["score"]
    score = lambda name: F.lit(scores.get(name)).cast("double")
    best = cells.sparkSession.range(1).select(knn.choice(score("provided"), score("recomputed"))).first()[0]
    found = {"embedding": best, "scored_cells": covered.count(), "without_embedding": cells.join(known, "cell_id", "left_anti").count(), "recompute": about}
    return made[best], found | {f"coherence_{k}": round(v, 6) for k, v in scores.items() if v is not None}


def sensor(spark: SparkSession, cfg, raw: files.Ledger | None = None) -> Dataset:
    """One section of an imaging run: cells, counts, panel, groups, projection and image alignment below cfg.path.

    The count matrix is a Parquet table of slices (first, barcodes, indptr, indices, data),
    compressed by cell, some thousands of cells each, as no HDF5 reader is at hand. The slice
    of the first cell has the features (feature_type, id, name) as well.
    """
    raw = raw or files.Ledger()
    at = lambda kind, rel: raw.admit(kind, f"{cfg.path}/{rel}")
    experiment = json.loads("\n".join(r["value"] for r in spark.read.text(at("experiment", "outs/experiment.xenium")).collect()))
    version = check_version(experiment["analysis_sw_version"])
    cells = files.parquet_columns(spark, at("cells", "outs/cells.parquet"), "cell_id", "x_centroid", "y_centroid", "transcript_counts")
    m = spark.read.parquet(at("matrix", "outs/cell_feature_matrix.parquet"))
    barcodes = m.select("first", F.posexplode("barcodes").alias("p", "cell_id")).select((F.col("first") + F.col("p")).alias("c"), "cell_id")
    features = m.where("first = 0").select(F.posexplode(F.arrays_zip("feature_type", "id", "name")).alias("i", "f")).select("i", "f.feature_type", "f.id", "f.name")
    genes = genes_of(features, files.gene_categories(spark, at("panel", "outs/gene_panel.json")))
    coo = files.coo_from_compressed(m.select("first", "indptr", "indices", "data"), "c", "i")
    expression = coo.join(barcodes, "c").join(features.where(F.col("feature_type") == "Gene Expression").select("i", F.col("id").alias("gene_id")), "i").where("value <> 0")
    if lost := cells.join(barcodes, "cell_id", "left_anti").count():
        raise ValueError(f"{lost} cells are not in the matrix")
    expression = expression.select("cell_id", "gene_id", F.col("value").alias("count")).join(cells.select("cell_id"), "cell_id", "left_semi")
    groups = files.csv_header(spark, at("groups", "supplemental/cell_groups.csv"), "cell_id string, group string, color string").withColumn("i", F.monotonically_increasing_id())
    labelled = with_groups(cells, groups).withColumn("cluster_id", slug(F.col("label")))
    projection = files.csv_header(spark, at("projection", "outs/projection.csv"), "Barcode string, x float, y float").select(F.col("Barcode").alias("cell_id"), F.col("x").alias("umap_x"), F.col("y").alias("umap_y"))
    again = None
    if cfg.recompute_in:

        def again(covered: DataFrame) -> tuple[DataFrame, dict]:
            counts, parameters = expression.join(covered, "cell_id", "left_semi"), {**embeddings.PARAMETERS, "dataset": cfg.name, "seed": cfg.seed}
            made, hit = embeddings.cached(counts, parameters, cfg.recompute_in, lambda: embeddings.mapped(counts, genes, covered, seed=cfg.seed))
            return made, {"parameters": parameters, "cached": hit}

    embedding, found = choose_embedding(labelled.select("cell_id", "cluster_id", F.col("transcript_counts").alias("n_transcripts")), projection, again)
    found["recompute"].pop("cached", None)  # a second run differs in this alone
    nan = F.lit(float("nan")).cast("float")
    j = labelled.join(embedding, "cell_id", "left")
    out = j.select(
        "cell_id", F.lit(SECTION).alias("section_id"), F.lit(f"{SECTION}-region").alias("core_id"), F.lit(PATIENT).alias("patient_id"), F.col("x_centroid").alias("x_um"), F.col("y_centroid").alias("y_um"),
        F.coalesce("umap_x", nan).alias("umap_x"), F.coalesce("umap_y", nan).alias("umap_y"), (F.col("umap_x").isNotNull() & F.col("umap_y").isNotNull() & ~F.isnan("umap_x") & ~F.isnan("umap_y")).alias("has_umap"), "cluster_id", F.col("transcript_counts").alias("n_transcripts"),
    )
    out = conform(out, CELLS)
    sizes = out.groupBy("cluster_id").agg(F.count("*").alias("n_cells"))
    clusters = conform(clusters_of(groups).join(sizes, "cluster_id", "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0))), CLUSTERS)
    box = spatial.bounding(out, "core_id")
    cores = conform(box.select("core_id", F.lit(SECTION).alias("section_id"), F.lit(PATIENT).alias("patient_id"), F.lit("region").alias("kind"), F.col("cx").alias("center_x_um"), F.col("cy").alias("center_y_um"), F.col("radius").alias("radius_um"), F.col("x0").alias("bbox_x0"), F.col("y0").alias("bbox_y0"), F.col("x1").alias("bbox_x1"), F.col("y1").alias("bbox_y1")), CORES)
    source = F.array(*[F.lit(v) for v in files.matrix_csv(spark, at("alignment", "supplemental/he_imagealignment.csv"))])
    px = F.lit(float(experiment["pixel_size"]))
    sections = conform(
        box.select(F.lit(SECTION).alias("section_id"), F.lit("he_image.ome.tif").alias("he_image"), affine.um_to_pixel(source, px).alias("affine"), source.alias("affine_source"), px.alias("pixel_size"), affine.pixel_um(source, px).alias("he_pixel_size_um"), F.col("x0").alias("bounds_x0"), F.col("y0").alias("bounds_y0"), F.col("x1").alias("bounds_x1"), F.col("y1").alias("bounds_y1")),
        SECTIONS,
    )
    raw.check()
    log.info("%s: version %s", cfg.name, version)
    return Dataset(sections, cores, clusters, genes, out, conform(expression, EXPRESSION), record_of(cfg, {"version": version, **found, "raw": list(raw.used)}))


def saved(spark: SparkSession, cfg) -> Dataset:
    """A dataset that was saved before."""
    ds = files.load(spark, cfg.path)
    return ds.having(record=record_of(cfg, ds.record.provenance))


def derived(spark: SparkSession, cfg) -> Dataset:
    """Round cores cut from the saved dataset cfg.source at cfg.path."""
    plan = derive.Plan(cfg.seed, cfg.core_radius_um, cfg.n_sections, cfg.n_patients, cfg.target_cells, cfg.min_cores, cfg.split_largest, cfg.name)
    return derive.derive(files.load(spark, cfg.path), plan).having(record=record_of(cfg, {"source": cfg.source, **asdict(plan)}))


def from_warehouse(spark: SparkSession, cfg) -> Dataset:
    return warehouse.load(spark, cfg.path).having(record=record_of(cfg))


ADAPTERS = files.Adapters(sensor=sensor, saved=saved, derived=derived, warehouse=from_warehouse)
