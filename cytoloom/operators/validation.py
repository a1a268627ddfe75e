"""The validation engine: schema and cross-table rules as one report.

Rules are sums of aggregations over a table joined with the small tables it refers to. Cells
meet the small tables, then their counts, and fold to a row for each core and cluster, from
which all rules of cells follow; so cells are gone through once and counts twice, by cell and
by gene. A rule's row says how many rows break it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import SCHEMAS, Dataset
from ..staging import staged
from . import spatial

RADIUS_SLACK_UM = 50.0
COUNTS_MAY_DIFFER = 0.001


@dataclass(frozen=True)
class Expected:
    """Known totals; those that are None give no rule."""

    n_cells: int | None = None
    min_cells: int | None = None
    median_transcripts: float | None = None
    n_clusters: int | None = None
    min_cores: int | None = None
    n_patients: int | None = None
    n_sections: int | None = None


class ContractError(ValueError):
    pass


def finite(c: Column) -> Column:
    c = c.cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def bad(ok: Column) -> Column:
    """Rows for which ok is false or unknown."""
    return F.coalesce(F.sum(F.when(F.coalesce(ok, F.lit(False)), 0).otherwise(1)), F.lit(0))


def _shape(df: DataFrame, name: str) -> int:
    return int([(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in SCHEMAS[name]])


def _repeats(df: DataFrame, key: Column) -> DataFrame:
    """Rows beyond the first of each key, as one number; keys fold before the shuffle."""
    return df.groupBy(key.alias("k")).agg((F.count("*") - 1).alias("extra")).agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n"))


def _not_null(df: DataFrame, *but: str) -> Column:
    out = F.lit(True)
    for c in df.columns:
        if c not in but:
            out = out & F.col(c).isNotNull()
    return out


def no_overlap(cores: DataFrame) -> DataFrame:
    """Pairs of round cores of a section whose disks overlap; touching is allowed. One row: n."""
    return spatial.overlapping(cores).agg(F.count("*").alias("n"))


def affine_ok(he: str = "he_image") -> Column:
    a = F.col("affine")
    near = lambda i, v: F.abs(a[i] - v) <= 1e-8 + 1e-5 * abs(v)
    from ..functions.affine import det

    good = a.isNotNull() & near(6, 0.0) & near(7, 0.0) & near(8, 1.0) & (F.abs(det(a)) > 1e-12) & F.col("affine_source").isNotNull() & F.col("he_pixel_size_um").isNotNull()
    return F.col(he).isNull() | F.coalesce(good, F.lit(False))


def report(ds: Dataset, expected: Expected = Expected(), name: str | None = None) -> DataFrame:
    """(ord, rule, ok, n_bad), a row for each rule; always the same rules, then those of `expected`."""
    shape = {t: F.lit(_shape(getattr(ds, t), t)) for t in SCHEMAS}
    # small, but often made from all cells, and read by several rules
    ds = ds.having(**{t: staged(getattr(ds, t), f"validation-{t}") for t in ("sections", "cores", "clusters")})
    cores = ds.cores.select("core_id", F.col("section_id").alias("k_section"), F.col("patient_id").alias("k_patient"), "kind", "center_x_um", "center_y_um", "radius_um", "bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1", F.lit(1).alias("k"))
    secs = ds.sections.select("section_id", *[f"bounds_{x}" for x in ("x0", "y0", "x1", "y1")], F.lit(1).alias("s"))
    known = ds.clusters.select("cluster_id", F.lit(1).alias("c"))
    one = lambda df, key: df.dropDuplicates([key])  # noqa: E731  a repeated key is a rule of its own and must not multiply cells
    joined = ds.cells.join(one(cores, "core_id"), "core_id", "left").join(one(secs, "section_id"), "section_id", "left")
    inside = F.col("x_um").between(F.col("bbox_x0"), F.col("bbox_x1")) & F.col("y_um").between(F.col("bbox_y0"), F.col("bbox_y1"))
    near = F.hypot(F.col("x_um") - F.col("center_x_um"), F.col("y_um") - F.col("center_y_um")) <= F.col("radius_um") + RADIUS_SLACK_UM
    has = finite(F.col("umap_x")) & finite(F.col("umap_y"))
    umap = lambda c: F.isnan(c) | finite(F.col(c))
    row_rules = {
        "cell_rows": _not_null(ds.cells) & finite(F.col("x_um")) & finite(F.col("y_um")) & umap("umap_x") & umap("umap_y") & (F.col("n_transcripts") >= 0),
        "section_fk": F.col("s") == 1,
        "core_fk": F.col("k") == 1,
        "umap": F.col("has_umap") == has,
        "patient": F.col("patient_id") == F.col("k_patient"),
        "core_section": F.col("section_id") == F.col("k_section"),
        "in_core": F.when(F.col("kind") == "core", near & inside).otherwise(inside),
        "in_section": F.col("x_um").between(F.col("bounds_x0"), F.col("bounds_x1")) & F.col("y_um").between(F.col("bounds_y0"), F.col("bounds_y1")),
    }
    # a bit for each broken rule, so that few bytes of a cell meet its counts
    broken = reduce(Column.__add__, [F.when(F.coalesce(ok, F.lit(False)), 0).otherwise(2**i) for i, ok in enumerate(row_rules.values())])
    again = F.row_number().over(Window.partitionBy("cell_id").orderBy("cell_id")) > 1  # dealt and sorted as the join needs it
    flagged = joined.select("cell_id", "core_id", "cluster_id", "n_transcripts", broken.alias("broken")).withColumns({"again": again, "here": F.lit(1)})
    sums = ds.expression.groupBy("cell_id").agg(F.sum("count").alias("e"), F.count("*").alias("entries"))
    here = F.col("here") == 1
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    # a row for each core and cluster, from which all rules of cells follow, and one of the rules of counts by gene:
    # both read cells' counts whole, so in one plan these are dealt once
    groups = flagged.join(sums, "cell_id", "full_outer").groupBy("core_id", "cluster_id").agg(
        count("here").alias("n"),
        *[count(F.shiftright("broken", i).bitwiseAND(1)).alias(r) for i, r in enumerate(row_rules)],
        count(F.when(here & ~F.col("n_transcripts").eqNullSafe(F.coalesce("e", F.lit(0))), 1)).alias("row_sum"),
        count(F.when(F.col("again"), 1)).alias("cells_repeats"),
        count(F.when(F.col("here").isNull(), F.col("entries"))).alias("stray_cells"),
    )
    genes = one(ds.genes.select("gene_id", F.lit(1).alias("g")), "gene_id")
    counts = ds.expression.join(genes, "gene_id", "left").agg(bad(F.col("g") == 1).alias("stray_genes"), bad(F.col("count") >= 0).alias("negative"))
    groups = staged(groups.unionByName(counts, allowMissingColumns=True), "validation-groups")
    cell = groups.join(one(known, "cluster_id"), "cluster_id", "left").agg(
        *[count(r).alias(r) for r in (*row_rules, "row_sum", "cells_repeats", "stray_cells", "stray_genes", "negative")],
        count(F.when(F.col("c").isNull(), F.col("n"))).alias("cluster_fk"),
        count("n").alias("n_cells"),
    )
    core = ds.cores.join(one(secs, "section_id"), "section_id", "left").agg(
        bad(_not_null(ds.cores) & F.col("kind").isin("core", "region") & F.col("patient_id").rlike(r"^P\d{2,}$") & (F.col("radius_um") > 0)).alias("core_rows"),
        bad(F.col("s") == 1).alias("core_section_fk"),
        bad((F.col("bbox_x0") >= F.col("bounds_x0")) & (F.col("bbox_y0") >= F.col("bounds_y0")) & (F.col("bbox_x1") <= F.col("bounds_x1")) & (F.col("bbox_y1") <= F.col("bounds_y1"))).alias("core_in_section"),
        F.count("*").alias("n_cores"),
        F.count_distinct("patient_id").alias("n_patients"),
    )
    empty = ds.cores.join(groups.where("n > 0").select("core_id").distinct(), "core_id", "left_anti").agg(F.count("*").alias("empty_cores"))
    gene = ds.genes.agg(bad(_not_null(ds.genes) & F.col("panel").isin("predesigned", "custom")).alias("gene_rows"))
    observed = groups.groupBy("cluster_id").agg(F.sum("n").alias("seen"))
    cluster = ds.clusters.join(observed, "cluster_id", "left").agg(
        bad(_not_null(ds.clusters) & F.col("color").rlike("^#[0-9A-Fa-f]{6}$") & (F.col("n_cells") >= 0)).alias("cluster_rows"),
        bad(F.col("n_cells") == F.coalesce("seen", F.lit(0))).alias("cluster_n"),
        F.count("*").alias("n_clusters"),
    )
    section = ds.sections.agg(
        bad(_not_null(ds.sections, "he_image", "affine", "affine_source", "he_pixel_size_um") & (F.col("pixel_size") > 0)).alias("section_rows"),
        bad(affine_ok()).alias("affine"),
        F.count("*").alias("n_sections"),
    )
    facts = cell
    for part in (core, empty, gene, cluster, section, no_overlap(ds.cores).withColumnRenamed("n", "overlaps")):
        facts = facts.crossJoin(part)  # one row each
    if expected.median_transcripts is not None:
        facts = facts.crossJoin(ds.cells.agg(F.coalesce(F.median("n_transcripts"), F.lit(0.0)).alias("median_n")))
    for table, key in (("genes", "gene_id"), ("clusters", "cluster_id"), ("cores", "core_id"), ("sections", "section_id")):
        facts = facts.crossJoin(_repeats(getattr(ds, table), F.col(key)).withColumnRenamed("n", f"{table}_repeats"))
    facts = facts.crossJoin(_repeats(ds.clusters, F.col("order")).withColumnRenamed("n", "order_repeats")).crossJoin(_repeats(ds.genes, F.lower("symbol")).withColumnRenamed("n", "symbol_repeats"))

    col = F.col
    # fixed values: the names of the rules
    rules: list[tuple[str, Column]] = [
        ("schema cells", shape["cells"] + col("cell_rows") + col("cells_repeats")),
        ("schema genes", shape["genes"] + col("gene_rows") + col("genes_repeats")),
        ("schema clusters", shape["clusters"] + col("cluster_rows") + col("clusters_repeats") + col("order_repeats")),
        ("schema cores", shape["cores"] + col("core_rows") + col("cores_repeats")),
        ("schema sections", shape["sections"] + col("section_rows") + col("sections_repeats")),
        ("cells.section_id ∈ sections", col("section_fk")),
        ("cells.core_id ∈ cores", col("core_fk")),
        ("cells.cluster_id ∈ clusters", col("cluster_fk")),
        ("cores.section_id ∈ sections", col("core_section_fk")),
        ("expression shape = cells × genes", col("stray_cells") + col("stray_genes")),
        ("expression dtype int32, ≥ 0", shape["expression"] + col("negative")),
        ("has_umap ⇔ finite UMAP coordinates", col("umap")),
        ("genes.symbol unique (case-insensitive)", col("symbol_repeats")),
        ("cells.patient_id = cores.patient_id", col("patient")),
        ("cells.section_id = core.section_id", col("core_section")),
        ("every core has ≥ 1 cell", col("empty_cores")),
        ("cells inside their core", col("in_core")),
        ("cells inside section bounds", col("in_section")),
        ("cores inside section bounds", col("core_in_section")),
        ("cores of a section do not overlap", col("overlaps")),
        ("sections with H&E have an invertible affine + source affine", col("affine")),
        ("n_transcripts = counts row sum (≤ 0.1% differ)", F.when(col("row_sum") <= COUNTS_MAY_DIFFER * col("n_cells"), 0).otherwise(col("row_sum"))),
        ("clusters.n_cells = observed", col("cluster_n")),
    ]
    e = expected
    for value, label, ok in (
        (e.n_cells, "cells = {}", lambda v: col("n_cells") == v),
        (e.min_cells, "cells ≥ {}", lambda v: col("n_cells") >= v),
        (e.median_transcripts, "median transcripts/cell = {:g}", lambda v: col("median_n") == v),
        (e.n_clusters, "clusters = {}", lambda v: col("n_clusters") == v),
        (e.min_cores, "cores ≥ {}", lambda v: col("n_cores") >= v),
        (e.n_patients, "patients = {}", lambda v: col("n_patients") == v),
        (e.n_sections, "sections = {}", lambda v: col("n_sections") == v),
    ):
        if value is not None:
            rules.append((label.format(value), F.when(ok(value), 0).otherwise(1)))
    rules.append(("dataset.name matches config", F.lit(int(name is not None and ds.record.name != name))))
    rows = F.array(*[F.struct(F.lit(i + 1).alias("ord"), F.lit(r).alias("rule"), n.cast("long").alias("n_bad")) for i, (r, n) in enumerate(rules)])
    return facts.select(F.explode(rows).alias("r")).select("r.ord", "r.rule", (F.col("r.n_bad") == 0).alias("ok"), "r.n_bad")


def require_valid(ds: Dataset, expected: Expected = Expected(), name: str | None = None) -> list:
    """The report's rows, at most some thirty; raises if any rule is broken. The message has counts alone, no values of cells."""
    rows = report(ds, expected, name).orderBy("ord").collect()
    if broken := [r for r in rows if not r["ok"]]:
        raise ContractError("the dataset breaks its contract:\n" + "\n".join(f"{r['rule']}: {r['n_bad']} bad" for r in broken))
    return rows
