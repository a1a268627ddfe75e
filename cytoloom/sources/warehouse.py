"""The canonical dataset as a view of a star schema of orders: each table is a projection of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import number_repeats, padded, slug
from ..model import CELLS, CLUSTERS, CORES, EXPRESSION, GENES, SECTIONS, Dataset, Record, conform

PALETTE = ("#1F77B4", "#FF7F0E", "#2CA02C", "#D62728", "#9467BD", "#8C564B", "#E377C2", "#7F7F7F")


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "region", "r_regionkey")
    return conform(
        r.select(
            F.concat(F.lit("S"), (F.col("r_regionkey") + 1).cast("string")).alias("section_id"),
            F.lit(None).cast("string").alias("he_image"), F.lit(None).cast("array<double>").alias("affine"), F.lit(None).cast("array<double>").alias("affine_source"),
            F.lit(0.2125).alias("pixel_size"), F.lit(None).cast("double").alias("he_pixel_size_um"),
            F.lit(0.0).alias("bounds_x0"), F.lit(0.0).alias("bounds_y0"), F.lit(6500.0).alias("bounds_x1"), F.lit(5000.0).alias("bounds_y1"),
        ),
        SECTIONS,
    )


def cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    slot = F.floor(F.col("n_nationkey") / 5)
    n = n.withColumn("x", 1000.0 + (slot % 3 + 0.5) * 1500.0).withColumn("y", 1000.0 + (F.floor(slot / 3) + 0.5) * 1500.0)
    return conform(
        n.select(
            padded("C", F.col("n_nationkey") + 1, 3).alias("core_id"), F.concat(F.lit("S"), (F.col("n_regionkey") + 1).cast("string")).alias("section_id"),
            padded("P", F.col("n_nationkey") % 15 + 1, 2).alias("patient_id"), F.lit("core").alias("kind"),
            F.col("x").alias("center_x_um"), F.col("y").alias("center_y_um"), F.lit(500.0).alias("radius_um"),
            (F.col("x") - 500).alias("bbox_x0"), (F.col("y") - 500).alias("bbox_y0"), (F.col("x") + 500).alias("bbox_x1"), (F.col("y") + 500).alias("bbox_y1"),
        ),
        CORES,
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_discount")
    per = items.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").cast("int").alias("n"), (10.0 * F.sum(F.rint(F.col("l_discount") * 100)) / (100.0 * F.count("*"))).alias("disc")
    )
    orders = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    places = (
        read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
        .join(read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumnRenamed("c_custkey", "o_custkey")
    )
    slot = F.floor(F.col("n_nationkey") / 5)
    all_ = orders.join(places, "o_custkey").join(per, "o_orderkey", "left")
    nan = F.lit(float("nan"))
    n = F.coalesce("n", F.lit(0))
    return conform(
        all_.select(
            F.col("o_orderkey").cast("string").alias("cell_id"),
            F.concat(F.lit("S"), (F.col("n_regionkey") + 1).cast("string")).alias("section_id"),
            padded("C", F.col("n_nationkey") + 1, 3).alias("core_id"),
            padded("P", F.col("n_nationkey") % 15 + 1, 2).alias("patient_id"),
            (1000.0 + (slot % 3 + 0.5) * 1500.0 + (F.col("o_totalprice") / 500000.0 * 2 - 1) * 350.0).alias("x_um"),
            (1000.0 + (F.floor(slot / 3) + 0.5) * 1500.0 + (F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) / 4000.0 * 2 - 1) * 350.0).alias("y_um"),
            F.when(F.col("n").isNotNull(), F.ln(1 + n)).otherwise(nan).cast("float").alias("umap_x"),
            F.when(F.col("n").isNotNull(), F.col("disc")).otherwise(nan).cast("float").alias("umap_y"),
            F.col("n").isNotNull().alias("has_umap"),
            slug(F.col("o_orderpriority")).alias("cluster_id"),
            n.alias("n_transcripts"),
        ),
        CELLS,
    )


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = number_repeats(read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand"), "p_name", "p_partkey")
    return conform(parts.select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("gene_id"), "symbol", F.when(F.col("p_brand").startswith("Brand#1"), "predesigned").otherwise("custom").alias("panel")), GENES)


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity").withColumn("cell_id", F.col("l_orderkey").cast("string"))
    # dealt by cell, as nearly all that follows needs it: one exchange then serves sums, totals and joins by cell
    counts = items.select("cell_id", "l_partkey", "l_quantity").repartition("cell_id").groupBy("cell_id", "l_partkey").agg(F.sum("l_quantity").cast("int").alias("count"))
    return conform(counts.select("cell_id", F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene_id"), "count"), EXPRESSION)


def cluster_table(cells_: DataFrame, labels: DataFrame) -> DataFrame:
    """Clusters from labels (cluster_id, label, ord): zero-filled counts, 'unassigned' last, then by size and name."""
    counts = cells_.groupBy("cluster_id").agg(F.count("*").alias("n"))
    every = labels.join(counts, "cluster_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    place = F.row_number().over(Window.orderBy(F.lower("label") == "unassigned", F.col("n").desc(), "label")) - 1
    colors = F.array(*map(F.lit, PALETTE))
    return conform(every.withColumn("order", place).select("cluster_id", "label", F.upper(F.element_at(colors, (F.col("order") % len(PALETTE) + 1).cast("int"))).alias("color"), "order", F.col("n").alias("n_cells")), CLUSTERS)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "orders", "o_orderpriority").distinct().select(slug(F.col("o_orderpriority")).alias("cluster_id"), F.col("o_orderpriority").alias("label"))
    return cluster_table(cells(spark, sf_dir).select("cluster_id"), labels)


def load(spark: SparkSession, sf_dir: str) -> Dataset:
    made = {f.__name__: f(spark, sf_dir) for f in (sections, cores, clusters, genes, cells, expression)}
    return Dataset(**made, record=Record("warehouse", synthetic=True))
