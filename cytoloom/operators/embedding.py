"""A recomputed embedding: a neighbour map of principal components of display values, kept by content."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import drop, staged
from . import factor, knn, neighbour_map
from .expression import display_values
from .integrity import canonical_json, table_hash

#: Parameters of a neighbour map: principal components, neighbours of a cell (itself among them), and the distance that neighbours may have in the map.
PARAMETERS = {"scale_factor": 1e4, "components": 50, "neighbours": 15, "min_dist": 0.5}


def principal(expression: DataFrame, genes: DataFrame, k: int, cells: DataFrame | None = None, scale_factor: float = 1e4, seed: int = 0) -> DataFrame:
    """(row, p): the cells along the first k principal components of their display values, from sparse rows. row is the cell's id; p has min(k, genes) numbers.

    cells: (cell_id) of those to place, without counts too; else those with counts.
    """
    index = genes.select("gene_id", F.expr("cast(row_number() over (order by gene_id) - 1 as int)").alias("j"))
    values = display_values(expression, scale_factor).join(index, "gene_id").select(F.col("cell_id").alias("row"), "j", "v")
    rows = staged(factor.sparse_rows(values, cells.select(F.col("cell_id").alias("row")) if cells is not None else None), "embedding-rows")
    places = staged(factor.places(rows, genes.count(), k, centred=True, seed=seed), "embedding-components")
    drop(rows)
    return places


def _plane(places: DataFrame, id_: str) -> list:
    at = lambda i: F.coalesce(F.get("p", i), F.lit(0.0))  # noqa: E731  one gene alone has one component
    return [F.col("row").alias(id_), at(F.lit(0)).alias("x"), at(F.lit(1)).alias("y")]


def components(expression: DataFrame, genes: DataFrame, k: int = 2, cells: DataFrame | None = None) -> DataFrame:
    """(cell_id, umap_x, umap_y): the first two principal components of the cells' display values."""
    plane = principal(expression, genes, max(2, k), cells)
    return plane.select(*_plane(plane, "cell_id")).select("cell_id", F.col("x").cast("float").alias("umap_x"), F.col("y").cast("float").alias("umap_y"))


def mapped(expression: DataFrame, genes: DataFrame, cells: DataFrame | None = None, parameters: dict = PARAMETERS, seed: int = 0) -> DataFrame:
    """(cell_id, umap_x, umap_y): the neighbour map of the cells, from their principal components on."""
    p = parameters
    places = principal(expression, genes, p["components"], cells, p["scale_factor"], seed)
    ids = staged(places.select(F.col("row").alias("cell_id"), F.xxhash64("row").alias("row"), "p"), "embedding-ids")
    drop(places)
    if ids.count() != ids.select("row").distinct().count():
        raise ValueError("two cells have one hash")
    near = staged(knn.knn(ids, p["neighbours"] - 1, "row", "p"), "embedding-neighbours")
    at = neighbour_map.layout(staged(neighbour_map.fuzzy_graph(near, p["neighbours"]), "embedding-graph"), ids.select(*_plane(ids, "id")), p["min_dist"], seed)
    return ids.select("cell_id", F.col("row").alias("id")).join(at, "id").select("cell_id", F.col("x").cast("float").alias("umap_x"), F.col("y").cast("float").alias("umap_y"))


def cached(expression: DataFrame, parameters: dict, folder: str, compute) -> tuple[DataFrame, bool]:
    """compute(), or what an equal call left in the folder; and whether it was there. The key is a hash of the counts and parameters."""
    spark = expression.sparkSession
    key = hashlib.sha256(f"{canonical_json(parameters)}|{table_hash(expression)}".encode()).hexdigest()[:16]
    path = f"{folder}/{key}.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")  # written last, so half a table doesn't count
    hit = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    if not hit:
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), hit
