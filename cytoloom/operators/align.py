"""Alignment of an image with its cells: nuclei stain at cell centers against random tissue, with a shifted control."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import affine
from . import raster, slides, spatial, stats

SHIFT_UM, NEAR_UM, POINTS = 25.0, 20.0, 1000


def uniform(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) from a hash of seed and keys: the same in every task."""
    text = F.concat_ws(":", F.lit(seed), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / float(2**52)


def random_points(spark: SparkSession, n: int, bounds: tuple[float, float, float, float], seed: str, first: int = 0) -> DataFrame:
    """(id, x_um, y_um): n points in a box, numbered from `first`; later numbers continue the same sequence."""
    x0, y0, x1, y1 = bounds
    i = spark.range(first, first + n)
    return i.select("id", (x0 + (x1 - x0) * uniform(f"{seed}x", F.col("id"))).alias("x_um"), (y0 + (y1 - y0) * uniform(f"{seed}y", F.col("id"))).alias("y_um"))


def accepted(spark: SparkSession, n: int, bounds, seed: str, keep, most: int = 4096) -> DataFrame:
    """The first n points, in order of their numbers, that keep(points) leaves; at most `most` tries for each, else an error."""
    tries = 4
    while True:
        found = keep(random_points(spark, tries * n, bounds, seed))
        if found.count() >= n:
            return found.orderBy("id").limit(n)
        if tries >= most:
            raise ValueError(f"fewer than {n} of {tries * n} random points are accepted")
        tries *= 4


def in_mask(points: DataFrame, mask: DataFrame, um_to_px: Column, factor: float) -> DataFrame:
    """Points whose image position is tissue. mask: (u, v, tissue) of factor x factor pixels; positions outside it are not."""
    u = F.floor((affine.apply_x(um_to_px, F.col("x_um"), F.col("y_um")) + 0.5) / factor)
    v = F.floor((affine.apply_y(um_to_px, F.col("x_um"), F.col("y_um")) + 0.5) / factor)
    return points.withColumn("u", u).withColumn("v", v).join(mask.where("tissue").select("u", "v"), ["u", "v"], "left_semi").select(*points.columns)


def near_cells(points: DataFrame, cells: DataFrame) -> DataFrame:
    """Points with a cell nearer than 20 micrometres."""
    return spatial.near_any(points, cells.select(F.col("x_um").alias("cx"), F.col("y_um").alias("cy")), "id", NEAR_UM)


def sample_cells(cells: DataFrame, n: int = POINTS, seed: str = "cells") -> DataFrame:
    """(id, x_um, y_um) of n cells, without replacement, by a seeded hash."""
    return cells.select("cell_id", "x_um", "y_um", uniform(seed, F.col("cell_id")).alias("h")).orderBy("h", "cell_id").limit(n).select(F.col("cell_id").alias("id"), "x_um", "y_um")


def shifted(points: DataFrame, seed: str = "shift", by: float = SHIFT_UM) -> DataFrame:
    """Each point moved by a fixed length in a random direction."""
    a = 2 * math.pi * uniform(seed, F.col("id"))
    return points.withColumns({"x_um": F.col("x_um") + by * F.cos(a), "y_um": F.col("y_um") + by * F.sin(a)})


def compare(a: DataFrame, b: DataFrame, control: bool) -> DataFrame:
    """(control, n_a, n_b, u, d, rank_biserial, z, p) of values v of a against those of b."""
    both = a.select(F.lit("a").alias("g"), "v").unionByName(b.select(F.lit("b").alias("g"), "v")).withColumn("k", F.lit(control))
    return stats.rank_sum(both, ["k"]).join(stats.cohens_d(both, ["k"]).select("k", "d"), "k").withColumnRenamed("k", "control")


def run_suite(cells: DataFrame, randoms: dict[str, DataFrame], samplers: dict[str, Callable[[DataFrame], DataFrame]], seed: str = "suite") -> tuple[list, bool]:
    """Comparisons of cells and of the shifted control with every kind of random points, and whether the suite passes.

    samplers: by name, from points (id, x_um, y_um) to (id, v), as from an image and from the
    tiles made of it. The same points serve every sampler and comparison.
    """
    own = sample_cells(cells, seed=seed)
    groups = {False: own, True: shifted(own, seed)}
    out = None
    for source, stain in samplers.items():
        values = {control: stain(points) for control, points in groups.items()}
        for name, points in randoms.items():
            base = stain(points)
            for control, v in values.items():
                row = compare(v, base, control).withColumns({"mask": F.lit(name), "source": F.lit(source)})
                out = row if out is None else out.unionByName(row)
    rows = out.collect()  # two for each sampler and kind of random points
    return rows, stats.suite(cells.sparkSession.createDataFrame([(r["control"], r["z"], r["d"]) for r in rows], "control boolean, z double, d double")).first()["passed"]


def check_section(cells: DataFrame, cores: DataFrame, section, image_tiles: DataFrame, built: DataFrame, radius_um: float = 2.0, seed: str = "suite") -> tuple[list, bool]:
    """run_suite() of a section: random points in tissue, and near cells, sampled from its image and from the pyramids of its cores.

    section: a row of sections; built: tiles as slides.build() gives them. Points lie in the
    boxes of cores, as only there tiles are.
    """
    spark = cells.sparkSession
    um_to_px = F.array(*[F.lit(float(v)) for v in section["affine"]])
    levels = slides.levels_of(image_tiles).orderBy(F.col("level").desc()).first()
    px = math.floor(section["he_pixel_size_um"] * 100) / 100
    radius = max(1, round(radius_um / section["he_pixel_size_um"]))
    boxes = cores.select(F.col("core_id").alias("box"), F.col("bbox_x0").alias("x0"), F.col("bbox_y0").alias("y0"), F.col("bbox_x1").alias("x1"), F.col("bbox_y1").alias("y1"))
    shapes = raster.pyramids(cores, section["he_pixel_size_um"]).select("core_id", "x0", "y0", (F.col("levels") - 1).alias("z"))
    full = built.join(shapes.select("core_id", "z"), ["core_id", "z"])

    def in_core(points: DataFrame) -> DataFrame:
        return points.join(spatial.first_box(points, boxes, "id", "box"), "id")

    def from_image(points: DataFrame) -> DataFrame:
        u, w = slides.position(um_to_px, F.col("x_um"), F.col("y_um"))
        return slides.disk_stain(points.select("id", u.alias("u"), w.alias("w")), image_tiles.where("level = 0"), radius)

    def from_tiles(points: DataFrame) -> DataFrame:
        p = in_core(points).withColumnRenamed("box", "core_id").join(F.broadcast(shapes), "core_id")  # cores of a section
        at = lambda c, o: F.rint((F.col(c) - F.col(o)) / px - 0.5).cast("long")
        return slides.disk_stain(p.select("id", "core_id", at("x_um", "x0").alias("u"), at("y_um", "y0").alias("w")), full, radius, by=("core_id",))

    mask = raster.tissue(slides.pixels(image_tiles.where(F.col("level") == levels["level"])), 1)
    bounds = cores.agg(F.min("bbox_x0"), F.min("bbox_y0"), F.max("bbox_x1"), F.max("bbox_y1")).first()
    inside = lambda points: in_core(points).where("box is not null").select("id", "x_um", "y_um")
    randoms = {
        "tissue": accepted(spark, POINTS, tuple(bounds), f"{seed}-tissue", lambda p: in_mask(inside(p), mask, um_to_px, levels["fx"])),
        "near cells": accepted(spark, POINTS, tuple(bounds), f"{seed}-near", lambda p: near_cells(inside(p), cells)),
    }
    within = cells.join(cores.select("core_id"), "core_id", "left_semi")
    return run_suite(within, randoms, {"image": from_image, "pyramid": from_tiles}, seed)
