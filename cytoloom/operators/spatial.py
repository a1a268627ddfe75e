"""Spatial joins and sampling: radius, nearest, coverage, windows, lassos.

Distance joins go through a grid of cells as wide as the distance: one side is repeated into
the nine cells around it, the join is on equal grid cells, and the exact distance follows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import drop, staged

#: Tables of accepted points after which those so far become one.
MERGED = 16


def grid(c: str | Column, width: float) -> Column:
    return F.floor((F.col(c) if isinstance(c, str) else c) / width).cast("long")


def within(points: DataFrame, centers: DataFrame, radius: float, px: str = "x_um", py: str = "y_um", cx: str = "cx", cy: str = "cy", strict: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of points and centers at most `radius` apart, with their distance d. strict: less than that. by: columns that must be equal, as sections."""
    steps = F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))
    spread = centers.withColumn("__i", steps).withColumn("__j", steps).withColumn("__gx", grid(cx, radius) + F.col("__i")).withColumn("__gy", grid(cy, radius) + F.col("__j")).drop("__i", "__j")
    pairs = points.withColumn("__gx", grid(px, radius)).withColumn("__gy", grid(py, radius)).join(spread, [*by, "__gx", "__gy"])
    pairs = pairs.withColumn("d", F.hypot(F.col(px) - F.col(cx), F.col(py) - F.col(cy))).drop("__gx", "__gy")
    return pairs.where(F.col("d") < radius if strict else F.col("d") <= radius)


def near_any(points: DataFrame, targets: DataFrame, key: str, radius: float, by: tuple[str, ...] = (), **cols) -> DataFrame:
    """Points with a target strictly nearer than radius."""
    hit = within(points.select(key, *by, cols.get("px", "x_um"), cols.get("py", "y_um")), targets, radius, strict=True, by=by, **cols).select(key).distinct()
    return points.join(hit, key, "left_semi")


def nearest(points: DataFrame, targets: DataFrame, key: str, target: str, radius: float, **cols) -> DataFrame:
    """(key, target, d): the nearest target within radius, of equal ones the least."""
    pairs = within(points, targets, radius, **cols)
    return pairs.groupBy(key).agg(F.min(F.struct("d", target)).alias("m")).select(key, f"m.{target}", "m.d")


def occupancy(points: DataFrame, width: float, px: str = "x_um", py: str = "y_um") -> DataFrame:
    """(bx, by, n): occupied bins, counted from the least coordinates."""
    origin = points.agg(F.min(px).alias("x0"), F.min(py).alias("y0"))
    return points.crossJoin(F.broadcast(origin)).groupBy(F.floor((F.col(px) - F.col("x0")) / width).alias("bx"), F.floor((F.col(py) - F.col("y0")) / width).alias("by")).agg(F.count("*").alias("n"))  # one row


def densest(points: DataFrame, width: float, px: str = "x_um", py: str = "y_um") -> DataFrame:
    """The bin with most points; the first by bx, then by, of equal ones."""
    bins = points.groupBy(F.floor(F.col(px) / width).alias("bx"), F.floor(F.col(py) / width).alias("by")).agg(F.count("*").alias("n"))
    return bins.orderBy(F.col("n").desc(), "bx", "by").limit(1)


def stencil(spark, radius: int) -> DataFrame:
    """(dx, dy) of whole offsets in a disk."""
    r = spark.range(-radius, radius + 1)
    return r.select(F.col("id").alias("dx")).crossJoin(r.select(F.col("id").alias("dy"))).where(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") <= radius * radius)


def coverage(candidates: DataFrame, occupied: DataFrame, radius_bins: int, key: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """(key, covered, share) of candidates at bins (bx, by): occupied bins of the disk around them over all of its bins. by: columns that must be equal."""
    disk = stencil(candidates.sparkSession, radius_bins)
    n = sum((2 * int((radius_bins**2 - x * x) ** 0.5) + 1) for x in range(-radius_bins, radius_bins + 1))
    at = [*by, "bx", "by"]
    bins = candidates.select(*at).distinct().withColumns({"cx": F.col("bx"), "cy": F.col("by")})  # candidates of one bin have the same answer
    around = bins.crossJoin(F.broadcast(disk)).select(*by, "cx", "cy", (F.col("bx") + F.col("dx")).alias("bx"), (F.col("by") + F.col("dy")).alias("by"))  # the disk is a constant
    hits = around.join(occupied.select(*at), at, "left_semi").groupBy(*by, F.col("cx").alias("bx"), F.col("cy").alias("by")).agg(F.count("*").alias("covered"))
    return candidates.select(key, *at).join(hits, at, "left").select(key, F.coalesce("covered", F.lit(0)).alias("covered"), (F.coalesce("covered", F.lit(0)) / n).alias("share"))


def spaced(points: DataFrame, apart: float, id_col: str = "id", px: str = "x_um", py: str = "y_um", by: tuple[str, ...] = ()) -> DataFrame:
    """Points that acceptance in order of their ids leaves: each that is nowhere nearer than `apart` to one accepted before. by: columns that tell planes apart.

    Rounds over the undecided points give just what the sequential order gives. A grid cell of
    0.7 * apart holds one accepted point at most, so a cell is one row, its least point. This
    is accepted if none of the 24 cells around has a lesser one, as then nothing undecided that
    could rule it out comes before it; then all points near the new ones go. Each round decides
    the least undecided point of every plane at least: a few dozen rounds for ids in random
    order, as of darts; ids that run along a line take rounds as long as the line. Of equal ids
    the lesser place comes first, of repeated points one stays. Points without id, place or
    plane are left out; no points give no rows.
    """
    if not apart > 0:
        raise ValueError("points must be some length apart")
    side, cell = 0.7 * apart, [*by, "__gx", "__gy"]
    known = F.lit(True)
    for c in (id_col, px, py, *by):
        known = known & F.col(c).isNotNull()
    finite = F.abs(F.col(px)).between(0, 1e300) & F.abs(F.col(py)).between(0, 1e300)
    rest = staged(points.select(id_col, px, py, *by, grid(px, side).alias("__gx"), grid(py, side).alias("__gy")).where(known & finite), "spaced-open")
    reach = lambda c, n: F.explode(F.sequence(F.col(c) - n, F.col(c) + n))
    taken: list[DataFrame] = []
    while not rest.isEmpty():
        least = rest.groupBy(*cell).agg(F.min(F.struct(id_col, px, py)).alias("p"))
        around = least.withColumn("__gx", reach("__gx", 2)).withColumn("__gy", reach("__gy", 2)).groupBy(*cell).agg(F.min("p").alias("first"))
        new = staged(least.join(around, cell).where(F.col("p") == F.col("first")).select("p.*", *cell), "spaced-new")
        taken.append(new)
        if len(taken) == MERGED:
            one = staged(reduce(DataFrame.unionByName, taken), "spaced-taken")
            shadow = new.select(F.col(px).alias("__x"), F.col(py).alias("__y"), *cell)
            taken, old = [one], taken
        else:
            shadow, old = new.select(F.col(px).alias("__x"), F.col(py).alias("__y"), *cell), []
        shadow = shadow.withColumn("__gx", reach("__gx", 2)).withColumn("__gy", reach("__gy", 2))
        dx, dy = F.col(px) - F.col("__x"), F.col(py) - F.col("__y")
        near = [rest[c] == shadow[c] for c in cell] + [dx * dx + dy * dy < apart * apart]
        left = staged(rest.join(shadow, reduce(Column.__and__, near), "left_anti"), "spaced-open")
        drop(rest, *old)
        rest = left
    drop(rest)
    return reduce(DataFrame.unionByName, taken, rest.select(id_col, px, py, *by, "__gx", "__gy").limit(0) if not taken else taken.pop(0)).select(id_col, px, py, *by)


def first_box(points: DataFrame, boxes: DataFrame, key: str, box: str, pad: float = 0.0, px: str = "x_um", py: str = "y_um", by: tuple[str, ...] = (), width: float = 1000.0) -> DataFrame:
    """(key, box): the first box (x0, y0, x1, y1, by name) that holds the point, widened by pad, or null.

    Boxes are repeated into the grid cells of `width` that they touch, so that the join is on
    equal cells; a width near that of the boxes gives fewest rows. by: columns that must be equal.
    """
    span = lambda a, b: F.explode(F.sequence(grid(F.col(a) - pad, width), grid(F.col(b) + pad, width)))
    spread = boxes.withColumn("__gx", span("x0", "x1")).withColumn("__gy", span("y0", "y1"))
    own = points.select(key, *by, px, py).withColumn("__gx", grid(px, width)).withColumn("__gy", grid(py, width))
    inside = F.col(px).between(F.col("x0") - pad, F.col("x1") + pad) & F.col(py).between(F.col("y0") - pad, F.col("y1") + pad)
    hits = own.join(spread, [*by, "__gx", "__gy"]).where(inside).groupBy(key).agg(F.min(box).alias(box))
    return points.select(key).join(hits, key, "left")


def in_polygon(x: Column, y: Column, vertices: list[tuple[float, float]]) -> Column:
    """Ray casting; at most 64 vertices."""
    if not 3 <= len(vertices) <= 64:
        raise ValueError("a lasso has 3 to 64 vertices")
    crossings = F.lit(0)
    for (x0, y0), (x1, y1) in zip(vertices, vertices[1:] + vertices[:1]):
        if y0 != y1:
            crosses = ((F.lit(y0) > y) != (F.lit(y1) > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
            crossings = crossings + F.when(crosses, 1).otherwise(0)
    return crossings % 2 == 1


def overlapping(cores: DataFrame) -> DataFrame:
    """(a, b) of round cores of one section whose disks overlap.

    The grid is as wide as the largest core, so two that overlap are in neighbouring cells.
    """
    round_ = cores.where("kind = 'core'").select("section_id", "core_id", "center_x_um", "center_y_um", "radius_um")
    width = round_.agg((2 * F.max("radius_um") + 1e-9).alias("__w"))
    placed = round_.crossJoin(F.broadcast(width)).withColumn("__gx", F.floor(F.col("center_x_um") / F.col("__w"))).withColumn("__gy", F.floor(F.col("center_y_um") / F.col("__w")))  # one row
    side = lambda n: placed.select("section_id", "__gx", "__gy", F.col("core_id").alias(n), *[F.col(c).alias(n + i) for c, i in (("center_x_um", "x"), ("center_y_um", "y"), ("radius_um", "r"))])
    steps = F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))
    around = side("b").withColumn("__i", steps).withColumn("__j", steps).withColumn("__gx", F.col("__gx") + F.col("__i")).withColumn("__gy", F.col("__gy") + F.col("__j"))
    apart = F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"))
    return side("a").join(around, ["section_id", "__gx", "__gy"]).where("a < b").where(apart < F.col("ar") + F.col("br")).select("a", "b")


def bounding(points: DataFrame, key: str, px: str = "x_um", py: str = "y_um") -> DataFrame:
    """Whole-number box of each key's points, its center, and half of its longer side."""
    g = points.groupBy(key).agg(F.floor(F.min(px)).alias("x0"), F.floor(F.min(py)).alias("y0"), F.ceil(F.max(px)).alias("x1"), F.ceil(F.max(py)).alias("y1"))
    return g.select(key, "x0", "y0", "x1", "y1", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"), (F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / 2).alias("radius"))


def layout(n: int, sections: int, pitch: float = 1500.0, margin: float = 1000.0, spark=None) -> DataFrame:
    """(c, section, gx, gy, x, y): n cores dealt to the sections in turn, on a grid as square as it can be."""
    per = -(-n // sections)
    cols = int(-(-(per**0.5) // 1)) if per else 1
    c = spark.range(n).withColumnRenamed("id", "c")
    slot = F.floor(F.col("c") / sections)
    c = c.withColumn("section", F.concat(F.lit("S"), (F.col("c") % sections + 1).cast("string"))).withColumn("gx", slot % cols).withColumn("gy", F.floor(slot / cols))
    return c.withColumn("x", margin + (F.col("gx") + 0.5) * pitch).withColumn("y", margin + (F.col("gy") + 0.5) * pitch)


def replicas(bases: DataFrame, target: int, least: int) -> DataFrame:
    """(base, rep): each base (base, n) once, then again in rounds until the cells reach target and the plan `least` rows.

    The plan's sums are a closed form over the bases' running totals: round r adds all n.
    """
    w = Window.orderBy("base").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = bases.withColumn("upto", F.sum("n").over(w)).withColumn("place", F.row_number().over(Window.orderBy("base")))
    total = b.crossJoin(F.broadcast(bases.agg(F.sum("n").alias("all_n"), F.count("*").alias("k"))))  # one row
    rounds = total.withColumn("most", F.greatest(F.ceil(F.lit(target) / F.greatest("all_n", F.lit(1))), F.ceil(F.lit(least) / F.col("k"))).cast("int") + 1)
    each = rounds.withColumn("rep", F.explode(F.sequence(F.lit(0), F.col("most"))))
    before_cells = F.col("rep") * F.col("all_n") + F.col("upto") - F.col("n")
    before_rows = F.col("rep") * F.col("k") + F.col("place") - 1
    return each.where((F.col("rep") == 0) | (before_cells < target) | (before_rows < least)).select("base", "rep")
