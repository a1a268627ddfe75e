"""Slides: images of sections as tables of tiles, resampled into the frame of the cells.

A tile table has (image, level, tx, ty, w, h, payload): zlib-packed rgb bytes of tiles of TILE
pixels, level 0 the finest. Output blocks find the source tiles that their box needs by
arithmetic, join them by place, and are resampled each in a task of its own. An output pixel's
position in the source depends on its place in the whole level alone, so neighbouring blocks
agree to the byte.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from . import raster
from .raster import BLOCK_TILES, THUMB, TILE

#: Positions between two source pixels, and source pixels that weigh in, to each side.
PHASES, TAPS = 64, 4
#: Output pixels may be this much smaller than a level's for it to serve; above this ratio source pixels are averaged first.
FINER, AVERAGED = 1.05, 1.25
#: Pixels of a window or block on a side, at most.
SIDE = raster.LIMIT


@dataclass(frozen=True)
class Map:
    """(x, y) to (xx x + xy y + x1, yx x + yy y + y1)."""

    xx: float
    xy: float
    x1: float
    yx: float
    yy: float
    y1: float

    @staticmethod
    def of(nine) -> Map:
        return Map(*[float(v) for v in nine[:6]])

    @staticmethod
    def axes(sx: float, ox: float, sy: float, oy: float) -> Map:
        return Map(sx, 0.0, ox, 0.0, sy, oy)

    def __call__(self, x, y):
        return self.xx * x + self.xy * y + self.x1, self.yx * x + self.yy * y + self.y1

    def then(self, outer: Map) -> Map:
        """outer after this one."""
        return Map(
            outer.xx * self.xx + outer.xy * self.yx, outer.xx * self.xy + outer.xy * self.yy, outer(self.x1, self.y1)[0],
            outer.yx * self.xx + outer.yy * self.yx, outer.yx * self.xy + outer.yy * self.yy, outer(self.x1, self.y1)[1],
        )

    def box(self, x0: float, y0: float, x1: float, y1: float) -> tuple[float, float, float, float]:
        """Bounds of the image of a rectangle, by intervals of its sides."""
        side = lambda k, a, b: (min(k * a, k * b), max(k * a, k * b))
        (a, b), (c, d) = side(self.xx, x0, x1), side(self.xy, y0, y1)
        (e, f), (g, h) = side(self.yx, x0, x1), side(self.yy, y0, y1)
        return a + c + self.x1, e + g + self.y1, b + d + self.x1, f + h + self.y1

    @property
    def scale(self) -> float:
        return math.sqrt(abs(self.xx * self.yy - self.xy * self.yx))


def levels_of(tiles: DataFrame) -> DataFrame:
    """(image, level, w, h, fx, fy): sizes of an image's levels and how many pixels of level 0 one of theirs is, by axis."""
    size = tiles.groupBy("image", "level").agg(F.max(F.col("tx") * TILE + F.col("w")).alias("w"), F.max(F.col("ty") * TILE + F.col("h")).alias("h"))
    whole = size.where("level = 0").select("image", F.col("w").alias("w0"), F.col("h").alias("h0"))
    return size.join(whole, "image").select("image", "level", "w", "h", (F.col("w0") / F.col("w")).alias("fx"), (F.col("h0") / F.col("h")).alias("fy"))


@dataclass(frozen=True)
class View:
    """How a level of output pixels of size px, from (x0, y0) micrometres on, sees an image: its level, and averaged cells of it."""

    level: int
    cell: int
    to_cells: Map

    @staticmethod
    def of(levels: list[tuple[int, float, float]], um_to_px: Map, source_px: float, x0: float, y0: float, px: float) -> View:
        """levels: (level, fx, fy). The coarsest level fine enough serves, else level 0. Whole numbers are centres of pixels."""
        fit = [lv for lv in levels if source_px * max(lv[1:]) <= FINER * px]
        level, fx, fy = max(fit or [min(levels)])
        to_level = Map.axes(px, x0 + px / 2, px, y0 + px / 2).then(um_to_px).then(Map.axes(1 / fx, (1 / fx - 1) / 2, 1 / fy, (1 / fy - 1) / 2))
        cell = max(1, round(to_level.scale)) if to_level.scale > AVERAGED else 1
        return View(level, cell, to_level.then(Map.axes(1 / cell, (1 / cell - 1) / 2, 1 / cell, (1 / cell - 1) / 2)))

    def window(self, bx: int, by: int, bw: int, bh: int) -> tuple[int, int, int, int]:
        """The cells that a block of output pixels needs: those around it and TAPS more to each side."""
        a, b, c, d = self.to_cells.box(bx, by, bx + bw - 1, by + bh - 1)
        return math.floor(a) - TAPS, math.floor(b) - TAPS, math.floor(c) + TAPS + 2, math.floor(d) + TAPS + 2


def _kernel() -> np.ndarray:
    """Lanczos weights of 2 TAPS pixels for each phase, each row with sum 1."""
    away = np.arange(PHASES)[:, None] / PHASES - np.arange(1 - TAPS, TAPS + 1)
    w = np.where(np.abs(away) < TAPS, np.sinc(away) * np.sinc(away / TAPS), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resampled(cells: np.ndarray, left: int, top: int, to_cells: Map, bx: int, by: int, bw: int, bh: int) -> np.ndarray:
    """A block of output pixels from a window of cells whose first is (left, top)."""
    if max(bw, bh, *cells.shape[:2]) >= SIDE:
        raise ValueError(f"an image of {bw} x {bh} from {cells.shape[1]} x {cells.shape[0]} is too large")
    weights, taps = _kernel(), np.arange(2 * TAPS) + 1 - TAPS
    step = lambda x: np.floor(x * PHASES + 0.5).astype(np.int64)
    x, y = np.arange(bx, bx + bw, dtype=np.float64), np.arange(by, by + bh, dtype=np.float64)
    height, width = cells.shape[:2]
    if to_cells.xy == to_cells.yx == 0:  # rows and columns by themselves
        u, v = step(to_cells(x, 0.0)[0]), step(to_cells(0.0, y)[1])
        across, down = weights[u % PHASES], weights[v % PHASES]
        lines = sum(across[None, :, s, None] * cells[:, np.clip(u // PHASES - left + t, 0, width - 1)] for s, t in enumerate(taps))
        out = sum(down[:, s, None, None] * lines[np.clip(v // PHASES - top + t, 0, height - 1)] for s, t in enumerate(taps))
        return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)
    u, v = map(step, to_cells(x[None, :], y[:, None]))
    columns, rows = u // PHASES - left, v // PHASES - top
    across, down = weights[u % PHASES], weights[v % PHASES]
    flat, out = cells.reshape(-1, 3).astype(np.float64), np.zeros((bh, bw, 3))
    for s, t in enumerate(taps):
        line = np.clip(rows + t, 0, height - 1) * width
        part = np.zeros((bh, bw, 3))
        for r, q in enumerate(taps):
            part += across[..., r, None] * flat[line + np.clip(columns + q, 0, width - 1)]
        out += down[..., s, None] * part
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def averaged(pixels: np.ndarray, cell: int) -> np.ndarray:
    """Means of cell x cell pixels, rounded to even."""
    if cell == 1:
        return pixels
    h, w = pixels.shape[0] // cell, pixels.shape[1] // cell
    total = np.add.reduceat(np.add.reduceat(pixels.astype(np.int64), np.arange(0, h * cell, cell), axis=0), np.arange(0, w * cell, cell), axis=1)
    return np.rint(total / cell**2).astype(np.uint8)


def output_levels(pyramids: DataFrame) -> DataFrame:
    """(core_id, z, px_um, w, h, x0, y0) of the levels of raster.pyramids(), and of a thumbnail of THUMB pixels at most, z = -1."""
    own = raster.level_table(pyramids).select("core_id", "z", "px_um", "w", "h").join(pyramids.select("core_id", "x0", "y0"), "core_id")
    px = F.greatest("width", "height") / THUMB
    side = lambda c: F.greatest(F.lit(1), F.rint(F.col(c) / px)).cast("long")
    return own.unionByName(pyramids.select("core_id", F.lit(-1).alias("z"), px.alias("px_um"), side("width").alias("w"), side("height").alias("h"), "x0", "y0"))


def build(cores: DataFrame, sections: DataFrame, tiles: DataFrame) -> DataFrame:
    """(core_id, z, tx, ty, w, h, payload): tiles of the pyramids of all cores whose section has an image; z = -1 is the thumbnail.

    cores (core_id, section_id, bbox_x0 ...); sections (section_id, he_image, affine,
    he_pixel_size_um); tiles: a tile table with image = he_image. All cores and levels are one
    plan: a block joins its source tiles, and white is where there are none.
    """
    views = sections.where("he_image is not null").select("section_id", F.col("he_image").alias("image"), "affine", F.col("he_pixel_size_um").alias("source_px"))
    boxes = cores.join(views, "section_id")
    px = F.floor(F.col("source_px") * 100) / 100
    shaped = raster.pyramids(cores.select("core_id", *[c for c in cores.columns if c.startswith("bbox_")]), boxes.select("core_id", px.alias("px")))
    levels = output_levels(shaped).join(boxes.select("core_id", "image", "affine", "source_px"), "core_id")
    listed = levels_of(tiles).groupBy("image").agg(F.sort_array(F.collect_list(F.struct("level", "fx", "fy"))).alias("levels"))  # a few to an image
    step = F.lit(TILE * BLOCK_TILES).cast("long")
    b = levels.join(listed, "image").withColumn("bx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("w") - 1, step))).withColumn("by", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") - 1, step)))
    b = b.withColumns({"bw": F.least(step, F.col("w") - F.col("bx")), "bh": F.least(step, F.col("h") - F.col("by"))})

    def plan(frames):
        for f in frames:
            out = []
            for r in f.itertuples():
                v = View.of([(int(x["level"]), float(x["fx"]), float(x["fy"])) for x in r.levels], Map.of(r.affine), r.source_px, r.x0, r.y0, r.px_um)
                left, top, right, bottom = v.window(r.bx, r.by, r.bw, r.bh)
                m = v.to_cells
                out.append((r.core_id, r.z, r.bx, r.by, r.bw, r.bh, r.image, v.level, v.cell, left, top, right, bottom, [m.xx, m.xy, m.x1, m.yx, m.yy, m.y1]))
            import pandas as pd

            yield pd.DataFrame(out, columns=["core_id", "z", "bx", "by", "bw", "bh", "image", "level", "cell", "left", "top", "right", "bottom", "map"])

    kind = "core_id string, z int, bx long, by long, bw long, bh long, image string, level int, cell int, `left` long, top long, `right` long, bottom long, map array<double>"
    blocks = b.select("core_id", "z", "bx", "by", "bw", "bh", "image", "affine", "source_px", "levels", "x0", "y0", "px_um").mapInPandas(plan, kind)
    # the box of a block names the tiles to read; a block with none still is one, of white
    span = lambda a, z: F.sequence(F.greatest(F.lit(0), F.floor(F.col(a) * F.col("cell") / TILE)), F.greatest(F.lit(0), F.floor((F.col(z) * F.col("cell") - 1) / TILE)))
    wanted = blocks.withColumn("tx", F.explode(span("left", "right"))).withColumn("ty", F.explode(span("top", "bottom")))
    source = tiles.select("image", "level", F.col("tx").cast("long"), F.col("ty").cast("long"), F.col("w").alias("tw"), F.col("h").alias("th"), "payload")
    joined = wanted.join(source, ["image", "level", "tx", "ty"], "left")

    def render(f):
        import pandas as pd

        r = f.iloc[0]
        cell, left, top = int(r["cell"]), int(r["left"]), int(r["top"])
        x0, y0 = left * cell, top * cell
        h, w = (int(r["bottom"]) - top) * cell, (int(r["right"]) - left) * cell
        if max(h, w) >= SIDE * 2:
            raise ValueError(f"a window of {w} x {h} is too large")
        window = np.full((h, w, 3), 255, np.uint8)
        for t in f[f["payload"].notna()].itertuples():
            tw, th = int(t.tw), int(t.th)
            pixels = np.frombuffer(zlib.decompress(t.payload), np.uint8).reshape(th, tw, 3)
            px, py = int(t.tx) * TILE - x0, int(t.ty) * TILE - y0
            ax, ay, zx, zy = max(px, 0), max(py, 0), min(px + tw, w), min(py + th, h)
            if ax < zx and ay < zy:
                window[ay:zy, ax:zx] = pixels[ay - py : zy - py, ax - px : zx - px]
        bx, by, bw, bh = (int(r[c]) for c in ("bx", "by", "bw", "bh"))
        image = resampled(averaged(window, cell), left, top, Map(*r["map"]), bx, by, bw, bh)
        out = []
        for y in range(0, bh, TILE):
            for x in range(0, bw, TILE):
                part = np.ascontiguousarray(image[y : y + TILE, x : x + TILE])
                out.append((r["core_id"], int(r["z"]), (bx + x) // TILE, (by + y) // TILE, part.shape[1], part.shape[0], zlib.compress(part.tobytes(), 6)))
        return pd.DataFrame(out, columns=["core_id", "z", "tx", "ty", "w", "h", "payload"])

    return joined.groupBy("core_id", "z", "bx", "by").applyInPandas(render, "core_id string, z int, tx int, ty int, w int, h int, payload binary")


def cut_tiles(pixels: DataFrame, image: str, level: int = 0) -> DataFrame:
    """A level of a tile table from a pixel table (x, y, r, g, b); pixels that are missing inside a tile are white."""

    def pack(f):
        import pandas as pd

        x, y = f["x"].to_numpy() % TILE, f["y"].to_numpy() % TILE
        a = np.full((int(y.max()) + 1, int(x.max()) + 1, 3), 255, np.uint8)
        a[y, x] = f[["r", "g", "b"]].to_numpy()
        return pd.DataFrame([(image, level, int(f["tx"].iloc[0]), int(f["ty"].iloc[0]), a.shape[1], a.shape[0], zlib.compress(a.tobytes(), 6))], columns=["image", "level", "tx", "ty", "w", "h", "payload"])

    placed = pixels.select("x", "y", "r", "g", "b", F.floor(F.col("x") / TILE).alias("tx"), F.floor(F.col("y") / TILE).alias("ty"))
    return placed.groupBy("tx", "ty").applyInPandas(pack, "image string, level int, tx int, ty int, w int, h int, payload binary")


def pixels(tiles: DataFrame) -> DataFrame:
    """The pixel table (x, y, r, g, b) of a level's tiles."""

    def unpack(frames):
        import pandas as pd

        for f in frames:
            for t in f.itertuples():
                a = np.frombuffer(zlib.decompress(t.payload), np.uint8).reshape(t.h, t.w, 3).astype(np.int32)
                y, x = np.mgrid[0 : t.h, 0 : t.w]
                yield pd.DataFrame({"x": (x + t.tx * TILE).ravel(), "y": (y + t.ty * TILE).ravel(), "r": a[..., 0].ravel(), "g": a[..., 1].ravel(), "b": a[..., 2].ravel()})

    return tiles.select("tx", "ty", "w", "h", "payload").mapInPandas(unpack, "x long, y long, r int, g int, b int")


#: Tiles that points need, up to which their names go to the tasks that read the image.
NAMED = 200_000


def needed(tiles: DataFrame, places: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Tiles that occur in `places`, by the columns `by`: their names are counted first and sent to the tile table's own tasks, so that no other tile is shuffled; beyond NAMED names both sides shuffle."""
    names = staged(places.select(*by).distinct(), "needed-tiles")
    few = names.limit(NAMED + 1).count() <= NAMED
    return tiles.join(F.broadcast(names) if few else names, list(by), "left_semi")


def disk_stain(points: DataFrame, tiles: DataFrame, radius: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(id, v): mean hematoxylin in the disk of pixels around points (id, u, w); tiles (tx, ty, w, h, payload) of one level. by: columns that tell images apart.

    Points join the tiles that their disk touches; a tile is unpacked once for its points.
    Pixels without a tile are white, whose hematoxylin is 0, so a mean is a sum over the disk's size.
    """
    k, floor = raster._stain_row(), math.log(1e-6)
    offsets = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if x * x + y * y <= radius * radius]
    reach = lambda c: F.sequence(F.floor((F.col(c) - radius) / TILE), F.floor((F.col(c) + radius) / TILE))
    near = points.select("id", *by, "u", "w", F.explode(reach("u")).alias("tx")).withColumn("ty", F.explode(reach("w")))
    source = needed(tiles.select(*by, F.col("tx").cast("long"), F.col("ty").cast("long"), F.col("w").alias("tw"), F.col("h").alias("th"), "payload"), near, (*by, "tx", "ty"))

    def look(p, t):
        import pandas as pd

        if not len(p):
            return pd.DataFrame({"id": np.zeros(0, object), "s": np.zeros(0)})
        if not len(t):
            return pd.DataFrame({"id": p["id"].to_numpy(dtype=object), "s": 0.0})
        r = t.iloc[0]
        a = np.frombuffer(zlib.decompress(r["payload"]), np.uint8).reshape(int(r["th"]), int(r["tw"]), 3)
        od = np.log(np.maximum(a / 255.0, 1e-6)) / floor
        h = np.maximum(od @ np.array(k), 0.0)
        x, y = p["u"].to_numpy() - int(r["tx"]) * TILE, p["w"].to_numpy() - int(r["ty"]) * TILE
        s = np.zeros(len(p))
        for dx, dy in offsets:
            inside = (x + dx >= 0) & (x + dx < h.shape[1]) & (y + dy >= 0) & (y + dy < h.shape[0])
            s[inside] += h[y[inside] + dy, x[inside] + dx]
        return pd.DataFrame({"id": p["id"].to_numpy(dtype=object), "s": s})

    id_type = points.schema["id"].dataType.simpleString()
    parts = near.groupBy(*by, "tx", "ty").cogroup(source.groupBy(*by, "tx", "ty")).applyInPandas(look, f"id {id_type}, s double")
    return parts.groupBy("id").agg((F.sum("s") / len(offsets)).alias("v"))


def pixel_at(tiles: DataFrame, points: DataFrame) -> DataFrame:
    """(id, r, g, b) of points (id, x, y) of a level's tiles; white outside: an equi join by tile, then the bytes of the pixel."""
    own = points.withColumns({"tx": F.floor(F.col("x") / TILE), "ty": F.floor(F.col("y") / TILE)})
    t = needed(tiles.select(F.col("tx").cast("long"), F.col("ty").cast("long"), "w", "h", "payload"), own, ("tx", "ty"))

    def look(p, s):
        import pandas as pd

        rgb = np.full((len(p), 3), 255)
        if len(s) and len(p):
            r = s.iloc[0]
            a = np.frombuffer(zlib.decompress(r["payload"]), np.uint8).reshape(int(r["h"]), int(r["w"]), 3)
            x, y = p["x"].to_numpy() % TILE, p["y"].to_numpy() % TILE
            ok = (x < a.shape[1]) & (y < a.shape[0])
            rgb[ok] = a[y[ok], x[ok]]
        return pd.DataFrame({"id": p["id"].to_numpy(dtype=object), "r": rgb[:, 0], "g": rgb[:, 1], "b": rgb[:, 2]})

    return own.groupBy("tx", "ty").cogroup(t.groupBy("tx", "ty")).applyInPandas(look, f"id {points.schema['id'].dataType.simpleString()}, r int, g int, b int")


def position(um_to_px: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """The pixel nearest to a place in micrometres."""
    from ..functions import affine

    return F.rint(affine.apply_x(um_to_px, x, y)).cast("long"), F.rint(affine.apply_y(um_to_px, x, y)).cast("long")
