"""Colours as columns: CIELAB, simulated colour vision, and the CIEDE2000 difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: linear sRGB to XYZ (D65), white point, and severe colour vision deficiencies in linear sRGB (Machado, Oliveira and Fernandes 2009)
TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
WHITE = (0.95047, 1.0, 1.08883)
VISION = {
    "normal": ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)),
    "protan": ((0.152286, 1.052583, -0.204868), (0.114503, 0.786281, 0.099216), (-0.003882, -0.048116, 1.051998)),
    "deutan": ((0.367322, 0.860646, -0.227968), (0.280085, 0.672501, 0.047413), (-0.011820, 0.042940, 0.968881)),
}
LEAST = 10.0


def channels(color: Column) -> list[Column]:
    """Linear red, green and blue in 0..1 of a colour #RRGGBB."""
    out = []
    for at in (2, 4, 6):
        c = F.conv(F.substring(color, at, 2), 16, 10).cast("double") / 255.0
        out.append(F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4))))
    return out


def _times(matrix, v: list[Column]) -> list[Column]:
    return [sum((m * c for m, c in zip(row[1:], v[1:])), row[0] * v[0]) for row in matrix]


def lab(color: Column, vision: str = "normal") -> Column:
    """(l, a, b) of a colour as a kind of colour vision sees it."""
    seen = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)) for c in _times(VISION[vision], channels(color))]
    f = []
    for x, w in zip(_times(TO_XYZ, seen), WHITE):
        t = x / w
        f.append(F.when(t > 216 / 24389, F.pow(t, F.lit(1 / 3))).otherwise((24389 / 27 * t + 16) / 116))
    return F.struct((116 * f[1] - 16).alias("l"), (500 * (f[0] - f[1])).alias("a"), (200 * (f[1] - f[2])).alias("b"))


def difference(p: Column, q: Column) -> Column:
    """CIEDE2000 of two colours in CIELAB."""
    chroma = lambda a, b: F.sqrt(a * a + b * b)
    turn = lambda b, a: F.when((a == 0) & (b == 0), 0.0).otherwise(F.pmod(F.degrees(F.atan2(b, a)) + 360, F.lit(360.0)))
    mean = (chroma(p["a"], p["b"]) + chroma(q["a"], q["b"])) / 2
    g = 1.5 - 0.5 * F.sqrt(F.pow(mean, F.lit(7)) / (F.pow(mean, F.lit(7)) + 25.0**7))
    a1, a2 = p["a"] * g, q["a"] * g
    c1, c2 = chroma(a1, p["b"]), chroma(a2, q["b"])
    h1, h2 = turn(p["b"], a1), turn(q["b"], a2)
    grey, gap, both = c1 * c2 == 0, h2 - h1, h1 + h2
    dh = F.when(grey, 0.0).when(gap > 180, gap - 360).when(gap < -180, gap + 360).otherwise(gap)
    h = F.when(grey, both).when(F.abs(gap) <= 180, both / 2).when(both < 360, both / 2 + 180).otherwise(both / 2 - 180)
    dl, dc = q["l"] - p["l"], c2 - c1
    dhue = 2 * F.sqrt(c1 * c2) * F.sin(F.radians(dh / 2))
    l, c = (p["l"] + q["l"]) / 2, (c1 + c2) / 2
    cos = lambda x: F.cos(F.radians(x))
    t = 1 - 0.17 * cos(h - 30) + 0.24 * cos(2 * h) + 0.32 * cos(3 * h + 6) - 0.20 * cos(4 * h - 63)
    sl = 1 + 0.015 * (l - 50) * (l - 50) / F.sqrt(20 + (l - 50) * (l - 50))
    sc, sh = 1 + 0.045 * c, 1 + 0.015 * c * t
    c7 = F.pow(c, F.lit(7))
    rt = -2 * F.sqrt(c7 / (c7 + 25.0**7)) * F.sin(F.radians(60 * F.exp(-((h - 275) / 25) * ((h - 275) / 25))))
    return F.sqrt((dl / sl) * (dl / sl) + (dc / sc) * (dc / sc) + (dhue / sh) * (dhue / sh) + rt * (dc / sc) * (dhue / sh))


def palette_distances(palette: DataFrame) -> DataFrame:
    """(vision, a, b, distance) of every pair of colours of a palette (id, color), some dozens of rows, under each kind of colour vision."""
    seen = None
    for name in VISION:
        rows = palette.select(F.lit(name).alias("vision"), "id", lab(F.col("color"), name).alias("lab"))
        seen = rows if seen is None else seen.unionByName(rows)
    a, b = seen.select("vision", F.col("id").alias("a"), F.col("lab").alias("p")), seen.select("vision", F.col("id").alias("b"), F.col("lab").alias("q"))
    return a.join(b, "vision").where("a < b").select("vision", "a", "b", difference(F.col("p"), F.col("q")).alias("distance"))


def too_close(palette: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs of a palette that some kind of colour vision tells apart too little."""
    return palette_distances(palette).where(F.col("distance") < least)

