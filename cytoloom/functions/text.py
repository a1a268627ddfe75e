"""String functions: slugs, numbered symbols, identifiers, colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slug(c: Column) -> Column:
    """Lower case; runs of anything but letters and digits become one dash; none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "-"), F.lit("-"))


def number_repeats(df: DataFrame, col: str, *order: str, into: str = "symbol") -> DataFrame:
    """Adds col with -2, -3, ... after the second and later occurrences, case ignored, in the given order.

    A made-up name is not checked against existing ones. Keys spread by name: a name that a
    third of the rows share is one window.
    """
    n = F.row_number().over(Window.partitionBy(F.lower(col)).orderBy(*order))
    return df.withColumn(into, F.when(n > 1, F.concat(col, F.lit("-"), n.cast("string"))).otherwise(F.col(col)))


def padded(prefix: str, c: Column, width: Column | int) -> Column:
    """prefix and a number with at least so many digits; longer numbers stay whole."""
    s = c.cast("string")
    return F.concat(F.lit(prefix), F.lpad(s, F.greatest(F.length(s), F.lit(width) if isinstance(width, int) else width), F.lit("0")))


def replica(c: Column, n: Column) -> Column:
    """c with -r<n>, or c alone for 0."""
    return F.when(n > 0, F.concat(c, F.lit("-r"), n.cast("string"))).otherwise(c)


def shade(color: Column, factor: float = 0.55) -> Column:
    """#RRGGBB darkened: each channel times factor, cut to a whole number, in upper-case hex."""
    channel = lambda i: F.lpad(F.hex(F.floor(F.conv(F.substring(color, i, 2), 16, 10).cast("int") * factor).cast("long")), 2, "0")
    return F.concat(F.lit("#"), channel(2), channel(4), channel(6))


def forbidden(path: Column) -> Column:
    """True if a component of the path names a raw file that must not be read."""
    # fixed values: patterns of forbidden raw files
    return F.exists(F.split(path, "/"), lambda p: p.like("transcripts.%") | p.like("morphology%") | p.like("%.zarr.zip"))
