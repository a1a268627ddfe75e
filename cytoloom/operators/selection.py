"""Exact order statistics of groups of any size, by histograms that close in on them.

A round cuts what is left of each group at some of its own quantiles, which may be
approximate, counts the cells exactly, and keeps the cell in which the wanted place lies.
The first round takes values as they come and shuffles its counts alone; what it leaves
folds, so that each later round tells values apart. All groups go through a round at once; cuts and counts are some
hundred numbers for each, and a value's cell comes from a search in the cuts, so no task
holds a group. What is left shrinks some sixty times a round, whatever the values are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import drop, staged

#: Cells of a round.
CELLS = 64


def _cell(rows: DataFrame) -> DataFrame:
    """Adds the cell of v, how many of the ordered cuts are below it: a search by halves, a column for each step, as Spark compiles these."""
    rows = rows.withColumn("cell", F.lit(0))
    for step in (2**i for i in reversed(range(CELLS.bit_length()))):
        rows = rows.withColumn("cell", F.col("cell") + F.when(F.get("cuts", F.col("cell") + (step - 1)) < F.col("v"), step).otherwise(0))
    return rows


def order_statistics(samples: DataFrame, by: list[str], value: str, places) -> DataFrame:
    """(*by, n, place, x): x is the value at a place of its group's order, from 0; n counts the group's values.

    places: from the column n to an array of places. Nulls are no values; NaN is above all
    others. A group without values gives no row.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    kind = samples.schema[value].dataType
    v = F.col(value) + F.lit(0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(value)  # -0.0 is 0.0
    named = samples.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], v.alias("v"), F.lit(1).cast("long").alias("c")).where("v is not null")
    rows = staged(named, "selection-values")
    sizes = rows.groupBy(*keys).agg(F.sum("c").alias("n"))
    if not keys:
        sizes = sizes.where("n is not null")
    want = staged(sizes.select(*keys, "n", F.explode(places(F.col("n")).cast("array<bigint>")).alias("place")).distinct(), "selection-places")
    same = lambda other: [F.col(k).eqNullSafe(F.col(f"__o{k}")) for k in other] or [F.lit(True)]
    other = lambda df, ks: df.select(*[F.col(k).alias(f"__o{k}") if k in ks else F.col(k) for k in df.columns])
    join = lambda a, b, ks: a.join(other(b, ks), [c for c in same(ks)] if ks else None, "inner" if ks else "cross").drop(*[f"__o{k}" for k in ks])  # noqa: E731  without keys one row for each place
    found = []
    ids, by_cell = [*keys, "place"], keys  # the first round's cells serve all places of a group
    rest = want.withColumn("rest", F.col("place"))
    while rows.limit(1).count():
        cuts = staged(rows.groupBy(*by_cell).agg(F.array_distinct(F.percentile_approx("v", [i / CELLS for i in range(1, CELLS)], 10 * CELLS)).alias("cuts")), "selection-cuts")
        celled = _cell(join(rows, cuts, by_cell)).drop("cuts")
        counts = celled.groupBy(*by_cell, "cell").agg(F.sum("c").alias("c"), F.min("v").alias("v"), F.max("v").alias("most"))
        before = F.coalesce(F.sum("c").over(Window.partitionBy(*by_cell).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # CELLS rows at most
        hit = join(counts.withColumn("before", before), rest, by_cell).where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("c")))
        hit = staged(hit.select(*ids, "cell", (F.col("rest") - F.col("before")).alias("next"), "v", "most"), "selection-cells")
        found.append(hit.where("v = most").select(*ids, F.col("v").alias("x")))
        open_ = hit.where("v <> most")
        left = join(celled, open_.select(*ids, "cell"), [*by_cell, "cell"])
        new = staged(left.groupBy(*ids, "v").agg(F.sum("c").alias("c")), "selection-left")
        drop(rows, cuts)
        rows, by_cell, rest = new, ids, open_.select(*ids, F.col("next").alias("rest"))
    if not found:
        return want.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "n", "place", F.lit(None).cast(samples.schema[value].dataType).alias("x"))
    all_ = found[0]
    for f in found[1:]:
        all_ = all_.unionByName(f)
    return join(all_, want.select(*ids, "n"), ids).select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "n", "place", "x")


def median(samples: DataFrame, by: list[str], value: str, into: str = "median") -> DataFrame:
    """(*by, into): the middle value of each group, or the mean of the two in the middle."""
    n = lambda c: F.array(F.floor((c - 1) / 2), F.floor(c / 2))
    x = order_statistics(samples, by, value, n)
    return x.groupBy(*by).agg((F.min("x").cast("double") * 0.5 + F.max("x").cast("double") * 0.5).alias(into))
