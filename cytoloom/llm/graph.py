"""Connected components by alternating stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has one: then the parents are the components' least nodes."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    node = ends.groupBy("x").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
    return not node.where("c > 1 or (c > 0 and p > 0)").limit(1).count()


def _large(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the least of its neighbours and itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours and itself on the least of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node that isn't the least of its component, with that least node.

    edges: columns u and v of one orderable type; loops, repeats and either direction are
    allowed. Each round is written to the shared folder; the rounds grow with the logarithm
    of the largest component. Joins and minima alone, so a hub is split by partial
    aggregation and by adaptive skew joins.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = staged(edges.distinct(), "components")
    while not _stars(now):
        large = staged(_large(now), "components-large")
        before, now = now, staged(_small(large).distinct(), "components")
        discard(before, large)
    return now
