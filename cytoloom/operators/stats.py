"""Ranks, effect sizes and the alignment rule."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: z of a one-sided p of 1e-6, and the least effect size that passes.
Z_MIN, D_MIN = 4.753424, 0.8
#: Ranges of values, and the steps that find one among them.
RANGES, STEPS = 256, 9


def cohens_d(samples: DataFrame, by: list[str], group: str = "g", value: str = "v") -> DataFrame:
    """d of group a over group b, pooled standard deviation; 0 if that is 0. group holds 'a' and 'b'."""
    side = lambda f, g: f(F.when(F.col(group) == g, F.col(value)))
    s = samples.groupBy(*by).agg(*[side(f, g).alias(f"{n}_{g}") for g in "ab" for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))])
    pooled = F.sqrt(((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / (F.col("n_a") + F.col("n_b") - 2))
    return s.withColumn("d", F.when(pooled > 0, (F.col("mean_a") - F.col("mean_b")) / pooled).otherwise(0.0))


def ranged(counts: DataFrame, value: str) -> DataFrame:
    """Adds rng, the place of a value among approximate quantiles of all rows; any cuts give a right order."""
    if isinstance(counts.schema[value].dataType, T.StringType):
        return counts.withColumn("rng", F.ascii(value))  # the first character
    cuts = F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 10 * RANGES)
    edges = counts.agg(F.array_distinct(cuts).alias("__cuts"))  # one row of at most RANGES numbers
    middle = "cast((s.a + s.b) div 2 as int)"
    place = F.expr(f"aggregate(sequence(1, {STEPS}), named_struct('a', 0, 'b', size(__cuts)), (s, i) -> CASE WHEN s.a >= s.b THEN s WHEN __cuts[{middle}] <= `{value}` THEN named_struct('a', {middle} + 1, 'b', s.b) ELSE named_struct('a', s.a, 'b', {middle}) END, s -> s.a)")
    return counts.crossJoin(F.broadcast(edges)).withColumn("rng", place).drop("__cuts")


def below(counts: DataFrame, by: list[str], value: str = "v", count: str = "c") -> DataFrame:
    """Adds below, the number of rows of the group with a smaller value, to one row for each group and value.

    Only the values of one range of a group are ordered in a task.
    """
    rows = ranged(counts, value)
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(*by, "rng").agg(F.sum(count).alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(upto.partitionBy(*by, F.lit(0)).orderBy("rng")), F.lit(0))).drop("__n")
    own = F.coalesce(F.sum(count).over(upto.partitionBy(*by, "rng").orderBy(value)), F.lit(0))
    return rows.withColumn("__own", own).join(ranges, [*by, "rng"]).withColumn("below", F.col("__own") + F.col("__start")).drop("__own", "__start", "rng")


def average_ranks(samples: DataFrame, by: list[str], value: str = "v") -> DataFrame:
    """Adds rk: rank within by, ties sharing their mean. Equal values fold first, and ranks come from counts of values below."""
    counts = samples.groupBy(*by, value).agg(F.count("*").alias("__c"))
    keys = [*by, value]
    ranks = below(counts, by, value, "__c").select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(keys)], (F.col("below") + (F.col("__c") + 1) / 2.0).alias("rk"))
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"__{i}"))
    return samples.join(ranks, same, "left").drop(*[f"__{i}" for i in range(len(keys))])


def rank_sum(samples: DataFrame, by: list[str], group: str = "g", value: str = "v") -> DataFrame:
    """(n_a, n_b, u, rank_biserial, z, p): group a against b, z with tie and continuity correction, p one-sided.

    Ranks come from counts of values below. Equal values fold first; distinct values fall
    into ranges that approximate quantiles of all groups cut, so that outliers don't crowd
    the others together. The ranges' counts give each one's start, and only values of one
    range are ordered in a task. Any cuts give the same ranks.
    """
    counts = samples.groupBy(*by, value).agg(*[F.sum(F.when(F.col(group) == g, 1).otherwise(0)).alias(f"c_{g}") for g in "ab"]).withColumn("c", F.col("c_a") + F.col("c_b"))
    rows = below(counts, by, value)
    s = rows.groupBy(*by).agg(
        F.sum("c_a").alias("n_a"), F.sum("c_b").alias("n_b"),
        F.sum(F.col("c_a") * (F.col("below") + (F.col("c") + 1) / 2.0)).alias("r"),
        F.sum(F.col("c").cast("double") * F.col("c") * F.col("c") - F.col("c")).alias("ties"),
    )
    u = F.col("r") - F.col("n_a") * (F.col("n_a") + 1) / 2.0
    nn, n = F.col("n_a") * F.col("n_b"), F.col("n_a") + F.col("n_b")
    sd = F.sqrt(nn / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    s = s.withColumn("u", u).withColumn("rank_biserial", F.when(nn > 0, 2 * F.col("u") / nn - 1))
    s = s.withColumn("z", F.when(sd > 0, (F.col("u") - nn / 2.0 - 0.5) / sd).otherwise(0.0)).drop("r", "ties")
    return s.withColumn("p", upper_tail(F.col("z")))


def upper_tail(z: Column) -> Column:
    """The chance of a standard normal number above z, to a relative error of some 1e-7: 1.2e-7 by the rational polynomial of Numerical Recipes' erfcc, also far out in the tail."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    # fixed values: coefficients of the approximation, from the constant term on
    terms = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    poly = F.lit(0.0)
    for c in reversed(terms):
        poly = poly * t + c
    half = t * F.exp(-x * x + poly) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def suite(comparisons: DataFrame) -> DataFrame:
    """One row, passed: every real comparison passes the rule and no control does; there are some of both. Columns: control, z, d."""
    ok = (F.col("z") > Z_MIN) & (F.col("d") >= D_MIN)
    return comparisons.agg(
        F.coalesce(F.bool_or(~F.col("control")) & F.bool_or("control") & F.bool_and(F.col("control") | ok) & ~F.bool_or(F.col("control") & ok), F.lit(False)).alias("passed"),
        F.count_if(ok).alias("n_passed"),
    )
