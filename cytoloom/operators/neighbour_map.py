"""A map of points in a plane that keeps their neighbours: a fuzzy neighbour graph, laid out by attraction along its edges and repulsion from random points.

The graph has an edge for each pair of which one is among the other's k nearest, with a
weight that falls with the distance, measured from the nearest neighbour and in a unit of
each point's own.

The layout runs in rounds. Points lie in blocks by hash, an edge in the block of one of its
ends that counts it among its own, so a block has some thousand points and k edges each,
however many edges end at one point. In a round each block moves its points and copies of
the others that its edges reach through some epochs of sampled steps, by itself; then every
point takes the mean of the moves that its blocks made, weighted by their edges. What a
round passes on is a row for each point and block that moved it.

Moves are summed in whole numbers and random numbers depend on round and block alone, so the
map is the same for every partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import drop, staged

#: Points of a block, of the pool that repels them all, and random points for each step along an edge.
BLOCK, POOL, REPELLED_BY = 4096, 4096, 5
#: Steps of a coordinate sum, and the longest move of a coordinate in one step.
STEP, LONGEST = 2.0**24, 4.0
#: Sides of an edge's steps that an epoch takes at once.
BATCHES = 8


def curve(min_dist: float = 0.5, spread: float = 1.0) -> tuple[float, float]:
    """(a, b) for which 1 / (1 + a * d ** (2 b)) is nearest to 1 below min_dist and falling exponentially beyond."""
    x = np.linspace(0, 3 * spread, 300)[1:]
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    p, damping = np.array([0.0, 1.0]), 1e-2  # log a, b
    off = lambda p: 1 / (1 + np.exp(p[0]) * x ** (2 * p[1])) - y
    for _ in range(200):
        f = 1 / (1 + np.exp(p[0]) * x ** (2 * p[1]))
        down = -f * (1 - f)
        jac = np.stack([down, down * 2 * np.log(x)], axis=1)
        step = np.linalg.solve(jac.T @ jac + damping * np.eye(2), jac.T @ (y - f))
        if (off(p + step) ** 2).sum() < (off(p) ** 2).sum():
            p, damping = p + step, damping / 3
        else:
            damping *= 3
    return float(np.exp(p[0])), float(p[1])


def memberships(d: np.ndarray, k: int) -> np.ndarray:
    """Weights of rows of distances (padded with inf): 1 up to the least positive one, then falling, in the unit that makes a row's weights add up to log2(k)."""
    positive = np.where(d > 0, d, np.inf).min(axis=1, keepdims=True, initial=np.inf)
    rho = np.where(np.isfinite(positive), positive, 0.0)
    over = np.maximum(d - rho, 0.0)
    finite = np.isfinite(d)
    lo, hi = np.zeros(len(d)), np.full(len(d), np.inf)
    unit = np.ones(len(d))
    for _ in range(64):
        total = np.where(finite, np.exp(-np.where(finite, over, 0.0) / unit[:, None]), 0.0).sum(axis=1)
        hi, lo = np.where(total > np.log2(k), unit, hi), np.where(total > np.log2(k), lo, unit)
        unit = np.where(np.isfinite(hi), (lo + hi) / 2, unit * 2)
    mean = np.where(finite, d, 0.0).sum(axis=1) / np.maximum(finite.sum(axis=1), 1)
    unit = np.maximum(unit, np.maximum(1e-3 * mean, 1e-300))  # copies of one point have no unit of their own
    unit = np.minimum(unit, 1e300)
    return np.where(finite, np.exp(-np.where(finite, over, 0.0) / unit[:, None]), 0.0)


def fuzzy_graph(neighbours: DataFrame, k: int) -> DataFrame:
    """(a, b, w): an edge of each pair once, from (a, b, d2, rk) of the k nearest; a is an end that has b among its nearest, so no point is the a of more than k edges.

    w is that both ends' weights add up to, as independent chances: u + v - u * v.
    """

    def weigh(batches):
        for batch in batches:
            ends, d2 = batch.column(1), batch.column(2)
            sizes = np.diff(ends.offsets.to_numpy())
            at = np.arange(max(1, sizes.max(initial=0))) < sizes[:, None]
            d = np.full(at.shape, np.inf)
            d[at] = np.sqrt(d2.flatten().to_numpy())
            w = memberships(d, k)[at]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), ends.flatten(), pa.array(w)], names=["a", "b", "w"])

    lists = neighbours.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("rk", "b", "d2"))).alias("n")).select("a", "n.b", "n.d2")  # k of each
    directed = lists.mapInArrow(weigh, "a long, b long, w double")
    pairs = directed.groupBy(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(F.min("a").alias("a"), F.sum("w").alias("s"), F.when(F.count("*") > 1, F.product("w")).otherwise(0.0).alias("p"))
    return pairs.select("a", F.when(F.col("a") == F.col("i"), F.col("j")).otherwise(F.col("i")).alias("b"), (F.col("s") - F.col("p")).alias("w"))


class Mover:
    """Moves the points of a block through some epochs."""

    def __init__(self, a: float, b: float, seed: int, epochs: int):
        self.a, self.b, self.seed, self.epochs = a, b, seed, epochs

    def pull(self, d: np.ndarray) -> np.ndarray:
        d2 = (d * d).sum(axis=1, keepdims=True)
        near = np.maximum(d2, 1e-12)
        return np.clip(np.where(d2 > 0, -2 * self.a * self.b * near ** (self.b - 1) / (1 + self.a * near**self.b), 0.0) * d, -LONGEST, LONGEST)

    def push(self, d: np.ndarray) -> np.ndarray:
        d2 = (d * d).sum(axis=1, keepdims=True)
        return np.clip(2 * self.b / ((1e-3 + d2) * (1 + self.a * d2**self.b)) * d, -LONGEST, LONGEST)

    def block(self, y: np.ndarray, own: np.ndarray, src: np.ndarray, dst: np.ndarray, chance: np.ndarray, pool: np.ndarray, share: float, number: int, first: int, epochs: int) -> np.ndarray:
        """y after epochs first, first + 1, ...; own: indexes of the block's points; share: of all points that these are."""
        rng = np.random.default_rng([self.seed, number, first])
        y = y.copy()
        head, tail, chance = np.concatenate([src, dst]), np.concatenate([dst, src]), np.concatenate([chance, chance])
        for epoch in range(first, first + epochs):
            rate = 1.0 - epoch / self.epochs
            active = rng.permutation(np.flatnonzero(rng.random(len(head)) < chance))
            for part in np.array_split(active, BATCHES):
                h, t = head[part], tail[part]
                move = rate * self.pull(y[h] - y[t])
                np.add.at(y, h, move)
                np.add.at(y, t, -move)
                h = np.repeat(h, REPELLED_BY)
                near = y[own[rng.integers(0, len(own), len(h))]]
                if len(pool):
                    far = pool[rng.integers(0, len(pool), len(h))]
                    near = np.where(rng.random((len(h), 1)) < share, near, far)
                np.add.at(y, h, rate * self.push(y[h] - near))
        return y


    def of_round(self, first: int, last: int, pool, n: int):
        """A function of a block's points (id, deg, x, y, own) and edges (a, b, w): (id, deg, dx, dy), moves in whole steps times deg."""

        def move(key, points: pa.Table, lines: pa.Table) -> pa.Table:
            points, lines = points.sort_by("id"), lines.sort_by([("a", "ascending"), ("b", "ascending")])
            ids, deg = points["id"].to_numpy(), points["deg"].to_numpy()
            y = np.stack([points["x"].to_numpy(), points["y"].to_numpy()], axis=1)
            own = np.flatnonzero(points["own"].to_numpy())
            moved = y
            if lines.num_rows:
                src, dst = (np.searchsorted(ids, lines[c].to_numpy()) for c in ("a", "b"))
                moved = self.block(y, own, src, dst, lines["w"].to_numpy(), pool.value, len(own) / n, key[0].as_py(), first, last - first)
            d = np.rint((moved - y) * deg[:, None] * STEP).astype(np.int64)
            return pa.table({"id": ids, "deg": deg, "dx": d[:, 0], "dy": d[:, 1]})

        return move


def layout(graph: DataFrame, start: DataFrame, min_dist: float = 0.5, seed: int = 0, epochs: int = 200, rounds: int = 20, block: int = BLOCK) -> DataFrame:
    """(id, x, y) of the points of start (id, x, y), laid out by the edges of graph (a, b, w).

    The start is scaled to a width of 20. Points of one block alone need no rounds. A point
    without edges stays where the start has it. What start and graph are read from should be
    staged or stored.
    """
    spark = start.sparkSession
    facts = start.agg(F.count("*").alias("n"), F.max(F.greatest(F.abs("x"), F.abs("y"))).alias("most")).first()
    heaviest = graph.agg(F.max("w")).first()[0]
    if not facts["n"]:
        return start.select("id", "x", "y")
    scale = 10.0 / facts["most"] if facts["most"] else 1.0
    at = staged(start.select(F.col("id").cast("long").alias("id"), (F.col("x") * scale).alias("x"), (F.col("y") * scale).alias("y")), "map-start")
    if not heaviest:
        return at
    blocks = -(-facts["n"] // block)
    rounds = 1 if blocks == 1 else min(rounds, epochs)
    number = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    edges = staged(graph.select(number("a").alias("e_blk"), "a", "b", (F.col("w") / heaviest).alias("w")), "map-edges")
    ends = edges.select(F.col("e_blk").alias("blk"), F.explode(F.array("a", "b")).alias("id")).unionByName(at.select(number("id").alias("blk"), "id"))
    ends = staged(ends.groupBy("blk", "id").agg((F.count("*") - F.when(F.col("blk") == number("id"), 1).otherwise(0)).alias("deg")), "map-ends")
    mover, n = Mover(*curve(min_dist), seed, epochs), facts["n"]
    schema = "id long, deg long, dx long, dy long"
    bounds = [epochs * r // rounds for r in range(rounds + 1)]

    for first, last in zip(bounds, bounds[1:]):
        picked = at.orderBy(F.xxhash64(F.lit(seed), F.lit(first), "id"), "id").limit(POOL).toArrow() if blocks > 1 else None  # POOL rows
        pool = spark.sparkContext.broadcast(np.stack([picked["x"].to_numpy(), picked["y"].to_numpy()], axis=1) if picked else np.zeros((0, 2)))

        there = ends.join(at, "id").select("blk", "id", "deg", "x", "y", (F.col("blk") == number("id")).alias("own"))
        moves = there.groupBy("blk").cogroup(edges.groupBy("e_blk")).applyInArrow(mover.of_round(first, last, pool, n), schema)
        sums = moves.groupBy("id").agg(F.sum("deg").alias("deg"), F.sum("dx").alias("dx"), F.sum("dy").alias("dy"))
        by = F.greatest(F.col("deg"), F.lit(1)) * STEP
        new = staged(at.join(sums, "id").select("id", (F.col("x") + F.col("dx") / by).alias("x"), (F.col("y") + F.col("dy") / by).alias("y")), "map-round")
        drop(at)
        pool.unpersist()
        at = new
    drop(edges, ends)
    return at


def kept(of: DataFrame, by: DataFrame) -> float:
    """The mean share of each row's neighbours (a, b) in one table that the other has too."""
    both = of.select("a", "b").join(by.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left")
    return both.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
