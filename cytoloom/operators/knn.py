"""Exact nearest neighbours by pivots and rings or by cells of a plane, and label coherence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import drop, staged

#: Rows of a block: a task holds two blocks and their distances.
BLOCK = 2048


#: Pivots at most, the rows that they are picked from, and rings around a pivot at most.
PIVOTS, PICKED, RINGS = 256, 4096, 256
#: Products that a task holds at once, pairs of which it takes the distances at once, numbers of a block where all rows meet, and parts of the rows that ask there at least.
PRODUCT, CHOSEN, WHOLE, ASKING = 2**22, 2**16, 2**22, 16
#: Share of all comparisons from which on the bounds aren't worth their rows.
LOOSE = 0.125
_PAIRS = "a long, b long, d2 double"


def _vectors(lists) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.asarray(lists.flatten(), float).reshape(len(lists), -1)


def _targets(ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Indexes of rows without those that can't be a nearest one: of equal rows all but the k + 1 least ids."""
    h = (v * np.random.default_rng(0).standard_normal(v.shape[1])).sum(axis=1)
    order = np.lexsort((ids, h))
    new = np.ones(len(v), bool)
    new[1:] = (v[order[1:]] != v[order[:-1]]).any(axis=1)
    nth = np.arange(len(v)) - np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    return order[nth <= k]


def _within(a: np.ndarray, b: np.ndarray, k: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) among which are the k nearest of b of every row of a, ties included, as far as within its reach: by products of matrices, with room for their error."""
    middle = b.mean(axis=0)
    a, b = a - middle, b - middle
    a2, b2 = (a * a).sum(axis=1), (b * b).sum(axis=1)
    d = a @ b.T
    d *= -2
    d += a2[:, None]
    d += b2
    room = 16 * (a.shape[1] + 8) * np.finfo(float).eps * (a2 + b2.max())
    if k >= len(b):
        most = np.full(len(a), np.inf)
    elif np.isfinite(reach).all():
        row, col = np.nonzero(~(d > (reach + room)[:, None]))  # what isn't a number is left to the distances
        near = d[row, col]
        order = np.lexsort((near, row))
        first = np.searchsorted(row, np.arange(len(a) + 1))
        at = first[:-1] + k
        kth = np.where(at < first[1:], near[order][np.minimum(at, max(0, len(near) - 1))] if len(near) else np.inf, np.inf)
        keep = ~(near > (kth + 2 * room)[row])
        return row[keep], col[keep]
    else:
        most = np.partition(d, k, axis=1)[:, k] + 2 * room  # the k + 1 nearest, as the row itself may be one
    return np.nonzero(~(d > most[:, None]))


def _compare(k: int):
    """A function of a group of rows (id, v, side[, reach]): of each row of side 0 the k nearest of side 1, of equal distances the least id first.

    Products of matrices leave few pairs; the distances of these are sums of squared differences.
    """

    def best(group: pa.Table) -> pa.Table:
        side, ids = group["side"].to_numpy(), group["id"].to_numpy()
        reach = group["reach"].to_numpy() if "reach" in group.column_names else np.full(len(ids), np.inf)
        v = _vectors(group["v"])
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        b = b[_targets(ids[b], v[b], k)] if len(b) else b
        a_ids, b_ids, reach, va, vb = ids[a], ids[b], reach[a], v[a], v[b]
        del v
        out_a, out_b, out_d = [], [], []
        step = max(1, min(1024, PRODUCT // max(1, len(b))))
        for at in range(0, len(a) if len(b) else 0, step):
            with np.errstate(all="ignore"):
                row, col = _within(va[at : at + step], vb, k, reach[at : at + step])
                row += at
                other = a_ids[row] != b_ids[col]
                row, col = row[other], col[other]
                d = np.concatenate([((vb[col[i : i + CHOSEN]] - va[row[i : i + CHOSEN]]) ** 2).sum(axis=1) for i in range(0, max(1, len(row)), CHOSEN)])
            keep = np.isfinite(d)
            row, col, d = row[keep], col[keep], d[keep]
            order = np.lexsort((b_ids[col], d, row))
            row, col, d = row[order], col[order], d[order]
            top = np.arange(len(row)) - np.searchsorted(row, row) < k
            out_a.append(a_ids[row[top]])
            out_b.append(b_ids[col[top]])
            out_d.append(d[top])
        join = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t)
        return pa.table({"a": join(out_a, pa.int64()), "b": join(out_b, pa.int64()), "d2": join(out_d, pa.float64())})

    return best


def _top(pairs: DataFrame, k: int) -> DataFrame:
    top = pairs.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("d2", "b"))), 1, k).alias("n"))  # at most k for each block
    return top.select("a", F.posexplode("n").alias("rk", "x")).select("a", "x.b", "x.d2", (F.col("rk") + 1).alias("rk"))


def _pick(rows: DataFrame, most: int) -> np.ndarray:
    """Rows far from each other: from a bounded number with the least hashes, each the farthest from those before."""
    v = _vectors(rows.select(F.xxhash64("id").alias("h"), "id", "v").orderBy("h", "id").limit(PICKED).toArrow()["v"])
    chosen, far = [0], ((v - v[0]) ** 2).sum(axis=1)
    while len(chosen) < min(most, len(v)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((v - v[chosen[-1]]) ** 2).sum(axis=1))
    return v[chosen]


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((v - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(v) else np.zeros((0, len(pivots)))


def _all_pairs(rows: DataFrame, n: int, k: int) -> DataFrame:
    """Pairs among which are the k nearest of each of the n rows (id, v, reach), all within its reach: every block with every block, a task each.

    A block is of WHOLE numbers at most or so, whatever n; rows move once for each block of the other side.
    """
    width = rows.select(F.size("v")).first()[0]
    targets = -(-n * max(1, width) // WHOLE)
    asking = max(targets, ASKING)
    part = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    asked = rows.select("id", "v", "reach", part(asking).alias("i"), every(targets).alias("j"), F.lit(0).alias("side"))
    there = rows.select("id", "v", "reach", every(asking).alias("i"), part(targets).alias("j"), F.lit(1).alias("side"))
    return asked.unionByName(there).repartition(asking * targets, "i", "j").groupBy("i", "j").applyInArrow(_compare(k), _PAIRS)


def knn(points: DataFrame, k: int = 15, id_col: str = "id", vec_col: str = "vec", blocks: int | None = None, block: int = BLOCK, report: dict | None = None) -> DataFrame:
    """(a, b, d2, rk): the k nearest other rows of every row, of equal distances the least id first.

    Rows lie in blocks: those nearest to one of some pivots, at distances of one ring around
    it, and where a ring still has too many (copies of one row) dealt by hash. A row finds its
    nearest in its own block; the distance to the k-th of them, and the row's distances to
    the pivots, rule out whole rings by the triangle inequality, and only the others are
    compared. Where that rules out little, as in many dimensions, all larger blocks meet. Results are those of all pairs. Both sides of a comparison are of `block` rows
    or so, whatever is near to what. Pivots and rings, some 65,000 at most, are all that tasks
    are sent; blocks only get more by the hash.

    blocks: so many blocks of equal size, in place of `block` rows in each.
    report: gets blocks, comparisons of a row with a block (visits) and their number without bounds (of).
    """
    spark = points.sparkSession
    rows = points.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    n = rows.count()
    block = block if blocks is None else max(1, -(-n // blocks))
    if n <= block:
        if report is not None:
            report.update(blocks=1, visits=n, of=n)
        both = rows.withColumns({"i": F.lit(0), "side": F.explode(F.array(F.lit(0), F.lit(1)))})
        return _top(both.groupBy("i").applyInArrow(_compare(k), _PAIRS), k)
    sent = spark.sparkContext.broadcast(_pick(rows, max(1, -(-2 * n // block)) if 2 * n < block * PIVOTS else PIVOTS))

    def assign(batches):
        for b in batches:
            d = _distances(_vectors(b.column(1)), sent.value)
            at = d.argmin(axis=1) if len(d) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32()), pa.array(d[np.arange(len(d)), at], pa.float64())], names=["id", "v", "p", "d"])

    near = staged(rows.mapInArrow(assign, "id long, v array<double>, p int, d double"), "knn-pivots")
    each = near.groupBy("p").agg(F.count("*").alias("c"), F.percentile_approx("d", [i / RINGS for i in range(1, RINGS)], 4 * RINGS).alias("q")).collect()  # a row for each pivot
    cuts = {r["p"]: np.unique([r["q"][i * RINGS // m - 1] for i in range(1, m)]) for r in each for m in [min(RINGS, -(-r["c"] // block))]}
    known = spark.sparkContext.broadcast(cuts)

    def ring(batches):
        for b in batches:
            p, d = b.column(2).to_numpy(), b.column(3).to_numpy()
            at = np.array([np.searchsorted(known.value[x], y, side="right") for x, y in zip(p, d)], np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=["id", "v", "p", "d", "r"])

    ringed = near.mapInArrow(ring, "id long, v array<double>, p int, d double, r int")
    rings = ringed.groupBy("p", "r").agg(F.count("*").alias("c"), F.min("d").alias("lo"), F.max("d").alias("hi")).orderBy("p", "r").collect()  # PIVOTS * RINGS at most
    parts = np.array([-(-r["c"] // block) for r in rings])
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    number = {(r["p"], r["r"]): i for i, r in enumerate(rings)}
    table = spark.createDataFrame([(p, r, int(first[i]), int(parts[i])) for (p, r), i in number.items()], "p int, r int, first int, parts int")
    placed = ringed.join(F.broadcast(table), ["p", "r"]).select("id", "v", (F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int").alias("blk"))
    placed = staged(placed, "knn-blocks")
    drop(near)

    own = placed.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).groupBy("blk").applyInArrow(_compare(k), _PAIRS)
    own = staged(own, "knn-own")
    reach = own.groupBy(F.col("a").alias("id")).agg(F.max("d2").alias("d2"), F.count("*").alias("m"))
    queries = placed.join(reach, "id", "left").select("id", "v", "blk", F.when(F.col("m") >= k, F.sqrt("d2")).otherwise(float("inf")).alias("reach"))
    bounds = spark.sparkContext.broadcast((np.array([r["p"] for r in rings]), np.array([r["lo"] for r in rings]), np.array([r["hi"] for r in rings]), np.array([r["c"] for r in rings]), first, parts))

    def visit(batches):
        p, lo, hi, count, first, parts = bounds.value
        for b in batches:
            ids, blk, reach = (b.column(i).to_numpy() for i in (0, 2, 3))
            d = _distances(_vectors(b.column(1)), sent.value)
            out_id, out_blk = [], []
            for i in range(len(ids)):
                to = d[i][p]
                most = reach[i]
                if not np.isfinite(most):  # few rows in its own block: the rings that surely hold k others
                    order = np.argsort(to + hi, kind="stable")
                    enough = np.searchsorted(np.cumsum(count[order]), k + 1)
                    most = (to + hi)[order[min(enough, len(order) - 1)]] if enough < len(order) else np.inf
                seen = np.flatnonzero(np.maximum(to - hi, lo - to) <= most * (1 + 1e-9) + 1e-12 * (1 + to.max()))
                wanted = np.concatenate([np.arange(first[s], first[s] + parts[s]) for s in seen]) if len(seen) else np.zeros(0, int)
                wanted = wanted[wanted != blk[i]]
                out_id.append(np.full(len(wanted), ids[i]))
                out_blk.append(wanted)
            join = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t)
            yield pa.RecordBatch.from_arrays([join(out_id, pa.int64()), join(out_blk, pa.int32())], names=["id", "blk"])

    def count(batches):
        for b in visit(batches):
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["c"])

    queries = staged(queries, "knn-queries")
    seen = queries.mapInArrow(count, "c long").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    if seen > LOOSE * n * int(parts.sum()):
        if report is not None:
            report.update(blocks=int(parts.sum()), visits=n * int(parts.sum()), of=n * int(parts.sum()))
        reach = F.col("reach") * F.col("reach") * (1 + 1e-12)
        return _top(_all_pairs(queries.select("id", "v", reach.alias("reach")), n, k), k)
    visits = staged(queries.mapInArrow(visit, "id long, blk int"), "knn-visits")
    groups = visits.groupBy("blk").agg(F.ceil(F.count("*") / block).cast("int").alias("groups"))
    if report is not None:
        blocks = int(parts.sum())
        report.update(blocks=blocks, visits=n + visits.count(), of=n * blocks)
    asked = visits.join(groups, "blk").join(placed.select("id", "v"), "id").select("id", "v", "blk", F.pmod(F.xxhash64("id", "blk"), "groups").cast("int").alias("g"), F.lit(0).alias("side"))
    there = placed.join(groups, "blk").select("id", "v", "blk", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), F.lit(1).alias("side"))
    more = asked.unionByName(there).groupBy("blk", "g").applyInArrow(_compare(k), _PAIRS)
    return _top(own.unionByName(more), k)


def _nearest(ids: np.ndarray, x: np.ndarray, y: np.ndarray, t_ids: np.ndarray, tx: np.ndarray, ty: np.ndarray, k: int):
    """Of each query the k nearest other targets, of equal distances the least id: (row, target id, squared distance). Targets are ordered by id."""
    at, near, dist = [], [], []
    for i in range(0, len(ids), 512):
        d = (x[i : i + 512, None] - tx) ** 2 + (y[i : i + 512, None] - ty) ** 2
        d[ids[i : i + 512, None] == t_ids] = np.inf
        m = min(k, len(t_ids))
        order = np.argsort(d, axis=1, kind="stable")[:, :m]
        best = np.take_along_axis(d, order, axis=1)
        row, col = np.nonzero(np.isfinite(best))
        at.append(row + i)
        near.append(t_ids[order[row, col]])
        dist.append(best[row, col])
    join = lambda v, t: np.concatenate(v) if v else np.zeros(0, t)
    return join(at, np.int64), join(near, np.int64), join(dist, np.float64)


def knn_plane(points: DataFrame, k: int = 15, cell: int = 1024) -> DataFrame:
    """(a, b, d2, rk) as knn(), for points (id, x, y) of a plane, in near-linear work.

    The plane is cut into strips of x and these into cells of y, at approximate quantiles, so
    a cell holds about as many points wherever they crowd. A point finds its nearest in its
    own cell, then in those cells that its distance to the k-th reaches. Of points at one
    place only the k + 1 least ids can be anybody's nearest, so the others are no targets.
    Cells grow where there would be more than 40,000 of them, as their edges go to the driver.
    """
    spark = points.sparkSession
    rows = points.select(F.col("id").cast("long").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    n = rows.count()
    side = int(min(200, max(1, (n / cell) ** 0.5)))
    cuts = lambda c: F.percentile_approx(c, [i / side for i in range(1, side)], 20 * side) if side > 1 else F.array().cast("array<double>")
    xs = np.array(rows.agg(cuts("x").alias("c")).first()["c"] or [], float)
    strip = F.expr("0")
    if len(xs):
        strip = F.size(F.filter(F.array(*map(F.lit, xs.tolist())), lambda c: c <= F.col("x")))
    ys = {r["s"]: np.array(r["c"], float) for r in rows.withColumn("s", strip).groupBy("s").agg(cuts("y").alias("c")).collect()}
    shared = spark.sparkContext.broadcast((xs, [ys.get(s, np.zeros(0)) for s in range(len(xs) + 1)]))

    def place(batches):
        xs, ys = shared.value
        for b in batches:
            x, y = b.column(1).to_numpy(), b.column(2).to_numpy()
            s = np.searchsorted(xs, x, side="right")
            c = np.array([np.searchsorted(ys[i], v, side="right") for i, v in zip(s, y)], np.int64) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s * 1_000_000 + c)], names=["id", "x", "y", "cell"])

    placed = rows.mapInArrow(place, "id long, x double, y double, cell long")
    order = F.row_number().over(Window.partitionBy("x", "y").orderBy("id"))
    # at one place some few; under names of their own, as both sides of a cogroup come from one table
    targets = placed.withColumn("o", order).where(F.col("o") <= k + 1).select(F.col("cell").alias("t_cell"), F.col("id").alias("t_id"), F.col("x").alias("t_x"), F.col("y").alias("t_y"))

    def own(queries: pa.Table, there: pa.Table) -> pa.Table:
        if not queries.num_rows or not there.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "d2": pa.array([], pa.float64())})
        t = there.sort_by("t_id")
        q = [queries[c].to_numpy() for c in ("id", "x", "y")]
        at, near, dist = _nearest(*q, *[t[c].to_numpy() for c in ("t_id", "t_x", "t_y")], k)
        return pa.table({"a": pa.array(q[0][at], pa.int64()), "b": pa.array(near, pa.int64()), "d2": pa.array(dist, pa.float64())})

    schema = "a long, b long, d2 double"
    first = placed.groupBy("cell").cogroup(targets.groupBy("t_cell")).applyInArrow(own, schema)
    reach = first.groupBy(F.col("a").alias("id")).agg(F.max("d2").alias("r"), F.count("*").alias("m"))
    queries = placed.join(reach, "id", "left").select("id", "x", "y", "cell", F.when(F.col("m") >= k, F.col("r")).otherwise(float("inf")).alias("r"))

    def others(batches):
        xs, ys = shared.value
        for b in batches:
            out = []
            for i, x, y, c, r in zip(*[b.column(j).to_numpy() for j in range(5)]):
                d = r**0.5 * (1 + 1e-12)
                for s in range(np.searchsorted(xs, x - d, side="left"), np.searchsorted(xs, x + d, side="right") + 1):
                    left, right = (xs[s - 1] if s else -np.inf), (xs[s] if s < len(xs) else np.inf)
                    dx = max(left - x, x - right, 0.0)
                    dy = max(r - dx * dx, 0.0) ** 0.5 * (1 + 1e-12)
                    for v in range(np.searchsorted(ys[s], y - dy, side="left"), np.searchsorted(ys[s], y + dy, side="right") + 1):
                        if s * 1_000_000 + v != c:
                            out.append((i, x, y, s * 1_000_000 + v))
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int64(), pa.float64(), pa.float64(), pa.int64()))], names=["id", "x", "y", "cell"])

    more = queries.mapInArrow(others, "id long, x double, y double, cell long").groupBy("cell").cogroup(targets.groupBy("t_cell")).applyInArrow(own, schema)
    top = first.unionByName(more).groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("d2", "b"))), 1, k).alias("n"))
    return top.select("a", F.posexplode("n").alias("rk", "x")).select("a", "x.b", "x.d2", (F.col("rk") + 1).alias("rk"))


def coherence(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(score, n): mean over rows of the share of their neighbours with their label. labels: (id, label)."""
    a, b = labels.select(F.col("id").alias("a"), F.col("label").alias("la")), labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    per = neighbours.join(a, "a").join(b, "b").groupBy("a").agg(F.avg(F.when(F.col("la") == F.col("lb"), 1.0).otherwise(0.0)).alias("s"))
    return per.agg(F.avg("s").alias("score"), F.count("*").alias("n"))


def choice(provided: Column, recomputed: Column) -> Column:
    """The name of the embedding with the higher score; the provided one on ties, and where the other has none."""
    better = recomputed.isNotNull() & (provided.isNull() | (recomputed > provided))
    return F.when(better, "recomputed").otherwise("provided")
