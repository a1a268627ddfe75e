import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoloom.functions import codec
from cytoloom.operators import align, derive, embedding, expression, integrity, knn, ordering, slides, spatial, stats, validation
from cytoloom.sources import files, warehouse


@pytest.fixture(scope="module")
def ds(spark, sf):
    return warehouse.load(spark, sf)


def rules(ds, **kw):
    return {r["rule"]: r["ok"] for r in validation.report(ds, **kw).collect()}


def test_the_canonical_dataset_is_valid_but_for_its_layout(ds):
    broken = [r for r, ok in rules(ds).items() if not ok]
    assert not [r for r in broken if "core" not in r], broken
    assert len(rules(ds)) == 24


@pytest.mark.parametrize("column,value,rule", [("patient_id", "P99", "cells.patient_id = cores.patient_id"), ("cluster_id", "none", "cells.cluster_id ∈ clusters"), ("core_id", "C999", "cells.core_id ∈ cores"), ("section_id", "S9", "cells.section_id ∈ sections"), ("x_um", -5000.0, "cells inside section bounds"), ("n_transcripts", -1, "schema cells"), ("has_umap", False, "has_umap ⇔ finite UMAP coordinates"), ("y_um", float("nan"), "schema cells")])
def test_each_corruption_breaks_its_rule(ds, column, value, rule):
    kind = ds.cells.schema[column].dataType
    assert rules(ds)[rule] or rule == "x"
    assert not rules(ds.having(cells=ds.cells.withColumn(column, F.lit(value).cast(kind))))[rule]


def test_invalid_raises_without_values_of_cells(ds):
    with pytest.raises(validation.ContractError, match="cells.cluster_id"):
        validation.require_valid(ds.having(cells=ds.cells.withColumn("cluster_id", F.lit("secret-label"))))


def test_blobs_round_trip(spark):
    rng = random.Random(4)
    n = 300
    rows = [(f"G{g}", i, rng.randint(1, 255)) for g, density in enumerate((0.01, 0.3, 0.9, 1.0)) for i in range(n) if rng.random() < density or (g == 0 and i == 0)]
    q = spark.createDataFrame([(str(i), g, v) for g, i, v in rows], "cell_id string, gene_id string, q int")
    cells = spark.createDataFrame([(str(i), i) for i in range(n)], "cell_id string, idx int")
    d = expression.deltas(q, cells)
    for r in expression.blobs(d, n).collect():
        want = sorted((i, v) for g, i, v in rows if g == r["gene_id"])
        at, values = expression.decode_blob(bytes(r["payload"]), n)
        assert list(zip(at, values)) == want
        assert len(r["payload"]) <= n + 5
    sizes = {r["gene_id"]: r["bytes"] for r in expression.blob_sizes(d, n).collect()}
    assert sizes == {r["gene_id"]: len(r["payload"]) for r in expression.blobs(d, n).collect()}


def test_segments_of_genes_give_the_same_bytes(spark):
    """A gene that every cell has is dealt to many segments; others miss some."""
    rng = random.Random(9)
    n = 500
    rows = [(f"G{g}", i, rng.randint(1, 255)) for g, own in enumerate((range(n), range(0, n, 7), [3, 250, 251, 499], [499], range(100, 140), [i for i in range(n) if i % 100 > 40])) for i in own]
    q = spark.createDataFrame([(str(i), g, v) for g, i, v in rows], "cell_id string, gene_id string, q int")
    cells = spark.createDataFrame([(str(i), i) for i in range(n)], "cell_id string, idx int")
    key = lambda df: sorted(map(tuple, df.collect()))
    one, many = expression.deltas(q, cells), expression.deltas(q, cells, segment=16)
    assert key(one) == key(many)
    blobs = {s: {r["gene_id"]: (r["nnz"], r["fmt"], bytes(r["payload"])) for r in expression.blobs(many, n, segment=s).collect()} for s in (16, 100, 500, 2**16)}
    assert {f for _, f, _ in blobs[16].values()} == {0, 1} and all(b == blobs[2**16] for b in blobs.values())
    for g, (_, _, payload) in blobs[16].items():
        assert list(zip(*expression.decode_blob(payload, n))) == sorted((i, v) for h, i, v in rows if h == g)


def test_zero_totals_and_reserved_zero(spark):
    e = spark.createDataFrame([("a", "g", 0), ("b", "g", 5), ("b", "h", 1)], "cell_id string, gene_id string, count int")
    got = {(r["cell_id"], r["gene_id"]): r["q"] for r in expression.quantised(expression.display_values(e)).collect()}
    assert got[("b", "g")] == 255 and got[("a", "g")] == 1 and got[("b", "h")] == 255


def test_layout_is_contiguous_and_complete(ds):
    p = ordering.placed(ds)
    n = ds.cells.count()
    assert p.agg(F.count("*"), F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()[:] == (n, 0, n - 1, n)
    assert all(r["contiguous"] for r in ordering.core_ranges(p).collect())


def test_distance_join_equals_brute_force(spark):
    rng = random.Random(2)
    pts = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(300)]
    cen = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(20)]
    got = {(r["id"], r["c"]) for r in spatial.within(spark.createDataFrame(pts, "id int, x_um double, y_um double"), spark.createDataFrame(cen, "c int, cx double, cy double"), 7.0).collect()}
    assert got == {(i, c) for i, x, y in pts for c, a, b in cen if math.hypot(x - a, y - b) <= 7}


def test_coverage_moves_bins_not_candidates(spark):
    """Of many candidates in one bin only the bin meets the disk; none is lost."""
    rows = [(i, i % 3, 0) for i in range(600)] + [(600, None, 0)]
    candidates = spark.createDataFrame(rows, "id long, bx long, by long")
    occupied = spark.createDataFrame([(0, 0), (1, 0), (3, 0), (9, 9)], "bx long, by long")
    got = spatial.coverage(candidates, occupied, 1)
    assert {(r["id"], r["covered"]) for r in got.collect()} == {(i, (2, 2, 2)[x] if x is not None else 0) for i, x, _ in rows}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    disk = next(part for part in plan.split("Join Cross")[1:])
    assert "Aggregate [bx" in disk


def test_lasso_limits():
    with pytest.raises(ValueError):
        spatial.in_polygon(F.lit(0), F.lit(0), [(0, 0), (1, 1)])


@pytest.mark.parametrize("blocks", [1, 3])
def test_neighbours_equal_brute_force(spark, blocks):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(60, 4)).round(1)
    v[50:] = v[0]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, vec array<double>")
    got = {}
    for r in knn.knn(df, 5, blocks=blocks).collect():
        got.setdefault(r["a"], []).append((r["rk"], r["b"]))
    for i in range(60):
        d = ((v - v[i]) ** 2).sum(axis=1)
        assert [b for _, b in sorted(got[i])] == [j for j in np.lexsort((np.arange(60), d)) if j != i][:5]


def test_coherence_of_blobs_and_of_duplicates(spark):
    rng = np.random.default_rng(1)
    far = [(i, [float(x) for x in rng.normal(size=2) + (100 if i % 2 else 0)], i % 2) for i in range(80)]
    df = spark.createDataFrame(far, "id long, vec array<double>, label int")
    assert knn.coherence(knn.knn(df), df).first()["score"] == 1.0
    same = spark.createDataFrame([(i, [0.0, 0.0], 1) for i in range(20)], "id long, vec array<double>, label int")
    assert knn.coherence(knn.knn(same), same).first()[:] == (1.0, 20)
    scores = spark.createDataFrame([(0.5, 0.5), (0.5, 0.6), (None, 0.1), (0.1, None)], "p double, r double")
    assert [r[0] for r in scores.select(knn.choice(F.col("p"), F.col("r"))).collect()] == ["provided", "recomputed", "recomputed", "provided"]


@pytest.mark.parametrize("kind", ["even", "crowded", "one place", "line", "few"])
def test_neighbours_in_the_plane_equal_those_in_blocks(spark, kind):
    rng = np.random.default_rng(4)
    at = {"even": rng.uniform(0, 9, (700, 2)), "crowded": np.concatenate([rng.normal(0, 0.01, (400, 2)), rng.uniform(-50, 50, (200, 2))]), "one place": np.concatenate([np.zeros((150, 2)), rng.integers(0, 4, (150, 2))]), "line": np.stack([np.arange(300) // 2, np.zeros(300)], axis=1), "few": rng.uniform(size=(4, 2))}[kind]
    rows = [(int(i), float(x), float(y)) for i, (x, y) in zip(rng.permutation(len(at)), at)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    got = sorted((r["a"], r["rk"], r["b"]) for r in knn.knn_plane(df, 5, cell=30).collect())
    want = sorted((r["a"], r["rk"], r["b"]) for r in knn.knn(df.select("id", F.array("x", "y").alias("vec")), 5).collect())
    assert got == want


def test_rank_sum_and_effect(spark):
    rng = random.Random(3)
    rows = [(1, "a", float(rng.randint(0, 9))) for _ in range(40)] + [(1, "b", float(rng.randint(-3, 7))) for _ in range(50)]
    r = stats.rank_sum(spark.createDataFrame(rows, "k int, g string, v double"), ["k"]).first()
    a, b = [v for _, g, v in rows if g == "a"], [v for _, g, v in rows if g == "b"]
    assert r["u"] == sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    d = stats.cohens_d(spark.createDataFrame(rows, "k int, g string, v double"), ["k"]).first()["d"]
    s = math.sqrt((39 * np.var(a, ddof=1) + 49 * np.var(b, ddof=1)) / 88)
    assert d == pytest.approx((np.mean(a) - np.mean(b)) / s)


def test_the_control_must_fail(spark):
    suite = lambda rows: stats.suite(spark.createDataFrame(rows, "control boolean, z double, d double")).first()["passed"]
    assert suite([(False, 9.0, 1.0), (True, 1.0, 0.2)])
    assert not suite([(False, 9.0, 1.0), (True, 9.0, 1.0)])
    assert not suite([(False, 9.0, 1.0)])


def slide_tiles(spark, levels):
    """A tile table of levels given as arrays (h, w, 3)."""
    import zlib

    rows = []
    for k, a in enumerate(levels):
        for y in range(0, a.shape[0], slides.TILE):
            for x in range(0, a.shape[1], slides.TILE):
                part = np.ascontiguousarray(a[y : y + slides.TILE, x : x + slides.TILE])
                rows.append(("im", k, x // slides.TILE, y // slides.TILE, part.shape[1], part.shape[0], bytearray(zlib.compress(part.tobytes()))))
    return spark.createDataFrame(rows, "image string, level int, tx int, ty int, w int, h int, payload binary")


def plain_resample(img, view, bw, bh):
    """Every output pixel by itself, from the whole image with white around."""
    h, w = img.shape[:2]
    c = view.cell

    def cell(u, v):
        total = np.zeros(3)
        for y in range(v * c, v * c + c):
            for x in range(u * c, u * c + c):
                total += img[y, x] if 0 <= x < w and 0 <= y < h else 255
        return np.rint(total / c**2)

    def weight(d):
        return 0.0 if abs(d) >= slides.TAPS else float(np.sinc(d) * np.sinc(d / slides.TAPS))

    out = np.zeros((bh, bw, 3))
    for j in range(bh):
        for i in range(bw):
            u, v = (math.floor(x * slides.PHASES + 0.5) / slides.PHASES for x in view.to_cells(float(i), float(j)))
            near = range(1 - slides.TAPS, slides.TAPS + 1)
            wu, wv = [weight(u - math.floor(u) - t) for t in near], [weight(v - math.floor(v) - t) for t in near]
            px = sum(wv[b] / sum(wv) * wu[a] / sum(wu) * cell(math.floor(u) + s, math.floor(v) + t) for b, t in enumerate(near) for a, s in enumerate(near))
            out[j, i] = np.clip(np.floor(px + 0.5), 0, 255)
    return out.astype(int)


@pytest.mark.parametrize("nine, px, level, cell", [((0.9, 0.1, 3.0, -0.1, 1.1, 2.0, 0, 0, 1), 1.0, 0, 1), ((1.0, 0, -4.0, 0, 1.0, 5.0, 0, 0, 1), 3.0, 1, 2)])
def test_tiles_equal_a_plain_resampling_and_blocks_agree(spark, monkeypatch, nine, px, level, cell):
    rng = np.random.default_rng(5)
    img = np.kron(rng.integers(0, 256, (15, 12, 3)), np.ones((4, 4, 1))).astype(np.uint8)
    half = slides.averaged(img[:, :48], 2)[:, :, :]
    half = np.ascontiguousarray(np.repeat(half[:, ::1], 1, axis=1))
    view = slides.View.of([(0, 1.0, 1.0), (1, 1.5, 2.0)], slides.Map.of(nine), 1.0, 2.0, 1.0, px)
    assert (view.level, view.cell) == (level, cell)
    source = img if level == 0 else half
    want = plain_resample(source, view, 9, 7)
    padded = np.full((source.shape[0] + 200, source.shape[1] + 200, 3), 255, np.uint8)
    padded[100:-100, 100:-100] = source

    def block(bx, by, bw, bh):
        a, b, c, d = (v * cell + 100 for v in view.window(bx, by, bw, bh))
        left, top, _, _ = view.window(bx, by, bw, bh)
        return slides.resampled(slides.averaged(padded[b:d, a:c], cell), left, top, view.to_cells, bx, by, bw, bh)

    whole = block(0, 0, 9, 7)
    assert np.abs(whole.astype(int) - want).max() <= 1
    assert all((block(bx, by, 3, 2) == whole[by : by + 2, bx : bx + 3]).all() for bx in (0, 3, 6) for by in (0, 2, 4))


def test_built_tiles_equal_one_block(spark, monkeypatch):
    rng = np.random.default_rng(6)
    img = np.kron(rng.integers(0, 256, (40, 35, 3)), np.ones((20, 20, 1))).astype(np.uint8)
    tiles = slide_tiles(spark, [img, slides.averaged(img, 2)])
    assert sorted(r[:] for r in slides.levels_of(tiles).collect()) == [("im", 0, 700, 800, 1.0, 1.0), ("im", 1, 350, 400, 2.0, 2.0)]
    cores = spark.createDataFrame([("C1", "S1", 60.0, 60.0, 240.0, 200.0), ("C2", "S2", 0.0, 0.0, 9.0, 9.0)], "core_id string, section_id string, bbox_x0 double, bbox_y0 double, bbox_x1 double, bbox_y1 double")
    affine_ = [1.9, 0.1, -3.0, -0.1, 2.0, 4.0, 0.0, 0.0, 1.0]
    sections = spark.createDataFrame([("S1", "im", affine_, 0.51), ("S2", None, None, None)], "section_id string, he_image string, affine array<double>, he_pixel_size_um double")
    got = slides.build(cores, sections, tiles).collect()
    assert {r["core_id"] for r in got} == {"C1"} and sum(r["z"] == -1 for r in got) == 1
    import zlib

    px, levels = 0.51, 2
    padded = np.full((img.shape[0] + 800, img.shape[1] + 800, 3), 255, np.uint8)
    padded[400:-400, 400:-400] = img
    view = slides.View.of([(0, 1.0, 1.0), (1, 2.0, 2.0)], slides.Map.of(affine_), 0.51, 10.0, 10.0, 0.51)
    w, h = math.ceil(280 / 0.51), math.ceil(240 / 0.51)
    a, b, c, d = (v + 400 for v in view.window(0, 0, w, h))
    whole = slides.resampled(padded[b:d, a:c], a - 400, b - 400, view.to_cells, 0, 0, w, h)
    made = np.zeros_like(whole)
    for r in (r for r in got if r["z"] == levels - 1):
        part = np.frombuffer(zlib.decompress(r["payload"]), np.uint8).reshape(r["h"], r["w"], 3)
        made[r["ty"] * 512 : r["ty"] * 512 + r["h"], r["tx"] * 512 : r["tx"] * 512 + r["w"]] = part
    assert px and (made == whole).all()


@pytest.mark.parametrize("named", [slides.NAMED, 1])
def test_samplers_move_needed_tiles_alone(spark, monkeypatch, named):
    monkeypatch.setattr(slides, "NAMED", named)
    tiles = spark.range(10_000).select((F.col("id") % 100).alias("tx"), F.floor(F.col("id") / 100).alias("ty"), F.lit(b"p").alias("payload"))
    places = spark.createDataFrame([(3, 4), (3, 4), (99, 0), (500, 1), (None, 1)], "tx long, ty long")
    got = slides.needed(tiles, places, ("tx", "ty"))
    assert sorted((r["tx"], r["ty"]) for r in got.collect()) == [(3, 4), (99, 0)]
    if named > 1:
        assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_oversize_is_refused():
    one = slides.Map.axes(1, 0, 1, 0)
    with pytest.raises(ValueError, match="too large"):
        slides.resampled(np.zeros((4, 40_000, 3), np.uint8), 0, 0, one, 0, 0, 8, 8)


def test_maps_compose_and_bound():
    rng = np.random.default_rng(2)
    m, n = (slides.Map(*rng.normal(size=6)) for _ in range(2))
    assert m.then(n)(2.0, 3.0) == pytest.approx(n(*m(2.0, 3.0)))
    corners = [m(x, y) for x in (1.0, 4.0) for y in (-2.0, 5.0)]
    assert m.box(1.0, -2.0, 4.0, 5.0) == pytest.approx((min(x for x, _ in corners), min(y for _, y in corners), max(x for x, _ in corners), max(y for _, y in corners)))


def test_patients_are_dealt_completely():
    p = derive.deal_patients(20, 7, 1)
    assert len(p) == 20 and len(set(p)) == 7
    with pytest.raises(ValueError):
        derive.deal_patients(3, 4, 1)


def test_derived_dataset_is_valid_and_reproducible(ds):
    plan = derive.Plan(seed=3, radius=250.0, sections=2, min_cores=4)
    rng = random.Random(9)
    spark = ds.cells.sparkSession
    cells = ds.cells.limit(3000).withColumn("x_um", F.pmod(F.xxhash64("cell_id"), F.lit(2000)).cast("double")).withColumn("y_um", F.pmod(F.xxhash64(F.lit(1), "cell_id"), F.lit(2000)).cast("double"))
    dense = spark.range(8000).select((F.col("id") % 2000).alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("cell_id"), F.pmod(F.xxhash64("id"), F.lit(2000)).cast("double").alias("x_um"), F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(2000)).cast("double").alias("y_um"))
    first = cells.limit(1).drop("cell_id", "x_um", "y_um").withColumn("n_transcripts", F.lit(0))
    tissue = dense.drop("k").crossJoin(first).select(*ds.cells.columns)
    made = derive.derive(ds.having(cells=tissue), plan)
    broken = [r for r, ok in rules(made).items() if not ok]
    assert not [r for r in broken if r not in ("clusters.n_cells = observed",)], broken
    assert integrity.table_hash(made.cells) == integrity.table_hash(derive.derive(ds.having(cells=tissue), plan).cells)
    assert made.cores.count() >= 4
    del rng


def test_canonical_json():
    assert integrity.canonical_json({"b": 1.0, "a": [0.10000000149011612, (1, 2)], "c": np.int64(3), "d": float("nan")}) == '{"a":[0.1000000015,[1,2]],"b":1.0,"c":3,"d":null}'


def test_manifest_depends_on_content_alone(spark):
    rows = [("expr/a", "expression", b"1"), ("cells/x", "cells", b"22"), ("he/t", "he", b"")]
    a = integrity.assets(spark.createDataFrame(rows, "rel string, family string, payload binary"))
    b = integrity.assets(spark.createDataFrame(rows[::-1], "rel string, family string, payload binary"))
    m = integrity.manifest(a, {"name": "x", "release": "old"}, {"cells": 1})
    assert m == integrity.manifest(b, {"name": "x", "release": "new"}, {"cells": 1})
    assert set(m["files"]) == {"cells/x"} and m["indexes"]["he"]["files"] == 1
    assert integrity.manifest(b.where("rel <> 'he/t'"), {"name": "x"}, {"cells": 1})["release"] != m["release"]


def test_saved_dataset_loads_again(ds, tmp_path):
    files.save(ds, str(tmp_path / "d"))
    back = files.load(ds.cells.sparkSession, str(tmp_path / "d"))
    assert integrity.table_hash(back.cells) == integrity.table_hash(ds.cells) and back.record.name == "warehouse"
    with pytest.raises(FileNotFoundError, match="build its source first"):
        files.load(ds.cells.sparkSession, str(tmp_path / "none"))


def test_ledger_and_config(tmp_path):
    ledger = files.Ledger()
    assert ledger.admit("cells", "a/cells.parquet") == ledger.admit("again", "a/cells.parquet") == "a/cells.parquet"
    assert ledger.used == {"a/cells.parquet": "cells"}
    for path in ("a/transcripts.parquet", "morphology_focus/x.tif", "a/b.zarr.zip"):
        with pytest.raises(PermissionError):
            ledger.admit("x", path)
    ledger.check()
    ledger.used["a/transcripts.csv.gz"] = "smuggled"
    with pytest.raises(PermissionError, match="smuggled|transcripts"):
        ledger.check()
    (tmp_path / "one.toml").write_text("name = 'one'")
    assert files.config(tmp_path, "one") == {"name": "one"}
    with pytest.raises(FileNotFoundError, match="one"):
        files.config(tmp_path, "two")
    with pytest.raises(KeyError, match="known: a"):
        files.Adapters(a=1)["b"]


def archive(tmp_path, force_zip64=False):
    import zipfile

    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.bin", random.Random(1).randbytes(150_000))
        with z.open("dir/small é.txt", "w", force_zip64=force_zip64) as f:
            f.write(b"hello" * 1000)
        z.writestr(zipfile.ZipInfo("stored"), b"as it is")
        z.comment = b"a comment"
    return path.read_bytes()


@pytest.mark.parametrize("force", [False, True])
def test_zip_members_by_ranges(tmp_path, force):
    from cytoloom.sources import remote

    data, asked = archive(tmp_path, force), []

    def fetch(a, b):
        asked.append((a, b))
        return data[a:b]

    source = remote.Blocks(fetch, len(data), block=2000)
    assert remote.extract(source, "dir/small é.txt", tmp_path / "s").read_text() == "hello" * 1000
    assert remote.extract(source, "stored", tmp_path / "t").read_bytes() == b"as it is"
    assert sum(b - a for a, b in asked) < 0.6 * len(data) and [p.name for p in tmp_path.iterdir() if p.name.startswith(".")] == []
    with pytest.raises(KeyError, match="big.bin"):
        remote.extract(source, "none", tmp_path / "u")
    with pytest.raises(ValueError, match="zip"):
        remote.directory(remote.Blocks(lambda a, b: b"x" * (b - a), 100))
    broken = bytearray(data)
    broken[60_000] ^= 255
    with pytest.raises((OSError, Exception)):
        remote.extract(remote.Blocks(lambda a, b: bytes(broken[a:b]), len(data)), "big.bin", tmp_path / "v")
    assert not (tmp_path / "v").exists()


def test_http_ranges_and_whole_downloads(tmp_path):
    import http.server
    import threading

    from cytoloom.sources import remote

    data = archive(tmp_path)

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            named = self.headers.get("Range") if "plain" not in self.path else None
            a, b = (int(x) for x in named.removeprefix("bytes=").split("-")) if named else (0, len(data) - 1)
            self.send_response(206 if named else 200)
            if named:
                self.send_header("Content-Range", f"bytes {a}-{b}/{len(data)}")
            self.send_header("Content-Length", str(b + 1 - a if "short" not in self.path else b + 9))
            self.end_headers()
            self.wfile.write(data[a : b + 1])

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}"
        assert remote.extract(remote.http(f"{url}/a"), "stored", tmp_path / "t").read_bytes() == b"as it is"
        assert remote.download(f"{url}/plain", tmp_path / "w").read_bytes() == data
        with pytest.raises(OSError, match="range"):
            remote.http(f"{url}/plain")
        with pytest.raises(Exception):
            remote.download(f"{url}/plain-short", tmp_path / "x")
        assert not (tmp_path / "x").exists()
    finally:
        server.shutdown()


def test_npz_and_compressed_rows(spark, tmp_path):
    np.savez(tmp_path / "m.npz", data=np.array([5, 6, 7]), indices=np.array([1, 0, 2]), indptr=np.array([0, 1, 1, 3]), shape=np.array([3, 3]))
    m = files.compressed_arrays(str(tmp_path / "m.npz"))
    df = spark.createDataFrame([(0, *([int(x) for x in m[k]] for k in ("indptr", "indices", "data"))), (3, [0, 1], [1], [9]), (4, [0], [], [])], "first long, indptr array<long>, indices array<long>, data array<long>")
    assert {r[:] for r in files.coo_from_compressed(df).collect()} == {(0, 1, 5), (2, 0, 6), (2, 2, 7), (3, 1, 9)}


def test_stream_counts(ds, spark, tmp_path):
    from cytoloom import streaming

    ds.cells.repartition(3).write.parquet(str(tmp_path / "in"))
    q = streaming.running_counts(streaming.cell_files(spark, str(tmp_path / "in"), 1)).writeStream.outputMode("complete").format("memory").queryName("seen").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("seen").agg(F.sum("n")).first()[0] == ds.cells.count()


def test_u16_bytes(spark):
    assert spark.range(1).select(F.lower(codec.u16_hex(F.lit(0x1234))), F.lower(codec.u32_hex(F.lit(0x01020304)))).first()[:] == ("3412", "04030201")


def test_alignment_passes_and_its_control_fails(spark):
    """Dark spots at the cells of a bright image: centers stand out, points 25 um away don't."""
    rng = np.random.default_rng(3)
    img = rng.integers(225, 250, (400, 400, 3)).astype(np.uint8)
    centers = [(40 + 60 * i, 40 + 60 * j) for i in range(6) for j in range(6)]
    for x, y in centers:
        img[y - 4 : y + 5, x - 4 : x + 5] = (70, 40, 140)
    tiles = slide_tiles(spark, [img])
    cells = spark.createDataFrame([(f"c{i}", float(x), float(y)) for i, (x, y) in enumerate(centers)], "cell_id string, x_um double, y_um double")
    at = lambda p: slides.disk_stain(p.select("id", F.rint("x_um").cast("long").alias("u"), F.rint("y_um").cast("long").alias("w")), tiles, 2)
    randoms = {"box": align.random_points(spark, 200, (20.0, 20.0, 380.0, 380.0), "r"), "near": align.accepted(spark, 100, (20.0, 20.0, 380.0, 380.0), "n", lambda p: align.near_cells(p, cells.withColumn("x_um", F.col("x_um") + 15)))}
    rows, passed = align.run_suite(cells, randoms, {"image": at}, "t")
    assert passed and len(rows) == 4 and all((r["d"] >= 0.8) != r["control"] for r in rows)
    assert all((r["p"] < 1e-6) != r["control"] for r in rows)
    with pytest.raises(ValueError, match="fewer than"):
        align.accepted(spark, 5, (0.0, 0.0, 1.0, 1.0), "z", lambda p: p.where("false"), most=16)


def test_upper_tail_equals_erfc(spark):
    zs = [-6.0, -1.5, 0.0, 0.3, 2.0, 5.0, 9.0, 27.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(stats.upper_tail(F.col("z"))).collect()]
    assert got == pytest.approx([0.5 * math.erfc(z / math.sqrt(2)) for z in zs], rel=1e-6)


@pytest.mark.parametrize("by", [["k"], []])
def test_ranks_hold_with_outliers_ties_and_nulls(spark, by):
    rng = random.Random(4)
    rows = [(rng.randint(0, 2), rng.choice([1.0, 2.5, 1e12, -3.0, float(rng.randint(0, 5000))])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = stats.average_ranks(df, by).collect()
    assert len(got) == 1500
    for r in got[:200]:
        own = [v for k, v in rows if not by or k == r["k"]]
        assert r["rk"] == sum(v < r["v"] for v in own) + (sum(v == r["v"] for v in own) + 1) / 2


def test_embeddings_are_kept_by_content(spark, tmp_path):
    rng = random.Random(2)
    e = spark.createDataFrame([(f"c{i}", f"g{j}", rng.randint(1, 9)) for i in range(30) for j in range(5) if rng.random() < 0.8], "cell_id string, gene_id string, count int")
    genes = spark.createDataFrame([(f"g{j}",) for j in range(5)], "gene_id string")
    make = lambda: embedding.components(e, genes)
    first, hit = embedding.cached(e, {"k": 2}, str(tmp_path), make)
    again, hit_again = embedding.cached(e, {"k": 2}, str(tmp_path), lambda: 1 / 0)
    assert (hit, hit_again) == (False, True) and first.count() == again.count() == e.select("cell_id").distinct().count()
    with pytest.raises(ZeroDivisionError):
        embedding.cached(e, {"k": 3}, str(tmp_path), lambda: 1 / 0)


def pages_of(spark, **texts):
    return spark.createDataFrame([(path.replace("_", "/"), i + 1, line) for path, text in texts.items() for i, line in enumerate(text.strip("\n").split("\n"))], "path string, n int, line string")


def test_document_checks(spark):
    from cytoloom.operators import documents as doc

    brief = pages_of(spark, brief="""
| ID | P | text |
|----|---|------|
| FR-T1 | M | one [A] |
| FR-T2 | S | two [B] |
| NFR-3 | C | three [A] |
| US-4 | M | four [C] |
| FR-T1 | C | again |""")
    prd = pages_of(spark, prd="""
# Doc
| `FR-T1` | M | x [A] |
| FR-T2 | C | y [B] |
| NFR-3 | W | z |
AC-FR-T1.1 Given a, when b, then c.
AC-FR-T2.1 given only
## Changelog
FR-T2 moved.
### More
NFR-3 too
# Next
US-4""")
    want, have = doc.requirements(brief), doc.requirements(prd)
    assert [tuple(r) for r in want.select("id", "priority", "tags").orderBy("id").collect()] == [("FR-T1", "M", ["A"]), ("FR-T2", "S", ["B"]), ("NFR-3", "C", ["A"]), ("US-4", "M", ["C"])]
    log = doc.within(prd, "changelog")
    assert [r["line"] for r in log.orderBy("n").collect()] == ["FR-T2 moved.", "### More", "NFR-3 too"]
    assert {tuple(r) for r in doc.uncovered(want, have, log).collect()} == {("NFR-3", "no source"), ("US-4", "absent")}
    assert {r[0] for r in doc.without_criteria(want, prd).collect()} == {"FR-T2", "US-4"}
    plan = pages_of(spark, plan="""
| T-A-1 | unit |
| FR-T1 | T-A-1 |
| FR-T2 | T-A-1, T-B-2 |
| NFR-3 | none |""")
    assert {tuple(r) for r in doc.untested(want, plan).collect()} == {("FR-T2", "unknown T-B-2"), ("NFR-3", "no test"), ("US-4", "no test")}
    some = pages_of(spark, a_x="on 2024-01-31 and 3 May 2025\nnothing 1.2", b="May 3, 2025 or 1.2.2025")
    assert sorted(r["date"] for r in doc.dates(some, "3 May 2025").collect()) == ["1.2.2025", "2024-01-31", "May 3, 2025"]
    assert {r[0] for r in doc.missing(spark.createDataFrame([("a/.*",), ("c",)], "pattern string"), some.select("path").distinct()).collect()} == {"c"}
    asked = pages_of(spark, q="""
| ID | Recipient | Blocks | Status | Default |
| Q1 | x | Phase 4 | open | d |
| Q2 | x | — | answered | d |
| Q3 | x | y | open |
Q1 first""")
    assert {tuple(r) for r in doc.open_questions(asked).collect()} == {("Q2", "no blocks"), ("Q3", "no default"), ("Q3", "on no agenda")}
    good = "## Context\na\n## Options\nb\n## Decision\nc\n## Consequences\n**Building block:** d\n"
    records = pages_of(spark, good=good, bad="## Context\n" + "w " * 800)
    assert {tuple(r) for r in doc.decision_records(records).collect()} == {("bad", "no Options"), ("bad", "no Decision"), ("bad", "no Consequences"), ("bad", "too long"), ("bad", "another last line")}
    order = pages_of(spark, p="# Phase 1\n## Phase 3\n# Phase 2\n# Phase 4")
    assert [r["phase"] for r in doc.phases(order).collect()] == [2]


def test_deltas_straight_from_values(spark):
    rng = random.Random(3)
    values = spark.createDataFrame([(f"c{c}", f"g{g}", rng.random() * (g > 0)) for c in range(120) for g in range(5) if rng.random() < 0.5], "cell_id string, gene_id string, v double").repartition(3)
    cells = spark.createDataFrame([(f"c{c}", (c * 7) % 120) for c in range(120)], "cell_id string, idx long")
    want = sorted(map(tuple, expression.deltas(expression.quantised(values), cells).collect()))
    assert want and all(sorted(map(tuple, expression.quantised_deltas(values, cells, segment=s).collect())) == want for s in (16, 2**16))


def test_spread_names_its_argument_a_few_times(spark):
    from cytoloom.functions import codec

    rows = spark.range(0, 65536, 251).select("id", codec.spread(F.col("id").cast("int")).alias("z"))
    assert all(r["z"] == sum((r["id"] >> i & 1) << 2 * i for i in range(16)) for r in rows.collect())
    assert str(codec.spread(F.col("named"))).count("named") <= 2
