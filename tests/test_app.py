import json
import logging
import os

import pytest
from pyspark.sql import functions as F

from cytoloom import publish, workspace
from cytoloom.__main__ import main
from cytoloom.config import Config
from cytoloom.operators import expression, integrity, ordering, validation
from cytoloom.sources import adapters, files, warehouse


def test_config_is_strict(tmp_path):
    (tmp_path / "a.toml").write_text('name = "a"\nadapter = "saved"\n[expected]\nn_cells = 3\n')
    assert Config.read(tmp_path, "a").expected.n_cells == 3
    with pytest.raises(ValueError, match="typo"):
        Config.of({"name": "a", "adapter": "b", "typo": 1})
    with pytest.raises(ValueError, match="private"):
        adapters.record_of(Config("a", "saved", visibility="secret"))


def test_the_data_volume(monkeypatch, tmp_path, capsys):
    monkeypatch.delenv("DATA_ROOT", raising=False)
    assert main(["run", "x"]) == 3 and "DATA_ROOT" in capsys.readouterr().err
    with pytest.raises(workspace.WorkspaceError, match="mounted"):
        workspace.Workspace.open({"DATA_ROOT": str(tmp_path / "none")})
    here = {"DATA_ROOT": os.path.dirname(workspace.CODE)}
    with pytest.raises(workspace.WorkspaceError, match="volume"):
        workspace.Workspace.open(here)
    volume = workspace.Workspace.open(here | {"CYTOLOOM_ALLOW_SAME_VOLUME": "1"})
    assert volume.folder("raw", "x").parts[-2:] == ("raw", "x")
    with pytest.raises(ValueError, match="kind"):
        volume.folder("other", "x")
    assert main(["nonsense"]) == 2


def test_private_logs_drop_cell_records_and_count_each_once(tmp_path, capsys):
    for private, n in ((True, 1), (False, 0)):
        journal = workspace.journal(tmp_path / "logs/l.log", private=private)
        logging.getLogger("cytoloom.x").info("cell 17", extra={"cell_level": True})
        logging.getLogger("cytoloom.x").info("total 3")
        logging.getLogger("cytoloom.x").debug("detail")
        said, written = capsys.readouterr().out, (tmp_path / "logs/l.log").read_text()
        assert said == written and said.count("total 3") == 1 and "detail" not in said
        assert ("cell 17" in said) is not private and journal.withheld == n
    workspace.journal()


@pytest.fixture(scope="module")
def valid(spark, sf, tmp_path_factory):
    """A saved dataset that keeps its contract: cores without cells go."""
    ds = warehouse.load(spark, sf)
    used = ds.cells.select("core_id").distinct()
    path = str(tmp_path_factory.mktemp("ds"))
    files.save(ds.having(cores=ds.cores.join(used, "core_id", "left_semi").select(*ds.cores.columns)), path)
    return Config("saved-one", "saved", path=path)


def test_a_run_publishes_what_it_built(spark, valid, tmp_path):
    s = publish.run(spark, valid, str(tmp_path / "o"))
    release = json.loads((tmp_path / "o/current.json").read_text())["release"]
    assert release == s["release"] and not (tmp_path / "o/_staging").exists()
    manifest = json.loads((tmp_path / f"o/{release}/manifest.json").read_text())
    assert manifest["release"] == release and integrity.manifest(integrity.assets(spark.read.parquet(str(tmp_path / f"o/{release}/assets.parquet"))), manifest["dataset"], manifest["counts"])["release"] == release
    assert "release" in publish.render(s) and all(e <= 0.5 for e in s["errors_um"].values())
    assets = spark.read.parquet(str(tmp_path / f"o/{release}/assets.parquet"))
    ds = files.load(spark, valid.path)
    n = ds.cells.count()
    blob = assets.where("family = 'expression'").orderBy("rel").first()
    gene = blob["rel"][5:-4]
    at, values = expression.decode_blob(bytes(blob["payload"]), n)
    want = expression.quantised(expression.display_values(ds.expression)).where(F.col("gene_id") == gene).join(ordering.placed(ds).select("cell_id", "idx"), "cell_id").orderBy("idx").select("idx", "q").collect()
    assert [(r["idx"], r["q"]) for r in want] == list(zip(at, values))
    out = {r["rel"]: r["bytes"] for r in publish.export(assets.where("family = 'cells'"), str(tmp_path / "files")).collect()}
    assert sum(v for k, v in out.items() if k.startswith("cells/xy.u16/")) == 4 * n
    assert all((tmp_path / "files" / k).stat().st_size == v for k, v in out.items())


def test_gene_maxima_decode_with_the_configured_scale(spark, valid, tmp_path):
    s = publish.run(spark, Config("saved-one", "saved", path=valid.path, scale_factor=500.0), str(tmp_path / "o"))
    assets = spark.read.parquet(f"{tmp_path}/o/{s['release']}/assets.parquet")
    genes = {g["id"]: g["max_v"] for g in json.loads(bytes(assets.where("rel = 'genes.json'").first()["payload"]))}
    want = {r["gene_id"]: r["m"] for r in expression.display_values(files.load(spark, valid.path).expression, 500.0).groupBy("gene_id").agg(F.max("v").alias("m")).collect()}
    assert all(genes[g] == pytest.approx(v) for g, v in want.items()) and len(want) > 50


def test_index_files_name_every_expression_file(spark, valid, tmp_path):
    s = publish.run(spark, valid, str(tmp_path / "o"))
    assets = spark.read.parquet(f"{tmp_path}/o/{s['release']}/assets.parquet")
    lines = [x.split(" ") for r in assets.where("family = 'index'").collect() for x in bytes(r["payload"]).decode().splitlines()]
    own = {r["rel"]: (str(r["bytes"]), r["sha256"]) for r in integrity.assets(assets.where("family = 'expression'")).collect()}
    assert {a: (b, c) for a, b, c in lines} == own


def stained(spark, path, ds, shift=0.0):
    """ds with a dark spot at every cell of a bright image, and its tile table; shift: micrometres by which the image is off."""
    import zlib

    import numpy as np

    from cytoloom.functions import affine
    from cytoloom.operators import slides

    rng = np.random.default_rng(1)
    img = rng.integers(200, 215, (1000, 1000, 3)).astype(np.uint8)
    for r in ds.cells.collect():
        x, y = int(r["x_um"] * 2), int(r["y_um"] * 2)
        img[max(0, y - 7) : y + 8, max(0, x - 7) : x + 8] = (70, 40, 140)
    rows = []
    for k, a in enumerate((img, slides.averaged(img, 2))):
        for y in range(0, a.shape[0], slides.TILE):
            for x in range(0, a.shape[1], slides.TILE):
                part = np.ascontiguousarray(a[y : y + slides.TILE, x : x + slides.TILE])
                rows.append(("im", k, x // slides.TILE, y // slides.TILE, part.shape[1], part.shape[0], bytearray(zlib.compress(part.tobytes()))))
    spark.createDataFrame(rows, "image string, level int, tx int, ty int, w int, h int, payload binary").write.mode("overwrite").parquet(path)
    source = F.array(*[F.lit(v) for v in (0.5, 0.0, -shift, 0.0, 0.5, 0.0, 0.0, 0.0, 1.0)])
    values = {"he_image": F.lit("im"), "affine": affine.um_to_pixel(source, F.lit(1.0)), "affine_source": source, "he_pixel_size_um": affine.pixel_um(source, F.lit(1.0))}
    return ds.having(sections=ds.sections.withColumns(values))


def small_dataset(spark, valid):
    """One section of 200 cells, of a core each patient has, on 500 x 500 micrometres."""
    import random

    from cytoloom.model import CELLS, CLUSTERS, CORES, conform

    ds, rng = files.load(spark, valid.path), random.Random(5)
    spots = [(20.0 + 30 * (i % 16) + rng.uniform(-3, 3), 20.0 + 30 * (i // 16) + rng.uniform(-3, 3)) for i in range(240)]
    core = ds.cores.orderBy("core_id").first()
    own = ds.cells.orderBy("cell_id").limit(len(spots)).select("cell_id").collect()
    at = spark.createDataFrame([(r["cell_id"], *spots[i]) for i, r in enumerate(own)], "cell_id string, nx double, ny double")
    cells = ds.cells.join(at, "cell_id").withColumns({"x_um": F.col("nx"), "y_um": F.col("ny")} | {c: F.lit(core[c]) for c in ("core_id", "section_id", "patient_id")})
    n = cells.groupBy("cluster_id").agg(F.count("*").alias("seen"))
    clusters = ds.clusters.join(n, "cluster_id", "left").withColumn("n_cells", F.coalesce("seen", F.lit(0)))
    cores = ds.cores.where(F.col("core_id") == core["core_id"]).withColumns({c: F.lit(v) for c, v in {"center_x_um": 250.0, "center_y_um": 250.0, "radius_um": 360.0, "bbox_x0": 0.0, "bbox_y0": 0.0, "bbox_x1": 500.0, "bbox_y1": 500.0}.items()})
    made = ds.having(cells=conform(cells, CELLS), clusters=conform(clusters, CLUSTERS), cores=conform(cores, CORES), sections=ds.sections.where(F.col("section_id") == core["section_id"]), expression=ds.expression.join(at.select("cell_id"), "cell_id", "left_semi"))
    return made, len(own)


def test_a_run_with_an_image_makes_tiles_and_checks_its_place(spark, valid, tmp_path):
    ds, n = small_dataset(spark, valid)
    for name, shift in (("good", 0.0), ("off", 12.0)):
        files.save(stained(spark, str(tmp_path / f"{name}.tiles"), ds, shift), str(tmp_path / name))
    cfg = lambda name: Config("saved-one", "saved", path=str(tmp_path / name), images=str(tmp_path / f"{name}.tiles"))
    s = publish.run(spark, cfg("good"), str(tmp_path / "o"))
    assert n > 150 and s["sizes"]["he"]["files"] > 4 and s["sizes"]["thumbs"]["files"] == 1 and not (tmp_path / f"o/{s['release']}/tiles.parquet").exists()
    (rows,) = s["alignment"].values()
    assert {(r["source"], r["mask"], r["control"]) for r in rows} == {(a, b, c) for a in ("image", "pyramid") for b in ("tissue", "near cells") for c in (True, False)}
    assert "aligned" in publish.render(s)
    assets = spark.read.parquet(f"{tmp_path}/o/{s['release']}/assets.parquet")
    core = json.loads(bytes(assets.where("rel = 'cores.json'").first()["payload"]))[0]
    level = core["pyramid"]["levels"][-1]
    assert assets.where(F.col("rel").startswith(f"he/{core['id']}/{level['z']}/")).count() == level["cols"] * level["rows"]
    with pytest.raises(publish.CheckError, match="not aligned"):
        publish.run(spark, cfg("off"), str(tmp_path / "p"))
    assert not (tmp_path / "p/current.json").exists()


def test_gates_of_layout_embedding_and_sources(spark, valid, monkeypatch):
    from cytoloom.operators import ordering as o

    ds = files.load(spark, valid.path)
    publish.check_layout(ds)
    real = o.placed
    monkeypatch.setattr(o, "placed", lambda d: real(d).withColumn("idx", F.when(F.col("idx") == 3, 10**6).otherwise(F.col("idx"))))
    with pytest.raises(publish.CheckError, match="contiguous"):
        publish.check_layout(ds)
    monkeypatch.setattr(o, "placed", real)
    assert 0 <= ordering.embedding_error(ds.cells).first()["share"] <= 1e-4
    monkeypatch.setattr(publish, "MAX_ERROR_SHARE", -1.0)
    with pytest.raises(publish.CheckError, match="embedding"):
        publish.check_quantisation(ds)
    assert publish.check_sources(["a/cells.parquet"]) == ["a/cells.parquet"]
    with pytest.raises(publish.CheckError, match="forbidden"):
        publish.check_sources(["a/transcripts.parquet"])


def test_two_runs_are_equal(spark, valid, tmp_path):
    assert publish.reproduce(spark, valid, str(tmp_path)).count() == 0


def test_gates(spark, valid, tmp_path):
    with pytest.raises(publish.CheckError, match="allowed"):
        publish.run(spark, Config("saved-one", "saved", path=valid.path, max_total_bytes=10), str(tmp_path / "a"))
    assert not (tmp_path / "a/current.json").exists()
    with pytest.raises(validation.ContractError, match="cells = 7"):
        publish.run(spark, Config("saved-one", "saved", path=valid.path, expected=validation.Expected(n_cells=7)), str(tmp_path / "b"))
    with pytest.raises(FileNotFoundError, match="build its source first"):
        publish.run(spark, Config("d", "derived", path=str(tmp_path / "none")), str(tmp_path / "c"))


def raw(spark, root, groups=None, version="xenium-3.0.0.15", first=1):
    (root / "outs").mkdir(parents=True)
    (root / "supplemental").mkdir()
    (root / "outs/experiment.xenium").write_text(json.dumps({"analysis_sw_version": version, "pixel_size": 0.2125}))
    n = 40
    spark.createDataFrame([(f"c{i}", float(i), float(i % 7), 0 if i == 0 else 3, "x") for i in range(n)], "cell_id string, x_centroid double, y_centroid double, transcript_counts int, other string").write.parquet(str(root / "outs/cells.parquet"))
    order, slices = list(range(n))[::-1], []
    for begin in (0, 25):
        own = order[begin : begin + 25]
        indptr, indices, data = [0], [], []
        for i in own:
            if i:
                indices += [0, 2, 3]
                data += [1, 2, 9]
            indptr.append(len(indices))
        features = (["Gene Expression"] * 3 + ["Negative Control"], ["g1", "g2", "g3", "n1"], ["Abc", "X", "abc", "neg"]) if not begin else (None, None, None)
        slices.append((begin, [f"c{i}" for i in own], *features, indptr, indices, data))
    spark.createDataFrame(slices, "first long, barcodes array<string>, feature_type array<string>, id array<string>, name array<string>, indptr array<long>, indices array<long>, data array<long>").write.parquet(str(root / "outs/cell_feature_matrix.parquet"))
    target = lambda g, c, d="gene": {"type": {"descriptor": d, "data": {"id": g} if g else {}}, "source": {"category": c}}
    (root / "outs/gene_panel.json").write_text(json.dumps({"payload": {"targets": [target("g1", "base"), target("g2", "addon"), target("n1", "base", "control"), target(None, "base")]}}))
    rows = groups or [f"c{i},{'T cells' if i % 3 else 'B / plasma'},#{'aa' if i % 3 else 'BB'}0000" for i in range(1, n)] + ["zz,Unassigned,#cccccc"]
    (root / "supplemental/cell_groups.csv").write_text("cell_id,group,color\n" + "\n".join(rows) + "\n")
    (root / "outs/projection.csv").write_text("Barcode,UMAP-1,UMAP-2\n" + "\n".join(f"c{i},{i % 3}.5,{i}" for i in range(first, n)) + "\n")
    (root / "supplemental/he_imagealignment.csv").write_text("2,0,10\n0,2,20\n0,0,1\n")
    return Config("one", "sensor", path=str(root))


def test_raw_files_become_a_dataset(spark, tmp_path):
    log = files.Ledger()
    ds = adapters.sensor(spark, raw(spark, tmp_path / "r"), log)
    genes = {r["gene_id"]: (r["symbol"], r["panel"]) for r in ds.genes.collect()}
    assert genes == {"g1": ("Abc", "predesigned"), "g2": ("X", "custom"), "g3": ("abc-2", "custom")}
    c = {r["cell_id"]: r for r in ds.cells.collect()}
    assert len(c) == 40 and c["c0"]["cluster_id"] == "unassigned" and not c["c0"]["has_umap"] and c["c1"]["has_umap"] and c["c2"]["umap_y"] == 2.0
    assert [(r["cluster_id"], r["color"], r["n_cells"]) for r in ds.clusters.orderBy("order").collect()] == [("t-cells", "#AA0000", 26), ("b-plasma", "#BB0000", 13), ("unassigned", "#CCCCCC", 1)]
    assert ds.expression.agg(F.sum("count")).first()[0] == 39 * 3
    s = ds.sections.first()
    assert s["affine"] == pytest.approx([1 / 2 / 0.2125, 0, -5, 0, 1 / 2 / 0.2125, -10, 0, 0, 1]) and s["he_pixel_size_um"] == pytest.approx(0.425)
    assert list(log.used.values()) == ["experiment", "cells", "matrix", "panel", "groups", "projection", "alignment"]
    bad = [r["rule"] for r in validation.report(ds).collect() if not r["ok"]]
    assert bad == []


def test_embeddings_are_recomputed_once_and_the_better_one_is_taken(spark, tmp_path):
    from dataclasses import replace

    cfg = replace(raw(spark, tmp_path / "r"), recompute_in=str(tmp_path / "cache"))
    ds = adapters.sensor(spark, cfg)
    p = ds.record.provenance
    assert {"coherence_provided", "coherence_recomputed"} <= set(p) and p["scored_cells"] == 39 and p["without_embedding"] == 1
    assert p["embedding"] == ("recomputed" if p["coherence_recomputed"] > p["coherence_provided"] else "provided")
    assert ds.cells.where("not has_umap").count() == 1 and len(list((tmp_path / "cache").iterdir())) == 1
    assert adapters.sensor(spark, cfg).record.provenance == p and len(list((tmp_path / "cache").iterdir())) == 1


def test_raw_files_that_break_rules(spark, tmp_path):
    with pytest.raises(ValueError, match="no group"):
        adapters.sensor(spark, raw(spark, tmp_path / "a", groups=["c1,T,#aa0000"]))
    with pytest.raises(ValueError, match="not known"):
        adapters.sensor(spark, raw(spark, tmp_path / "b", version="other-9"))
    with pytest.raises(ValueError, match="misses 1 cells"):
        adapters.sensor(spark, raw(spark, tmp_path / "c", first=2))
    with pytest.raises(KeyError, match="no adapter"):
        adapters.ADAPTERS["nothing"]


def test_command_line(spark, valid, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("DATA_ROOT", str(tmp_path))
    monkeypatch.setenv("CYTOLOOM_ALLOW_SAME_VOLUME", "1")
    (tmp_path / "saved-one.toml").write_text(f'name = "saved-one"\nadapter = "saved"\npath = "{valid.path}"\n')
    assert main(["--configs", str(tmp_path), "run", "unknown"]) == 2
    assert main(["--configs", str(tmp_path), "run", "saved-one"]) == 0 and "release" in capsys.readouterr().out
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/f.txt").write_text("hello")
    (tmp_path / "md5").write_text("5d41402abc4b2a76b9719d911017c592  f.txt\n")
    assert main(["data", str(tmp_path / "raw"), "--md5", str(tmp_path / "md5")]) == 0
    (tmp_path / "md5").write_text("5d41402abc4b2a76b9719d911017c593  f.txt\n")
    assert main(["data", str(tmp_path / "raw"), "--md5", str(tmp_path / "md5")]) == 1
