"""Building, checking and publishing a release; running twice and comparing."""

from __future__ import annotations

import json
import logging
import time
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .functions.codec import u16_hex
from .model import Dataset
from .operators import align, expression, integrity, ordering, raster, slides
from .operators.validation import require_valid
from .sources import files
from .sources.adapters import ADAPTERS

log = logging.getLogger("cytoloom.publish")
MAX_ERROR_UM, MAX_ERROR_SHARE = 0.5, 0.001


class CheckError(RuntimeError):
    pass


def _typed(ds: Dataset) -> DataFrame:
    """(rel, family, payload): little-endian columns of the cells, a file for each core; files in order of name are the whole column."""
    t = ordering.typed_columns(ds)
    byte = lambda c: F.lpad(F.hex(F.col(c).cast("long")), 2, "0")
    columns = {"umap.u16": F.concat(u16_hex(F.col("ux")), u16_hex(F.col("uy"))), "xy.u16": F.concat(u16_hex(F.col("qx")), u16_hex(F.col("qy"))), "cluster.u8": byte("cluster"), "core.u16": u16_hex(F.col("core")), "ntx.u16": u16_hex(F.col("ntx"))}
    rows = t.select("core", "idx", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("h")) for k, v in columns.items()])).alias("x"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "x.h"))), lambda r: r["h"]), "")
    g = rows.groupBy("core", "x.k").agg(F.unhex(whole).alias("payload"))
    return g.select(F.format_string("cells/%s/%06d", "k", "core").alias("rel"), F.lit("cells").alias("family"), "payload")


def _tables(ds: Dataset, scale_factor: float, images: bool) -> list[tuple[str, str, bytes]]:
    """The JSON tables: clusters, cores, sections and genes, each some thousands of rows at most."""
    pos = {r["core_id"]: [r["first"], r["end"]] for r in ordering.core_ranges(ordering.placed(ds)).collect()}
    q = {r["section_id"]: r for r in ordering.section_quantisers(ds.sections).collect()}
    shapes = _pyramids(ds) if images else {}
    clusters = [{"id": r["cluster_id"], "label": r["label"], "color": r["color"], "order": r["order"], "n_cells": r["n_cells"]} for r in ds.clusters.orderBy("order").collect()]
    cores = [
        {"id": r["core_id"], "section": r["section_id"], "patient": r["patient_id"], "kind": r["kind"], "center_um": [r["center_x_um"], r["center_y_um"]], "radius_um": r["radius_um"], "bbox_um": [r[f"bbox_{x}"] for x in ("x0", "y0", "x1", "y1")], "cell_range": pos.get(r["core_id"]), "clinical": {}, "pyramid": shapes.get(r["core_id"])}
        for r in ds.cores.orderBy("section_id", "core_id").collect()
    ]
    sections = [
        {"id": r["section_id"], "pixel_size_um": r["pixel_size"], "bounds_um": [r[f"bounds_{x}"] for x in ("x0", "y0", "x1", "y1")], "xy_offset": q[r["section_id"]]["q_offset"], "xy_scale": q[r["section_id"]]["q_scale"],
         "image": None if r["he_image"] is None else {"um_to_px": r["affine"], "source": r["affine_source"], "px_um": r["he_pixel_size_um"]}}
        for r in ds.sections.orderBy("section_id").collect()
    ]
    values = expression.quantised(expression.display_values(ds.expression, scale_factor)).groupBy("gene_id").agg(F.max("max_v").alias("m"), F.count("*").alias("n"))
    genes = [{"id": r["gene_id"], "symbol": r["symbol"], "panel": r["panel"], "max_v": r["m"] or 0.0, "nnz": r["n"] or 0, "file": f"expr/{r['gene_id']}.bin"} for r in ds.genes.join(values, "gene_id", "left").orderBy("gene_id").collect()]
    return [(f"{k}.json", "tables", integrity.canonical_json(v).encode()) for k, v in (("clusters", clusters), ("cores", cores), ("sections", sections), ("genes", genes))]


def _pyramids(ds: Dataset) -> dict[str, dict]:
    """What a reader of a core's tiles needs to know, for cores whose section has an image."""
    px = ds.sections.where("he_image is not null").select("section_id", (F.floor(F.col("he_pixel_size_um") * 100) / 100).alias("px"))
    shaped = raster.pyramids(ds.cores, ds.cores.join(px, "section_id").select("core_id", "px"))
    levels = raster.level_table(shaped).groupBy("core_id").agg(F.sort_array(F.collect_list(F.struct("z", "px_um", "w", "h", "cols", "rows"))).alias("l"))
    return {
        r["core_id"]: {"origin_um": [r["x0"], r["y0"]], "size_um": [r["width"], r["height"]], "tile": raster.TILE, "format": "rgb, zlib", "resampling": "lanczos4", "levels": [v.asDict() for v in r["l"]]}
        for r in shaped.join(levels, "core_id").collect()
    }


def tile_assets(built: DataFrame) -> DataFrame:
    """(rel, family, payload) of slides.build(): tiles he/<core>/<z>/<x>_<y>, thumbnails thumbs/<core>."""
    thumb = F.col("z") < 0
    rel = F.when(thumb, F.format_string("thumbs/%s.rgbz", "core_id")).otherwise(F.format_string("he/%s/%d/%d_%d.rgbz", "core_id", "z", "tx", "ty"))
    return built.select(rel.alias("rel"), F.when(thumb, "thumbs").otherwise("he").alias("family"), "payload")


def build(ds: Dataset, scale_factor: float = 1e4, images: bool = False) -> DataFrame:
    """(rel, family, payload) of every asset but images. images: whether there will be tiles."""
    spark, n = ds.cells.sparkSession, ds.cells.count()
    deltas = expression.quantised_deltas(expression.display_values(ds.expression, scale_factor), ordering.placed(ds))
    blobs = expression.blobs(deltas, n).select(F.concat(F.lit("expr/"), "gene_id", F.lit(".bin")).alias("rel"), F.lit("expression").alias("family"), "payload")
    tables = spark.createDataFrame([(a, b, bytearray(c)) for a, b, c in _tables(ds, scale_factor, images)], "rel string, family string, payload binary")
    return blobs.unionByName(_typed(ds)).unionByName(tables)


def check_quantisation(ds: Dataset) -> dict[str, float]:
    """Largest errors of decoded coordinates by section, in micrometres; too large ones, of the embedding too, are an error."""
    errors = {r["section_id"]: r["max_err"] for r in ordering.quantisation_errors(ds).collect()}
    for section, e in errors.items():
        if not e <= MAX_ERROR_UM:
            raise CheckError(f"coordinates of {section} are off by {e} micrometres")
    share = ordering.embedding_error(ds.cells).first()["share"]
    if not share <= MAX_ERROR_SHARE:
        raise CheckError(f"the embedding is off by {share:.2%} of its range")
    return errors


def check_layout(ds: Dataset) -> None:
    """That the cells of every core are one run of places."""
    if broken := [r["core_id"] for r in ordering.core_ranges(ordering.placed(ds)).where("not contiguous").limit(5).collect()]:
        raise CheckError(f"cells of {', '.join(broken)} are not contiguous")


def check_alignment(ds: Dataset, tiles: DataFrame, built: DataFrame) -> dict[str, list]:
    """The alignment suite of every section with an image; one that fails is an error."""
    out = {}
    for section in ds.sections.where("he_image is not null").orderBy("section_id").collect():  # a few to a dataset; each suite is jobs of its own
        key, cores = section["section_id"], ds.cores.where(F.col("section_id") == section["section_id"])
        rows, passed = align.check_section(ds.cells.where(F.col("section_id") == key), cores, section, tiles.where(F.col("image") == section["he_image"]), built)
        if not passed:
            raise CheckError(f"the image of {key} is not aligned: " + ", ".join(f"{r['source']}/{r['mask']}{' shifted' * r['control']} d {r['d']:.2f} z {r['z']:.1f}" for r in rows))
        out[key] = [r.asDict() for r in rows]
    return out


def check_sources(read: list[str]) -> list[str]:
    """The raw files that a run read, none of them forbidden."""
    if broken := files.forbidden(read):
        raise CheckError(f"forbidden files were read: {', '.join(broken)}")
    return read


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, path_of = _fs(spark, path)
    out = fs.create(path_of(path), True)
    out.write(bytearray(text.encode()))
    out.close()


def run(spark: SparkSession, cfg: Config, out: str) -> dict:
    """Load, validate, save, build, check and publish; the release appears whole, and the pointer to it last."""
    began = time.time()
    ds = ADAPTERS[cfg.adapter](spark, cfg)
    report = require_valid(ds, cfg.expected, cfg.name)
    files.save(ds, f"{out}/canonical")
    ds = files.load(spark, f"{out}/canonical")
    errors = check_quantisation(ds)
    check_layout(ds)
    staging = f"{out}/_staging"
    made = build(ds, cfg.scale_factor, bool(cfg.images))
    alignment = {}
    if cfg.images:
        tiles = spark.read.parquet(cfg.images)
        slides.build(ds.cores, ds.sections, tiles).write.mode("overwrite").parquet(f"{staging}/tiles.parquet")
        built = spark.read.parquet(f"{staging}/tiles.parquet")
        alignment = check_alignment(ds, tiles, built)
        made = made.unionByName(tile_assets(built))
    made.write.mode("overwrite").partitionBy("family").parquet(f"{staging}/assets.parquet")
    listed = integrity.assets(spark.read.parquet(f"{staging}/assets.parquet"))
    integrity.index_files(listed).select("rel", "family", "payload").write.mode("append").partitionBy("family").parquet(f"{staging}/assets.parquet")
    listed = integrity.assets(spark.read.parquet(f"{staging}/assets.parquet"))
    counts = dict(zip(("cells", "without_embedding", "median_transcripts"), ds.cells.agg(F.count("*"), F.count_if(~F.col("has_umap")), F.coalesce(F.median("n_transcripts"), F.lit(0.0))).first()))
    counts |= {t: getattr(ds, t).count() for t in ("genes", "clusters", "cores", "sections")} | {"patients": ds.cores.select("patient_id").distinct().count()}
    manifest = integrity.manifest(listed, asdict(ds.record), counts)
    total = sum(s["bytes"] for s in manifest["sizes"].values())
    if total > cfg.max_total_bytes:
        raise CheckError(f"{total} bytes of assets; at most {cfg.max_total_bytes} are allowed")
    raw = check_sources(list(ds.record.provenance.get("raw", [])))
    fs, path_of = _fs(spark, out)
    if cfg.images:
        fs.delete(path_of(f"{staging}/tiles.parquet"), True)
    _write(spark, f"{staging}/manifest.json", integrity.canonical_json(manifest))
    final = path_of(f"{out}/{manifest['release']}")
    if fs.exists(final):
        fs.delete(final, True)
    fs.rename(path_of(staging), final)
    _write(spark, f"{out}/current.json", json.dumps({"release": manifest["release"]}))
    log.info("release %s", manifest["release"])
    return {"name": cfg.name, "release": manifest["release"], "counts": counts, "sizes": manifest["sizes"], "errors_um": errors, "alignment": alignment, "raw": raw, "rules": len(report), "seconds": round(time.time() - began, 1), "out": out}


def render(s: dict) -> str:
    lines = [f"{s['name']} release {s['release']} ({s['seconds']} s) -> {s['out']}", f"valid: {s['rules']} rules"]
    lines += [f"{k} = {v:g}" for k, v in s["counts"].items()] + [f"largest error of {k}: {v:.4f} um" for k, v in sorted(s["errors_um"].items())]
    lines += [f"{k}: {v['files']} files, {v['bytes']} bytes" for k, v in sorted(s["sizes"].items())]
    lines += [f"aligned {k}, {r['source']} against {r['mask']}{' (shifted)' * r['control']}: d {r['d']:.3f}, p {r['p']:.2g}" for k, rows in sorted(s["alignment"].items()) for r in rows]
    return "\n".join(lines + [f"read: {path}" for path in s["raw"]])


def reproduce(spark: SparkSession, cfg: Config, out: str) -> DataFrame:
    """Files that differ between two runs."""
    one, two = (run(spark, cfg, f"{out}/{i}") for i in ("one", "two"))
    read = lambda s: integrity.assets(spark.read.parquet(f"{s['out']}/{s['release']}/assets.parquet"))
    return integrity.differing(read(one), read(two))


def export(assets: DataFrame, folder: str) -> DataFrame:
    """Writes (rel, payload) as files below a folder that all executors see; returns (rel, bytes)."""

    def write(frames):
        import os

        for f in frames:
            for rel, payload in zip(f["rel"], f["payload"]):
                path = os.path.join(folder, rel)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path + ".part", "wb") as h:
                    h.write(payload)
                os.replace(path + ".part", path)
            yield f.assign(bytes=f["payload"].map(len))[["rel", "bytes"]]

    return assets.select("rel", "payload").mapInPandas(write, "rel string, bytes long")
