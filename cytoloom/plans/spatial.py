"""Geometry, sampling, derivation and raster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align, derive, raster, slides, spatial
from ..sources import warehouse
from .registry import canon, query


@query("g4_bounding", canon("cells") + "select core_id, floor(min(x_um))::bigint as x0, floor(min(y_um))::bigint as y0, ceil(max(x_um))::bigint as x1, ceil(max(y_um))::bigint as y1, (floor(min(x_um))+ceil(max(x_um)))/2 as cx, (floor(min(y_um))+ceil(max(y_um)))/2 as cy, greatest(ceil(max(x_um))-floor(min(x_um)), ceil(max(y_um))-floor(min(y_um)))/2 as radius from cells group by 1")
def g4(spark, d):
    return spatial.bounding(warehouse.cells(spark, d), "core_id")


@query("g6_replicas", """with b as (select n_regionkey as base, count(*) as n from nation group by 1), r as (select base, rep, row_number() over (order by rep, base) as i, sum(n) over (order by rep, base) - n as before from b, range(60) t(rep))
select base, rep::int as rep from r where rep = 0 or before < 123 or i - 1 < 17""")
def g6(spark, d):
    b = warehouse.read(spark, d, "nation").groupBy(F.col("n_regionkey").alias("base")).agg(F.count("*").alias("n"))
    return spatial.replicas(b, 123, 17)


@query("g7_layout", """with n as (select ceil(sqrt(ceil(count(*)/3.0e0)))::bigint as k from customer), i as (select row_number() over (order by c_custkey) - 1 as i from customer)
select i as c, 'S' || (i%3+1) as section, (i//3)%k as gx, (i//3)//k as gy, 1000+((i//3)%k+0.5e0)*1500 as x, 1000+((i//3)//k+0.5e0)*1500 as y from i, n""")
def g7(spark, d):
    """A place for a core of each customer."""
    return spatial.layout(warehouse.read(spark, d, "customer", "c_custkey").count(), 3, spark=spark)


@query("g10_core_boxes", canon("cells", "cores") + "select core_id, round(least(min(x_um), min(center_x_um)-radius_um),6) as x0, round(least(min(y_um), min(center_y_um)-radius_um),6) as y0, round(greatest(max(x_um), max(center_x_um)+radius_um),6) as x1, round(greatest(max(y_um), max(center_y_um)+radius_um),6) as y1 from cells join cores using (core_id) group by core_id, radius_um")
def g10(spark, d):
    cores = warehouse.cores(spark, d).select("core_id", F.col("center_x_um").alias("nx"), F.col("center_y_um").alias("ny"), F.col("radius_um").alias("r"))
    boxes = derive.core_boxes(cores, warehouse.cells(spark, d), F.col("r"))
    return boxes.select("core_id", *[F.round(f"bbox_{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("g14_fixture_disks", canon("cells", "expression") + """, w as (select floor(x_um/600)*600 as wx, floor(y_um/600)*600 as wy, count(*) as n from cells group by 1,2 order by n desc, 1, 2 limit 1),
 k as (select * from (values ('C001', 'P01', 150, 150), ('C002', 'P01', 450, 150), ('C003', 'P02', 150, 450), ('C004', 'P03', 450, 450)) t(core, patient, nx, ny)),
 o as (select cell_id, core, patient, x_um - wx as x, y_um - wy as y from cells, w, k where sqrt((x_um-wx-nx)**2 + (y_um-wy-ny)**2) <= 130), e as (select * from expression where cell_id in (select cell_id from o)),
 t as (select gene_id, count(*) as nnz from e group by 1 order by nnz desc, gene_id limit 150), s as (select cell_id, sum(count) as n from e where gene_id in (select gene_id from t) group by 1)
select o.cell_id, core as core_id, patient as patient_id, round(x,6) as x_um, round(y,6) as y_um, coalesce(n,0)::int as n_transcripts from o left join s using (cell_id)""")
def g14(spark, d):
    c = derive.cut_fixture(warehouse.load(spark, d)).cells
    return c.select("cell_id", "core_id", "patient_id", F.round("x_um", 6).alias("x_um"), F.round("y_um", 6).alias("y_um"), "n_transcripts")


@query("g17_stencil", "select s_suppkey as id, (s_suppkey*17)%160+dx as x, (s_suppkey*5)%120+dy as y from supplier, range(-6,7) a(dx), range(-6,7) b(dy) where dx*dx+dy*dy <= 36")
def g17(spark, d):
    """The disk of pixels around a place of each supplier."""
    at = warehouse.read(spark, d, "supplier", "s_suppkey").crossJoin(F.broadcast(spatial.stencil(spark, 6)))  # the disk is a constant
    return at.selectExpr("s_suppkey as id", "(s_suppkey*17)%160+dx as x", "(s_suppkey*5)%120+dy as y")


@query("g5_spaced_cells", canon("cells").replace("with ", "with recursive ", 1) + """, p as materialized (select core_id, cell_id, x_um, y_um, row_number() over (partition by core_id order by cell_id) as i from cells),
 s as (select core_id, 0::bigint as i, ''::varchar as cell_id, false as ok, []::struct(x double, y double)[] as kept from p group by core_id
   union all select core_id, i, cell_id, fits, case when fits then list_append(kept, {'x': x_um, 'y': y_um}) else kept end
   from (select p.*, s.kept, len(list_filter(s.kept, lambda k: (p.x_um-k.x)*(p.x_um-k.x) + (p.y_um-k.y)*(p.y_um-k.y) < 10000)) = 0 as fits from s join p on p.core_id = s.core_id and p.i = s.i + 1) t)
select core_id, cell_id from s where ok""")
def g5(spark, d):
    """Cells of each core that are 100 micrometres apart, in order of their names."""
    return spatial.spaced(warehouse.cells(spark, d), 100.0, "cell_id", by=("core_id",)).select("core_id", "cell_id")


@query("g5_g8_derived")
def g8(spark, d):
    """A derived dataset: cores by seeded darts, replicas, patients; checked by its own validation report."""
    from ..operators.validation import report

    made = derive.derive(warehouse.load(spark, d), derive.Plan(seed=3, radius=250.0, sections=2, min_cores=6))
    return report(made)


@query("i1_pyramids", canon("cores") + "select core_id, bbox_x0-50 as x0, bbox_y0-50 as y0, bbox_x1-bbox_x0+100 as width, bbox_y1-bbox_y0+100 as height, 0.27e0 as px, greatest(1, ceil(log2(greatest(ceil((bbox_x1-bbox_x0+100)/0.27e0), ceil((bbox_y1-bbox_y0+100)/0.27e0))/512))::int+1) as levels from cores")
def i1(spark, d):
    return raster.pyramids(warehouse.cores(spark, d), 0.2738)


_LEVELS = canon("cores") + """, p as (select core_id, 1100.0e0 as width, 1100.0e0 as height, 4 as levels from cores), z as (select core_id, z::int as z, 0.27e0*2**(levels-1-z) as px_um, width, height from p, range(4) t(z)),
 l as (select core_id, z, px_um, ceil(width/px_um)::bigint as w, ceil(height/px_um)::bigint as h, ceil(ceil(width/px_um)/512)::bigint as cols, ceil(ceil(height/px_um)/512)::bigint as rows from z) """


@query("i2_levels", _LEVELS + "select * from l")
def i2(spark, d):
    return raster.level_table(raster.pyramids(warehouse.cores(spark, d), 0.2738))


@query("i3_blocks", _LEVELS + 'select core_id, z, bx, "by", least(2048, w-bx) as bw, least(2048, h-"by") as bh from l, range(0,8192,2048) a(bx), range(0,8192,2048) b("by") where bx < w and "by" < h')
def i3(spark, d):
    return raster.block_table(raster.level_table(raster.pyramids(warehouse.cores(spark, d), 0.2738)))


@query("q10_tiles_in_view", _LEVELS + "select core_id, z, tx, ty from l, range(0,9) a(tx), range(0,9) b(ty) where tx < cols and ty < rows and tx between 1 and 5 and ty between 2 and 6")
def q10(spark, d):
    return raster.tiles_in_view(raster.level_table(raster.pyramids(warehouse.cores(spark, d), 0.2738)), 700, 1300, 2700, 3100)


@query("i4_source_level", "select id, (select max(k) from range(6) t(k) where k = 0 or 2**k*0.27e0 <= px*1.05e0)::int as k from (select s_suppkey as id, 0.1e0 + (s_suppkey%40)*0.2e0 as px from supplier)")
def i4(spark, d):
    """One lookup for each wanted pixel size."""
    want = warehouse.read(spark, d, "supplier", "s_suppkey").selectExpr("s_suppkey as id", "0.1D + (s_suppkey % 40) * 0.2D as px")
    return raster.source_level(want, spark.range(6).selectExpr("cast(id as int) as k", "pow(2.0D, id) as factor"), 0.27)


_PIX = "with px as (select i%160 as x, i//160 as y, (i*7)%256 as r, (i*13+i//160)%256 as g, (i*i)%251 as b from range(19200) t(i)) "


def _pixels(spark):
    return spark.range(19200).selectExpr("id % 160 as x", "id div 160 as y", "(id*7)%256 as r", "(id*13+id div 160)%256 as g", "(id*id)%251 as b")


_IMG = "with px as (select o_orderkey%160 as x, o_orderkey//160 as y, floor(o_totalprice)::bigint%256 as r, (o_custkey*13)%256 as g, floor(o_totalprice/7)::bigint%251 as b from orders) "


def _image(spark, d):
    """The orders as an image: a pixel for each."""
    o = warehouse.read(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return o.selectExpr("o_orderkey % 160 as x", "o_orderkey div 160 as y", "floor(o_totalprice) % 256 as r", "(o_custkey * 13) % 256 as g", "floor(o_totalprice / 7) % 251 as b")


@query("i6_box_shrink", _IMG + "select x//4 as x, y//4 as y, round_even(avg(r),0)::int as r, round_even(avg(g),0)::int as g, round_even(avg(b),0)::int as b from px group by 1, 2")
def i6(spark, d):
    return raster.box_shrunk(_image(spark, d), 4)


_K = raster._stain_row()
_H = "greatest(0, " + " + ".join(f"ln(greatest({c}/255.0e0, 1e-6))/ln(1e-6)*({k!r}e0)" if "e" not in repr(k) else f"ln(greatest({c}/255.0e0, 1e-6))/ln(1e-6)*({k!r})" for c, k in zip("rgb", _K)) + ")"


@query("i12_hematoxylin", _IMG + f"select x, y, round({_H},6) as h from px")
def i12(spark, d):
    return _image(spark, d).select("x", "y", F.round(raster.hematoxylin(F.col("r"), F.col("g"), F.col("b")), 6).alias("h"))


@query("i13_tissue", _IMG + "select x//10 as u, y//10 as v, round(sum(r+g+b)/(3.0e0*count(*)),6) as gray, sum(r+g+b)/(3.0e0*count(*)) < 220 as tissue from px group by 1, 2")
def i13(spark, d):
    return raster.tissue(_image(spark, d), 10).withColumn("gray", F.round("gray", 6))


@query("i14_disk_means", _PIX + f", p as (select s_suppkey as id, (s_suppkey*17)%160 as u, (s_suppkey*5)%120 as v from supplier) select id, round(avg({_H}),6) as mean, count(*) as n from p, range(-3,4) a(dx), range(-3,4) b(dy), px where dx*dx+dy*dy <= 9 and px.x = u+dx and px.y = v+dy group by 1")
def i14(spark, d):
    p = warehouse.read(spark, d, "supplier", "s_suppkey").selectExpr("s_suppkey as id", "(s_suppkey*17)%160 as u", "(s_suppkey*5)%120 as v")
    m = raster.disk_means(p, _pixels(spark), 3, raster.hematoxylin(F.col("r"), F.col("g"), F.col("b")))
    return m.withColumn("mean", F.round("mean", 6))


def _slide(spark):
    """A tile table of two levels of a procedural image of 3,000 x 2,400 pixels."""
    at = spark.range(2).selectExpr("cast(id as int) as level").selectExpr("level", "explode(sequence(0, (2999 >> level) div 512)) as tx").selectExpr("*", "explode(sequence(0, (2399 >> level) div 512)) as ty")

    def draw(frames):
        import zlib

        import numpy as np
        import pandas as pd

        for f in frames:
            out = []
            for level, tx, ty in zip(f["level"], f["tx"], f["ty"]):
                cell, w, h = 1 << level, min(512, (3000 >> level) - 512 * tx), min(512, (2400 >> level) - 512 * ty)
                y, x = np.mgrid[512 * ty * cell : (512 * ty + h) * cell, 512 * tx * cell : (512 * tx + w) * cell]
                part = slides.averaged(np.stack([x * 3 % 256, y * 5 % 256, (x + y) % 256], axis=-1).astype(np.uint8), cell)
                out.append(("slide", level, tx, ty, w, h, zlib.compress(np.ascontiguousarray(part).tobytes(), 1)))
            yield pd.DataFrame(out, columns=["image", "level", "tx", "ty", "w", "h", "payload"])

    return at.repartition(8).mapInPandas(draw, "image string, level int, tx int, ty int, w int, h int, payload binary")


def _slide_cores(spark, d):
    affine_ = F.array(*[F.lit(float(v)) for v in (1, 0, -750, 0, 1, -750, 0, 0, 1)])
    sections = warehouse.sections(spark, d).select("section_id", F.lit("slide").alias("he_image"), affine_.alias("affine"), F.lit(1.0).alias("he_pixel_size_um"))
    return warehouse.cores(spark, d), sections


@query("s12_image_levels", """with s as (select s_suppkey, 600 + (s_suppkey%7)*400 as w, 500 + (s_suppkey%5)*300 as h from supplier)
select 'slide' || s_suppkey as image, l as level, (w >> l)::int as w, (h >> l)::int as h, w::double / (w >> l) as fx, h::double / (h >> l) as fy from s, range(0, 3) t(l)""")
def s12(spark, d):
    """Sizes and factors of the levels of images, one of each supplier, read from their tiles."""
    s = warehouse.read(spark, d, "supplier", "s_suppkey").selectExpr("concat('slide', s_suppkey) as image", "600 + (s_suppkey % 7) * 400 as w0", "500 + (s_suppkey % 5) * 300 as h0", "explode(array(0, 1, 2)) as level")
    s = s.selectExpr("image", "level", "shiftright(w0, level) as w1", "shiftright(h0, level) as h1").selectExpr("*", "explode(sequence(0L, (w1 - 1) div 512)) as tx").selectExpr("*", "explode(sequence(0L, (h1 - 1) div 512)) as ty")
    return slides.levels_of(s.selectExpr("image", "level", "cast(tx as int) as tx", "cast(ty as int) as ty", "cast(least(512, w1 - 512 * tx) as int) as w", "cast(least(512, h1 - 512 * ty) as int) as h"))


@query("i9_tiles", canon("cores") + """, p as (select core_id, bbox_x1-bbox_x0+100 as w, bbox_y1-bbox_y0+100 as h from cores), l as (select core_id, w, h, greatest(1, ceil(log2(greatest(ceil(w/1.0e0), ceil(h/1.0e0))/512))::int+1) as levels from p),
 z as (select core_id, z::int as z, ceil(w/(1.0e0*2**(levels-1-z)))::bigint as w, ceil(h/(1.0e0*2**(levels-1-z)))::bigint as h from l, range(0, 12) t(z) where z < levels union all select core_id, -1, greatest(1, round_even(w/(greatest(w,h)/256), 0))::bigint, greatest(1, round_even(h/(greatest(w,h)/256), 0))::bigint from l)
select core_id, z, tx::int as tx, ty::int as ty, least(512, w-512*tx)::int as w, least(512, h-512*ty)::int as h, (least(512, w-512*tx)*least(512, h-512*ty)*3)::bigint as bytes from z, range(0, 20) a(tx), range(0, 20) b(ty) where 512*tx < w and 512*ty < h""")
def i9(spark, d):
    """Tiles of all cores and levels, and thumbnails, from a procedural image: their shapes, and bytes when unpacked."""
    import zlib

    def unpacked(frames):
        for f in frames:
            yield f.assign(bytes=[len(zlib.decompress(p)) for p in f["payload"]]).drop(columns="payload")

    cores, sections = _slide_cores(spark, d)
    return slides.build(cores, sections, _slide(spark)).mapInPandas(unpacked, "core_id string, z int, tx int, ty int, w int, h int, bytes long")


@query("j18_tile_pixels", "select s_suppkey as id, case when x < 3000 and y < 2400 then (x*3)%256 else 255 end::int as r, case when x < 3000 and y < 2400 then (y*5)%256 else 255 end::int as g, case when x < 3000 and y < 2400 then (x+y)%256 else 255 end::int as b from (select s_suppkey, (s_suppkey*977)%3200 as x, (s_suppkey*613)%2500 as y from supplier)")
def j18(spark, d):
    """Pixels of an image at given places, by an equi join with its tiles."""
    p = warehouse.read(spark, d, "supplier", "s_suppkey").selectExpr("s_suppkey as id", "(s_suppkey*977)%3200 as x", "(s_suppkey*613)%2500 as y")
    return slides.pixel_at(_slide(spark).where("level = 0"), p)


@query("i14_tile_disks", _PIX + f", p as (select s_suppkey as id, (s_suppkey*17)%190 - 15 as u, (s_suppkey*5)%150 - 15 as v from supplier) select id, round(sum(case when px.x is null then 0 else {_H} end)/29.0e0,6) as v from p cross join range(-3,4) a(dx) cross join range(-3,4) b(dy) left join px on px.x = u+dx and px.y = v+dy where dx*dx+dy*dy <= 9 group by 1")
def i14t(spark, d):
    """Mean stain in disks, read from tiles; white outside."""
    p = warehouse.read(spark, d, "supplier", "s_suppkey").selectExpr("s_suppkey as id", "(s_suppkey*17)%190 - 15 as u", "(s_suppkey*5)%150 - 15 as w")
    return slides.disk_stain(p, slides.cut_tiles(_pixels(spark), "small"), 3).withColumn("v", F.round("v", 6))


_U = "(('0x' || substr(md5('{s}:' || {k}),1,13))::bigint / 4503599627370496.0e0)"


@query("g15_random_points", f"select i as id, round(100 + 400*{_U.format(s='gx', k='i')},6) as x_um, round(50 + 200*{_U.format(s='gy', k='i')},6) as y_um from (select row_number() over (order by c_custkey) - 1 as i from customer)")
def g15(spark, d):
    """A random point for each customer."""
    p = align.random_points(spark, warehouse.read(spark, d, "customer", "c_custkey").count(), (100.0, 50.0, 500.0, 250.0), "g")
    return p.select("id", F.round("x_um", 6).alias("x_um"), F.round("y_um", 6).alias("y_um"))


@query("g15_tissue_points", _IMG + f", m as (select x//10 as u, y//10 as v from px group by 1,2 having sum(r+g+b)/(3.0e0*count(*)) < 127), z as (select max(y)+1 as h from px), p as (select i as id, 160*{_U.format(s='tx', k='i')} as x, h*{_U.format(s='ty', k='i')} as y from z, range(200) t(i)) select id from p where (floor((x+0.5e0)/10), floor((y+0.5e0)/10)) in (select (u::double, v::double) from m) order by id limit 50")
def g15t(spark, d):
    """Points accepted by a mask of the darker half of the orders' image."""
    image = _image(spark, d)
    mask = raster.tissue(image, 10).select("u", "v", (F.col("gray") < 127).alias("tissue"))
    one = F.array(*[F.lit(float(v)) for v in (1, 0, 0, 0, 1, 0, 0, 0, 1)])
    height = float(image.agg(F.max("y") + 1).first()[0])
    return align.accepted(spark, 50, (0.0, 0.0, 160.0, height), "t", lambda p: align.in_mask(p, mask, one, 10)).select("id")


@query("g16_shifted", canon("cells") + f"select cell_id as id, round(x_um + 25*cos(2*pi()*{_U.format(s='s', k='cell_id')}),4) as x_um, round(y_um + 25*sin(2*pi()*{_U.format(s='s', k='cell_id')}),4) as y_um from cells")
def g16(spark, d):
    p = align.shifted(warehouse.cells(spark, d).select(F.col("cell_id").alias("id"), "x_um", "y_um"), "s")
    return p.select("id", F.round("x_um", 4).alias("x_um"), F.round("y_um", 4).alias("y_um"))


@query("o7_sampled_cells", canon("cells") + f"select cell_id as id from cells order by {_U.format(s='cells', k='cell_id')}, cell_id limit 1000")
def o7(spark, d):
    return align.sample_cells(warehouse.cells(spark, d)).select("id")
