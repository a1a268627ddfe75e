"""Layout queries: order, codes, ranges and errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordering
from ..sources import warehouse
from .registry import canon, query

_EMB = ", f as (select min(umap_x)::double as xl, max(umap_x)::double as xh, min(umap_y)::double as yl, max(umap_y)::double as yh from cells where has_umap) "
_CODE = "case when has_umap then least(greatest(round_even(({c}::double-{l})/(greatest({h}-{l},1e-9)/65534),0),0),65535)::int else 65535 end"
_UX, _UY = _CODE.format(c="umap_x", l="xl", h="xh"), _CODE.format(c="umap_y", l="yl", h="yh")


@query("o1_cell_order", canon("placed") + "select cell_id, morton, idx from placed")
def o1(spark, d):
    return ordering.placed(warehouse.load(spark, d)).select("cell_id", "morton", "idx")


@query("f6_embedding_codes", canon("cells") + _EMB + f"select cell_id, {_UX} as ux, {_UY} as uy from cells, f")
def f6(spark, d):
    return ordering.embedding_codes(warehouse.cells(spark, d))


@query("f7_spatial_codes", canon("coded") + "select cell_id, qx, qy from coded")
def f7(spark, d):
    return ordering.placed(warehouse.load(spark, d)).select("cell_id", "qx", "qy")


@query("a8_quantisation_errors", canon("coded") + "select section_id, round(max(greatest(abs(q_offset+qx*q_scale-x_um),abs(q_offset+qy*q_scale-y_um))),6) as max_err from coded group by 1")
def a8(spark, d):
    return ordering.quantisation_errors(warehouse.load(spark, d)).withColumn("max_err", F.round("max_err", 6))


@query("v31_embedding_error", canon("cells") + _EMB + f""", e as (select umap_x::double as x, umap_y::double as y, {_UX} as ux, {_UY} as uy, xl, xh, yl, yh from cells, f where has_umap)
select round(max(greatest(abs(xl + ux*(greatest(xh-xl,1e-9)/65534) - x)/greatest(xh-xl,1e-9), abs(yl + uy*(greatest(yh-yl,1e-9)/65534) - y)/greatest(yh-yl,1e-9))), 9) as share from e""")
def v31(spark, d):
    """Largest error of a decoded embedding coordinate, as a share of its range."""
    return ordering.embedding_error(warehouse.cells(spark, d)).withColumn("share", F.round("share", 9))


@query("a19_core_ranges", canon("placed") + 'select core_id, min(idx) as first, max(idx)+1 as "end", max(idx)+1-min(idx) = count(*) as contiguous from placed group by 1')
def a19(spark, d):
    return ordering.core_ranges(ordering.placed(warehouse.load(spark, d)))


@query("a21_section_quantisers", canon("quant") + "select section_id, q_offset, round(q_scale,12) as q_scale from quant")
def a21(spark, d):
    return ordering.section_quantisers(warehouse.sections(spark, d)).withColumn("q_scale", F.round("q_scale", 12))


@query("f11_clipped", "select o_orderkey, least(floor(o_totalprice)::bigint, 65535) as n, floor(o_totalprice) > 65535 as clipped from orders")
def f11(spark, d):
    p = F.floor("o_totalprice")
    return warehouse.read(spark, d, "orders", "o_orderkey", "o_totalprice").select("o_orderkey", F.least(p, F.lit(65535).cast("long")).alias("n"), (p > 65535).alias("clipped"))


@query("k6_typed_columns", canon("placed", "clusters", "cores") + _EMB + f""", k as (select core_id, row_number() over (order by section_id, core_id) - 1 as core from cores)
select idx, qx, qy, {_UX} as ux, {_UY} as uy, "order"::int as cluster, core::int as core, least(p.n_transcripts,65535) as ntx from placed p join clusters using (cluster_id) join k using (core_id), f""")
def k6(spark, d):
    return ordering.typed_columns(warehouse.load(spark, d)).withColumn("core", F.col("core").cast("int"))


@query("k6_bytes_hash", canon("placed") + "select core_id, sha256(unhex(string_agg(printf('%02x%02x%02x%02x', qx%256, qx//256, qy%256, qy//256), '' order by idx))) as sha256 from placed group by 1")
def k6b(spark, d):
    """Little-endian coordinate bytes of each core, hashed: a core's bytes are one value."""
    from ..functions.codec import u16_hex

    p = ordering.placed(warehouse.load(spark, d)).select("core_id", "idx", F.concat(u16_hex(F.col("qx")), u16_hex(F.col("qy"))).alias("h"))
    hexes = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "h"))), lambda x: x["h"]), "")
    return p.groupBy("core_id").agg(F.sha2(F.unhex(hexes), 256).alias("sha256"))
