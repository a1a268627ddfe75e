"""Scans, parsers, projections and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import affine, text
from ..operators import integrity
from ..sources import files, warehouse
from .registry import canon, query


@query("s1_scan_columns", "select o_orderkey, o_totalprice, o_orderdate::date as day from orders where o_totalprice > 300000")
def s1(spark, d):
    return files.parquet_columns(spark, f"{d}/orders.parquet", "o_orderkey", "o_totalprice", "o_orderdate").where("o_totalprice > 300000").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))


for _name, _cols in {
    "cells": "cell_id, section_id, core_id, patient_id, round(x_um,6) as x_um, round(y_um,6) as y_um, has_umap, cluster_id, n_transcripts",
    "genes": "gene_id, symbol, panel",
    "clusters": 'cluster_id, label, color, "order", n_cells',
    "cores": "core_id, section_id, patient_id, kind, center_x_um, center_y_um, radius_um, bbox_x0, bbox_y0, bbox_x1, bbox_y1",
    "sections": "section_id, pixel_size, bounds_x0, bounds_y0, bounds_x1, bounds_y1",
    "expression": "cell_id, gene_id, count",
}.items():

    def _canonical(spark, d, name=_name, cols=_cols):
        df = getattr(warehouse, name)(spark, d)
        return df.selectExpr(*[c.replace(";", ",").strip() for c in cols.replace('"', "`").replace("um,6)", "um;6)").split(",")])

    query(f"s10_{_name}", canon(_name) + f"select {_cols} from {_name}")(_canonical)


@query("s5_compressed_to_long", """
with r as (select l_orderkey % 64 as major, l_partkey % 50 as minor, sum(l_quantity)::bigint as v from lineitem group by 1, 2)
select major::int as major, minor, v as value from r""")
def s5(spark, d):
    """A compressed matrix is made, in slices of eight majors, and taken apart again."""
    li = warehouse.read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    coo = li.groupBy((F.col("l_orderkey") % 64).alias("major"), (F.col("l_partkey") % 50).alias("minor")).agg(F.sum("l_quantity").cast("long").alias("v"))
    return files.coo_from_compressed(files.compressed_slices(coo, spark.range(64).withColumnRenamed("id", "major"), 8))


@query("s7_json_paths", "select event_id, (props->>'$.k')::bigint as k from events")
def s7(spark, d):
    return warehouse.read(spark, d, "events", "event_id", "props").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("s8_json_panel", """select 'G' || p_partkey as gene_id, case when p_brand like 'Brand#1%' then 'base' else 'addon' end as category from part where p_partkey % 3 <> 0""")
def s8(spark, d):
    """A nested panel document is parsed, exploded and filtered."""
    p = warehouse.read(spark, d, "part", "p_partkey", "p_brand")
    target = F.to_json(F.struct(F.struct(F.struct(F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("G"), F.col("p_partkey").cast("string"))).alias("id")).alias("data"), F.when(F.col("p_partkey") % 3 == 1, "gene").otherwise("gene").alias("descriptor")).alias("type"), F.struct(F.when(F.col("p_brand").startswith("Brand#1"), "base").otherwise("addon").alias("category")).alias("source")))
    docs = p.select(F.concat(F.lit('{"payload":{"targets":['), target, F.lit("]}}")).alias("j"))
    schema = "payload struct<targets:array<struct<type:struct<descriptor:string,data:struct<id:string>>,source:struct<category:string>>>>"
    return files.panel_genes(docs.select(F.from_json("j", schema).alias("x")).select("x.payload"))


@query("s18_members", "select p_name as name, (p_size / 10.0e0) as mb from part")
def s18a(spark, d):
    lines = warehouse.read(spark, d, "part", "p_name", "p_size").select(F.concat(F.format_string("%.1f", F.col("p_size") / 10.0), F.lit(" MB  "), "p_name").alias("value"))
    return files.members(lines)


@query("s18_md5_list", "select s_name as name, md5(s_name) as md5 from supplier")
def s18b(spark, d):
    return files.md5_list(warehouse.read(spark, d, "supplier", "s_name").select(F.concat(F.upper(F.md5(F.col("s_name").cast("binary"))), F.lit("  "), "s_name").alias("value")))


@query("s18_settings", "select 'K' || n_nationkey as key, n_name as value from nation where n_nationkey % 4 <> 3")
def s18c(spark, d):
    n = warehouse.read(spark, d, "nation", "n_nationkey", "n_name")
    k = F.concat(F.lit("K"), F.col("n_nationkey").cast("string"))
    line = F.when(F.col("n_nationkey") % 4 == 0, F.concat(k, F.lit("="), "n_name")).when(F.col("n_nationkey") % 4 == 1, F.concat(F.lit("export "), k, F.lit('="'), F.col("n_name"), F.lit('"'))).when(F.col("n_nationkey") % 4 == 2, F.concat(F.lit("  "), k, F.lit(" = '"), F.col("n_name"), F.lit("'"))).otherwise(F.concat(F.lit("# "), k, F.lit("="), "n_name"))
    return files.settings(n.select(line.alias("value")))


@query("s20_transpose", canon("expression") + "select gene_id as row_id, cell_id as col_id, count from expression")
def s20(spark, d):
    return warehouse.expression(spark, d).select(F.col("gene_id").alias("row_id"), F.col("cell_id").alias("col_id"), "count")


@query("k2_records", canon("cells") + """select '{"cell_id":"' || cell_id || '","n_transcripts":' || n_transcripts || ',"umap_y":' || case when has_umap then (floor(umap_y::double*10)/10)::varchar else 'null' end || '}' as json from cells""")
def k2(spark, d):
    c = warehouse.cells(spark, d).select("cell_id", "n_transcripts", (F.floor(F.col("umap_y").cast("double") * 10) / 10).alias("umap_y"), "has_umap")
    return files.records(c.select("cell_id", "n_transcripts", F.when(F.col("has_umap"), F.col("umap_y")).otherwise(float("nan")).alias("umap_y")))


@query("p1_filter_counted", "select count(*) filter (where event_type = 'click') as kept, count(*) filter (where event_type is distinct from 'click') as dropped from events")
def p1(spark, d):
    return warehouse.read(spark, d, "events", "event_type").agg(F.count_if(F.coalesce(F.col("event_type") == "click", F.lit(False))).alias("kept"), F.count_if(~F.coalesce(F.col("event_type") == "click", F.lit(False))).alias("dropped"))


@query("p2_equality", canon("cells") + "select cell_id, core_id from cells where section_id = 'S2'")
def p2(spark, d):
    return warehouse.cells(spark, d).where("section_id = 'S2'").select("cell_id", "core_id")


@query("p3_not_unassigned", canon("cells", "clusters") + "select cluster_id, label from clusters where lower(label) <> 'unassigned' and lower(label) <> '5-low'")
def p3(spark, d):
    return warehouse.clusters(spark, d).where((F.lower("label") != "unassigned") & (F.lower("label") != "5-low")).select("cluster_id", "label")


@query("p4_fill_unassigned", canon("cells") + "select cell_id, case when has_umap then cluster_id else 'unassigned' end as grp, n_transcripts = 0 or has_umap as allowed from cells")
def p4(spark, d):
    cells = warehouse.cells(spark, d)
    groups = cells.where("has_umap").select("cell_id", F.col("cluster_id").alias("g"))
    j = cells.join(groups, "cell_id", "left")
    return j.select("cell_id", F.coalesce("g", F.lit("unassigned")).alias("grp"), (F.col("g").isNotNull() | (F.col("n_transcripts") == 0)).alias("allowed"))


@query("p7_panel", "select p_partkey, case when p_type like '%BRASS' then 'predesigned' else 'custom' end as panel from part")
def p7(spark, d):
    return warehouse.read(spark, d, "part", "p_partkey", "p_type").select("p_partkey", F.when(F.col("p_type").like("%BRASS"), "predesigned").otherwise("custom").alias("panel"))


@query("p8_finite", canon("cells") + "select cell_id, isfinite(umap_x) and isfinite(umap_y) as has from cells")
def p8(spark, d):
    from ..operators.validation import finite

    return warehouse.cells(spark, d).select("cell_id", (finite(F.col("umap_x")) & finite(F.col("umap_y"))).alias("has"))


@query("p9_box", canon("cells") + "select cell_id from cells where x_um between 1500 and 3000 and y_um between 1200 and 2000")
def p9(spark, d):
    return warehouse.cells(spark, d).where(F.col("x_um").between(1500, 3000) & F.col("y_um").between(1200, 2000)).select("cell_id")


@query("p11_forbidden", r"""
with p as (select s_suppkey, 'raw/' || case s_suppkey % 5 when 0 then 'transcripts.parquet' when 1 then 'morphology_focus/0.tif' when 2 then 'cells.zarr.zip' when 3 then 'cells.parquet' else 'a/b/mytranscripts.csv' end as path from supplier)
select s_suppkey, path, len(list_filter(string_split(path,'/'), lambda x: x like 'transcripts.%' or x like 'morphology%' or x like '%.zarr.zip')) > 0 as forbidden from p""")
def p11(spark, d):
    s = warehouse.read(spark, d, "supplier", "s_suppkey")
    names = F.array(*map(F.lit, ("transcripts.parquet", "morphology_focus/0.tif", "cells.zarr.zip", "cells.parquet", "a/b/mytranscripts.csv")))
    p = s.withColumn("path", F.concat(F.lit("raw/"), F.get(names, (F.col("s_suppkey") % 5).cast("int"))))
    return p.withColumn("forbidden", text.forbidden(F.col("path")))


@query("p12_in_list", "select c_custkey from customer where c_mktsegment in ('BUILDING','MACHINERY')")
def p12(spark, d):
    return warehouse.read(spark, d, "customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")


@query("p13_regex", canon("cores") + r"select core_id, regexp_matches(patient_id, '^P\d{2,}$') as good, regexp_matches(core_id, '^C0[01]\d$') as low from cores")
def p13(spark, d):
    return warehouse.cores(spark, d).select("core_id", F.col("patient_id").rlike(r"^P\d{2,}$").alias("good"), F.col("core_id").rlike(r"^C0[01]\d$").alias("low"))


@query("p14_near_size", "select o_orderkey, abs(o_totalprice*100/1e6 - round_even(o_totalprice*100/1e6*10,0)/10) <= 0.05e0+1e-9 as ok from orders")
def p14(spark, d):
    b = F.col("o_totalprice") * 100
    return warehouse.read(spark, d, "orders", "o_orderkey", "o_totalprice").select("o_orderkey", integrity.size_matches(b, F.rint(b / 1e6 * 10) / 10).alias("ok"))


@query("f1_slug", r"select distinct p_type, trim(regexp_replace(lower(p_type || ' (β+)!'),'[^\p{L}\p{N}]+','-','g'),'-') as slug from part")
def f1(spark, d):
    return warehouse.read(spark, d, "part", "p_type").distinct().select("p_type", text.slug(F.concat("p_type", F.lit(" (β+)!"))).alias("slug"))


@query("f12_identifiers", "select s_suppkey, 'C' || case when s_suppkey < 1000 then lpad(s_suppkey::varchar,3,'0') else s_suppkey::varchar end as core, 'P' || case when s_suppkey < 100 then lpad(s_suppkey::varchar,2,'0') else s_suppkey::varchar end as patient from supplier")
def f12(spark, d):
    return warehouse.read(spark, d, "supplier", "s_suppkey").select("s_suppkey", text.padded("C", F.col("s_suppkey"), 3).alias("core"), text.padded("P", F.col("s_suppkey"), 2).alias("patient"))


@query("f13_replicas", "select p_partkey, p_name || case when p_size % 4 > 0 then '-r' || (p_size % 4) else '' end as name from part")
def f13(spark, d):
    return warehouse.read(spark, d, "part", "p_partkey", "p_name", "p_size").select("p_partkey", text.replica(F.col("p_name"), F.col("p_size") % 4).alias("name"))


@query("f14_shade", r"""
with c as (select p_partkey, '#' || upper(printf('%06x', (p_partkey*7919) % 16777216)) as color from part)
select p_partkey, color, '#' || upper(printf('%02x%02x%02x', floor(('0x'||substr(color,2,2))::int*0.55e0)::int, floor(('0x'||substr(color,4,2))::int*0.55e0)::int, floor(('0x'||substr(color,6,2))::int*0.55e0)::int)) as dark from c""")
def f14(spark, d):
    c = warehouse.read(spark, d, "part", "p_partkey").withColumn("color", F.concat(F.lit("#"), F.lpad(F.hex((F.col("p_partkey") * 7919) % 16777216), 6, "0")))
    return c.withColumn("dark", text.shade(F.col("color")))


@query("f17_hashes", "select doc_id, sha256(coalesce(text,'')) as sha, md5(coalesce(text,'')) as md5, substr(sha256(coalesce(text,'')),1,12) as short from documents")
def f17(spark, d):
    t = F.coalesce("text", F.lit("")).cast("binary")
    return warehouse.read(spark, d, "documents", "doc_id", "text").select("doc_id", F.sha2(t, 256).alias("sha"), F.md5(t).alias("md5"), F.substring(F.sha2(t, 256), 1, 12).alias("short"))


@query("f19_math", """select l_orderkey, l_linenumber, round_even(l_extendedprice/7,0) as r, floor(l_tax*50)::bigint as f, ceil(l_tax*50)::bigint as c,
  round(sqrt(l_extendedprice),6) as s, round(log2(l_quantity+1),6) as l2, round(cos(l_quantity)+sin(l_tax),6) as cs, round(sqrt(l_quantity*l_quantity+l_tax*l_tax),6) as h, isfinite(l_tax) as fin from lineitem""")
def f19(spark, d):
    from ..operators.validation import finite

    c = F.col
    return warehouse.read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_tax", "l_quantity").select(
        "l_orderkey", "l_linenumber", F.rint(c("l_extendedprice") / 7).alias("r"), F.floor(c("l_tax") * 50).alias("f"), F.ceil(c("l_tax") * 50).alias("c"), F.round(F.sqrt("l_extendedprice"), 6).alias("s"),
        F.round(F.log2(c("l_quantity") + 1), 6).alias("l2"), F.round(F.cos("l_quantity") + F.sin("l_tax"), 6).alias("cs"), F.round(F.hypot("l_quantity", "l_tax"), 6).alias("h"), finite(c("l_tax")).alias("fin"))


@query("f23_grid_slots", "select n_nationkey, n_nationkey % 5 as section, n_nationkey // 5 as slot, (n_nationkey // 5) % 3 as gx, (n_nationkey // 5) // 3 as gy from nation")
def f23(spark, d):
    return warehouse.read(spark, d, "nation", "n_nationkey").selectExpr("n_nationkey", "n_nationkey % 5 as section", "cast(n_nationkey div 5 as int) as slot", "cast((n_nationkey div 5) % 3 as int) as gx", "cast((n_nationkey div 5) div 3 as int) as gy")


@query("f25_manifest_guard", """
with m as (select event_id, case event_id % 4 when 0 then '{"schema_version":1,"dataset":{"name":"a"},"files":{}}' when 1 then '{"schema_version":2,"dataset":{"name":"a"},"files":{}}'
  when 2 then '{"schema_version":1,"dataset":{},"files":{}}' else '{"schema_version":1,"dataset":{"name":"a"},"files":3}' end as t from events)
select event_id, event_id % 4 = 0 as ok from m""")
def f25(spark, d):
    texts = ['{"schema_version":1,"dataset":{"name":"a"},"files":{}}', '{"schema_version":2,"dataset":{"name":"a"},"files":{}}', '{"schema_version":1,"dataset":{},"files":{}}', '{"schema_version":1,"dataset":{"name":"a"},"files":3}']
    e = warehouse.read(spark, d, "events", "event_id").withColumn("t", F.get(F.array(*map(F.lit, texts)), (F.col("event_id") % 4).cast("int")))
    return e.select("event_id", integrity.manifest_ok(F.col("t")).alias("ok"))


_A = "select s_suppkey as id, 1.0e0 + s_suppkey/100.0e0 as a, 0.01e0*s_suppkey as b, 5.0e0 + s_suppkey as c, -0.02e0*s_suppkey as d, 0.9e0 as e, 7.0e0 - s_suppkey as f from supplier"


@query("g1_um_to_pixel", f"""
with m as ({_A}), i as (select *, a*e-b*d as det from m)
select id, round(e/det/0.2125e0,6) as m0, round(-b/det/0.2125e0,6)+0 as m1, round((b*f-c*e)/det,6) as m2, round(-d/det/0.2125e0,6)+0 as m3, round(a/det/0.2125e0,6) as m4, round((c*d-a*f)/det,6) as m5, round(sqrt(abs(det))*0.2125e0,6) as px,
  round(e/det/0.2125e0*10 - b/det/0.2125e0*20 + (b*f-c*e)/det,6) as x, round(-d/det/0.2125e0*10 + a/det/0.2125e0*20 + (c*d-a*f)/det,6) as y from i""")
def g1(spark, d):
    s = F.col("s_suppkey")
    m = warehouse.read(spark, d, "supplier", "s_suppkey").withColumn("m", F.array(1.0 + s / 100.0, 0.01 * s, 5.0 + s, -0.02 * s, F.lit(0.9), 7.0 - s, F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    u = affine.um_to_pixel(F.col("m"), F.lit(0.2125))
    m = m.withColumn("u", u)
    return m.select(s.alias("id"), *[(F.round(F.col("u")[i], 6) + 0.0).alias(f"m{i}") for i in range(6)], F.round(affine.pixel_um(F.col("m"), F.lit(0.2125)), 6).alias("px"), F.round(affine.apply_x(F.col("u"), F.lit(10.0), F.lit(20.0)), 6).alias("x"), F.round(affine.apply_y(F.col("u"), F.lit(10.0), F.lit(20.0)), 6).alias("y"))
