"""The interactive surface: search, colour, selection, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import color
from ..operators import lookup, spatial
from ..sources import warehouse
from ..staging import staged
from .registry import canon, query


def search(genes: DataFrame, prefix: str, n: int = 10) -> DataFrame:
    """(symbol, rank): symbols that begin with the prefix, case ignored, exact ones first; if there is none, the closest."""
    p = prefix.lower()
    s = F.lower("symbol")
    close = F.levenshtein(s, F.lit(p))
    found = genes.withColumn("hit", F.startswith(s, F.lit(p)))
    any_ = found.agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("any"))
    best = found.crossJoin(F.broadcast(any_)).where("hit or not any")  # one row
    best = best.withColumn("key", F.when(F.col("hit"), F.when(s == p, 0).otherwise(1)).otherwise(close))
    return best.orderBy("key", s, "symbol", "gene_id").limit(n).select("gene_id", "symbol", "key")


def url_state(c: Column) -> Column:
    """Known parameters of a version-1 state url as a map; others are ignored."""
    pairs = F.split(F.parse_url(c, F.lit("QUERY")), "&")
    kept = F.filter(pairs, lambda p: F.substring_index(p, "=", 1).isin("v", "ds", "color", "gene", "core", "hide") & F.contains(p, F.lit("=")))
    return F.map_from_entries(F.transform(F.array_distinct(kept), lambda p: F.struct(F.substring_index(p, "=", 1), F.url_decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))))))


@query("q1_search", canon("genes") + "select gene_id, symbol, case when lower(symbol)='small part 1' then 0 else 1 end as key from genes where starts_with(lower(symbol), 's') order by key, lower(symbol), symbol, gene_id limit 10")
def q1(spark, d):
    return search(warehouse.genes(spark, d), "S")


@query("q1_closest", canon("genes") + "select gene_id, symbol, levenshtein(lower(symbol),'zzqx') as key from genes order by key, lower(symbol), symbol, gene_id limit 10")
def q1b(spark, d):
    return search(warehouse.genes(spark, d), "zzqx").withColumn("key", F.col("key").cast("long"))


@query("q1_closest_many", canon("genes") + """, k as (select distinct lower(symbol) as known from genes), p as (select distinct p_name as s from part union all select 'G' || p_partkey from part where p_size > 40),
 w as (select distinct lower(substr(s,1,2) || substr(s,4) || case when length(s) % 2 = 0 then 'q' else '' end) as wanted from p)
 select wanted, known, distance, rank from (select *, row_number() over (partition by wanted order by distance, known) as rank from (select wanted, known, levenshtein(wanted, known) as distance from w, k)) where rank <= 3""")
def q1c(spark, d):
    """The three closest symbols of every part's name with one or two errors, and of some names unlike any symbol."""
    part = warehouse.read(spark, d, "part")
    names = part.select(F.col("p_name").alias("s")).unionByName(part.where("p_size > 40").select(F.concat(F.lit("G"), "p_partkey").alias("s")))
    wrong = names.selectExpr("substr(s,1,2) || substr(s,4) || case when length(s) % 2 = 0 then 'q' else '' end as wanted")
    known = staged(lookup.distinct(warehouse.genes(spark, d)), "closest-names")
    found = lookup.closest(lookup.index(known, "known"), wrong, 3, known=known)
    return found.select("wanted", "known", F.col("distance").cast("long"), F.col("rank").cast("long"))


@query("q2_color_by", canon("cells", "clusters", "expression") + "select cell_id, color, patient_id, core_id, coalesce(count,0)::int as gene_count from cells join clusters using (cluster_id) left join (select * from expression where gene_id='G7') using (cell_id)")
def q2(spark, d):
    ds = warehouse.load(spark, d)
    g = ds.expression.where("gene_id = 'G7'").select("cell_id", F.col("count").alias("g"))
    return ds.cells.join(ds.clusters.select("cluster_id", "color"), "cluster_id").join(g, "cell_id", "left").select("cell_id", "color", "patient_id", "core_id", F.coalesce("g", F.lit(0)).alias("gene_count"))


@query("q3_isolate", canon("cells") + "select cell_id from cells where cluster_id not in ('2-high','5-low')")
def q3(spark, d):
    return warehouse.cells(spark, d).where(~F.col("cluster_id").isin("2-high", "5-low")).select("cell_id")


_LASSO = [(1.5, 0.2), (4.8, 0.1), (5.5, 0.6), (3.0, 0.9), (2.0, 0.55)]


def _inside(x: str, y: str) -> str:
    cross = [f"((({y1}e0 > {y}) <> ({y2}e0 > {y})) and {x} < ({x2}e0-{x1}e0)*({y}-{y1}e0)/({y2}e0-{y1}e0)+{x1}e0)::int" for (x1, y1), (x2, y2) in zip(_LASSO, _LASSO[1:] + _LASSO[:1])]
    return f"({' + '.join(cross)}) % 2 = 1"


@query("q4_lasso", canon("cells") + f"select cell_id from cells where has_umap and {_inside('umap_x::double', 'umap_y::double')}")
def q4(spark, d):
    return warehouse.cells(spark, d).where("has_umap").where(spatial.in_polygon(F.col("umap_x").cast("double"), F.col("umap_y").cast("double"), _LASSO)).select("cell_id")


@query("q5_linked_selection", canon("cells") + "select cluster_id, count(*) as n from cells where patient_id = 'P03' or core_id = 'C010' group by 1")
def q5(spark, d):
    return warehouse.cells(spark, d).where("patient_id = 'P03' or core_id = 'C010'").groupBy("cluster_id").agg(F.count("*").alias("n"))


@query("q6_hover", canon("cells", "clusters", "expression") + "select cell_id, label, patient_id, core_id, n_transcripts, count from cells join clusters using (cluster_id) join expression using (cell_id) where cell_id = '1003'")
def q6(spark, d):
    ds = warehouse.load(spark, d)
    return ds.cells.where("cell_id = '1003'").join(ds.clusters, "cluster_id").join(ds.expression.where("cell_id = '1003'"), "cell_id").select("cell_id", "label", "patient_id", "core_id", "n_transcripts", "count")


@query("q7_patient_cores", canon("cores") + "select core_id, section_id from cores where patient_id = 'P02'")
def q7(spark, d):
    return warehouse.cores(spark, d).where("patient_id = 'P02'").select("core_id", "section_id")


@query("q8_visible", canon("cells") + "select count_if(has_umap)::bigint as visible, count_if(not has_umap)::bigint as without from cells")
def q8(spark, d):
    return warehouse.cells(spark, d).agg(F.count_if("has_umap").alias("visible"), F.count_if(~F.col("has_umap")).alias("without"))


@query("q9_url_state", "select event_id, '1' as v, event_type as color, 'C0' || (event_id%10) as core from events")
def q9(spark, d):
    u = F.concat(F.lit("https://x.test/app?v=1&utm=3&color="), "event_type", F.lit("&core=C0"), (F.col("event_id") % 10).cast("string"), F.lit("&bad"))
    return warehouse.read(spark, d, "events", "event_id", "event_type").withColumn("m", url_state(u)).select("event_id", F.col("m")["v"].alias("v"), F.col("m")["color"].alias("color"), F.col("m")["core"].alias("core"))


@query("q12_core_slice", canon("placed") + "select cell_id, idx from placed where idx between (select min(idx) from placed where core_id='C007') and (select max(idx) from placed where core_id='C007')")
def q12(spark, d):
    from ..operators import ordering

    p = ordering.placed(warehouse.load(spark, d)).select("cell_id", "idx", "core_id")
    r = ordering.core_ranges(p).where("core_id = 'C007'").select("first", "end")
    return p.join(F.broadcast(r), F.col("idx").between(F.col("first"), F.col("end") - 1)).select("cell_id", "idx")  # one row


def _palette_sql() -> str:
    row = lambda m, c: "(" + " + ".join(f"({v!r}::double) * {x}" for v, x in zip(m, c)) + ")"
    lin = lambda at: f"case when ('0x' || substr(color, {at}, 2))::int / 255.0e0 <= 0.04045e0 then ('0x' || substr(color, {at}, 2))::int / 255.0e0 / 12.92e0 else (((('0x' || substr(color, {at}, 2))::int / 255.0e0) + 0.055e0) / 1.055e0) ** 2.4e0 end"
    seen = " union all ".join(f"select '{n}' as vision, id, " + ", ".join(f"greatest(0e0, least(1e0, {row(m, ('r', 'g', 'b'))})) as {c}" for m, c in zip(matrix, "rgb")) + " from p" for n, matrix in color.VISION.items())
    f = lambda m, w: f"case when {row(m, 'rgb')} / {w!r}::double > 216e0 / 24389 then ({row(m, 'rgb')} / {w!r}::double) ** (1e0 / 3) else (24389e0 / 27 * {row(m, 'rgb')} / {w!r}::double + 16) / 116 end"
    return f"""
with p as (select cluster_id as id, {lin(2)} as r, {lin(4)} as g, {lin(6)} as b from (select distinct p_brand as cluster_id, '#' || upper(substr(md5(p_brand), 1, 6)) as color from part)),
 v as ({seen}), x as (select vision, id, {", ".join(f"{f(m, w)} as f{i}" for i, (m, w) in enumerate(zip(color.TO_XYZ, color.WHITE)))} from v),
 l as (select vision, id, 116*f1-16 as l, 500*(f0-f1) as a, 200*(f1-f2) as b from x),
 j as (select p.vision, p.id as i1, q.id as i2, p.l as l1, q.l as l2, p.a as a1, q.a as a2, p.b as b1, q.b as b2, (sqrt(p.a**2+p.b**2)+sqrt(q.a**2+q.b**2))/2 as m from l p join l q on p.vision = q.vision and p.id < q.id),
 k as (select *, a1*(1.5e0-0.5e0*sqrt(m**7/(m**7+25e0**7))) as x1, a2*(1.5e0-0.5e0*sqrt(m**7/(m**7+25e0**7))) as x2 from j),
 c as (select *, sqrt(x1**2+b1**2) as c1, sqrt(x2**2+b2**2) as c2, case when degrees(atan2(b1,x1)) < 0 then degrees(atan2(b1,x1))+360 else degrees(atan2(b1,x1)) end as h1, case when degrees(atan2(b2,x2)) < 0 then degrees(atan2(b2,x2))+360 else degrees(atan2(b2,x2)) end as h2 from k),
 h as (select *, case when c1*c2=0 then 0 when h2-h1 > 180 then h2-h1-360 when h2-h1 < -180 then h2-h1+360 else h2-h1 end as dh, case when c1*c2=0 then h1+h2 when abs(h2-h1) <= 180 then (h1+h2)/2 when h1+h2 < 360 then (h1+h2)/2+180 else (h1+h2)/2-180 end as hm, (l1+l2)/2 as lm, (c1+c2)/2 as cm from c),
 t as (select *, 1-0.17e0*cos(radians(hm-30))+0.24e0*cos(radians(2*hm))+0.32e0*cos(radians(3*hm+6))-0.20e0*cos(radians(4*hm-63)) as t from h),
 s as (select *, (l2-l1)/(1+0.015e0*(lm-50)**2/sqrt(20+(lm-50)**2)) as u, (c2-c1)/(1+0.045e0*cm) as w, 2*sqrt(c1*c2)*sin(radians(dh/2))/(1+0.015e0*cm*t) as z, -2*sqrt(cm**7/(cm**7+25e0**7))*sin(radians(60*exp(-(((hm-275)/25)**2)))) as rt from t)
select vision, i1 as a, i2 as b, round(sqrt(u**2+w**2+z**2+rt*w*z), 6) as distance from s"""


@query("q11_palette", _palette_sql())
def q11(spark, d):
    """Differences of the colours of a palette, as normal and two kinds of deficient colour vision see them."""
    p = warehouse.read(spark, d, "part", "p_brand").distinct().select(F.col("p_brand").alias("id"), F.concat(F.lit("#"), F.upper(F.substring(F.md5(F.col("p_brand").cast("binary")), 1, 6))).alias("color"))
    return color.palette_distances(p).withColumn("distance", F.round("distance", 6))
