"""Lookups, aggregates, ranks and set operations on the canonical tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import selection, spatial, stats, validation
from ..sources import warehouse
from .registry import canon, query


def _cells(spark, d, *cols):
    c = warehouse.cells(spark, d)
    return c.select(*cols) if cols else c


@query("j1_missing_keys", canon("cells", "cores", "clusters", "sections") + """
select 'core' as key, count(*) as n from cells c where core_id <> 'C003' and not exists (select 1 from cores k where k.core_id = c.core_id and k.core_id < 'C020')
  and core_id <> 'C003' union all select 'cluster', count(*) from cells where cluster_id not in (select cluster_id from clusters where "order" < 3)
union all select 'section', count(*) from cores where section_id not in (select section_id from sections where section_id <> 'S4')""")
def j1(spark, d):
    cells = _cells(spark, d, "core_id", "cluster_id")
    cores, clusters, sections = warehouse.cores(spark, d), warehouse.clusters(spark, d), warehouse.sections(spark, d)
    n = lambda df, k: df.agg(F.lit(k).alias("key"), F.count("*").alias("n"))
    a = n(cells.where("core_id <> 'C003'").join(cores.where("core_id < 'C020'"), "core_id", "left_anti"), "core")
    b = n(cells.join(clusters.where("`order` < 3"), "cluster_id", "left_anti"), "cluster")
    return a.unionByName(b).unionByName(n(cores.join(sections.where("section_id <> 'S4'"), "section_id", "left_anti"), "section"))


@query("j2_empty_cores", canon("cells", "cores") + "select core_id from cores where core_id not in (select core_id from cells where cluster_id = '2-high' and n_transcripts > 220)")
def j2(spark, d):
    seen = _cells(spark, d).where("cluster_id = '2-high' and n_transcripts > 220").select("core_id").distinct()
    return warehouse.cores(spark, d).join(seen, "core_id", "left_anti").select("core_id")


@query("j3_core_attributes", canon("cells", "cores") + "select cell_id, k.patient_id, k.kind, round(sqrt((x_um-center_x_um)*(x_um-center_x_um)+(y_um-center_y_um)*(y_um-center_y_um)),6) as dist from cells c left join cores k on k.core_id = c.core_id and k.core_id <> 'C001'")
def j3(spark, d):
    k = warehouse.cores(spark, d).where("core_id <> 'C001'").select("core_id", "patient_id", "kind", "center_x_um", "center_y_um")
    j = _cells(spark, d, "cell_id", "core_id", "x_um", "y_um").join(k, "core_id", "left")
    return j.select("cell_id", "patient_id", "kind", F.round(F.hypot(F.col("x_um") - F.col("center_x_um"), F.col("y_um") - F.col("center_y_um")), 6).alias("dist"))


@query("j4_section_bounds", canon("cells", "sections") + "select cell_id, x_um between bounds_x0 and bounds_x1 and y_um between bounds_y0 and bounds_y1 as inside from cells left join sections using (section_id)")
def j4(spark, d):
    j = _cells(spark, d, "cell_id", "section_id", "x_um", "y_um").join(warehouse.sections(spark, d), "section_id", "left")
    return j.select("cell_id", (F.col("x_um").between(F.col("bounds_x0"), F.col("bounds_x1")) & F.col("y_um").between(F.col("bounds_y0"), F.col("bounds_y1"))).alias("inside"))


#: Keys of a range within one date.
DAY_KEYS = 2**20


@query("j5_align_rows", "select o_orderkey as barcode, (row_number() over (order by o_orderdate, o_orderkey)) - 1 as pos, o_custkey from orders")
def j5(spark, d):
    """Rows of one table in the order of another: positions without a sort in one task."""
    o = warehouse.read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    counts = o.groupBy("o_orderdate").agg(F.count("*").alias("c"))
    below = stats.below(counts, [], "o_orderdate", "c").select(F.col("o_orderdate").alias("day"), "below")
    # rows of one date are dealt to ranges of their keys, as one may have most of them
    span = F.expr(f"o_orderkey div {DAY_KEYS}")
    dealt = o.withColumn("span", span)
    starts = dealt.groupBy("o_orderdate", "span").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("o_orderdate").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.join(below, F.col("day") == F.col("o_orderdate")).select("o_orderdate", "span", (before + F.col("below")).alias("first"))
    pos = F.col("first") + F.row_number().over(Window.partitionBy("o_orderdate", "span").orderBy("o_orderkey")) - 1
    return dealt.join(starts, ["o_orderdate", "span"]).select(F.col("o_orderkey").alias("barcode"), pos.alias("pos"), "o_custkey")


@query("j6_group_labels", "select c_custkey, n_name as label from customer left join (select * from nation where n_regionkey <> 2) on c_nationkey = n_nationkey")
def j6(spark, d):
    n = warehouse.read(spark, d, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label"))
    return warehouse.read(spark, d, "customer", "c_custkey", "c_nationkey").join(n, "c_nationkey", "left").select("c_custkey", "label")


@query("j7_provided_embedding", canon("cells") + "select core_id, count(*) as n, count(*) filter (where has_umap) as present, avg(has_umap::int) as coverage from cells group by 1")
def j7(spark, d):
    cells = _cells(spark, d, "cell_id", "core_id")
    emb = warehouse.read(spark, d, "lineitem", "l_orderkey").distinct().select(F.col("l_orderkey").cast("string").alias("cell_id"), F.lit(True).alias("p"))
    j = cells.join(emb, "cell_id", "left").withColumn("p", F.coalesce("p", F.lit(False)))
    return j.groupBy("core_id").agg(F.count("*").alias("n"), F.count_if("p").alias("present"), F.avg(F.col("p").cast("int")).alias("coverage"))


@query("j8_index_maps", canon("cells", "clusters", "cores") + """
, cr as (select core_id, (row_number() over (order by section_id, core_id) - 1)::int as core_ix from cores)
select cell_id, "order"::int as cluster_ix, core_ix, ascii(substr(section_id,2)) - 49 as section_ix from cells join clusters using (cluster_id) join cr using (core_id)""")
def j8(spark, d):
    from ..operators.ordering import core_ranks, section_ranks

    cells = _cells(spark, d, "cell_id", "cluster_id", "core_id", "section_id")
    j = cells.join(warehouse.clusters(spark, d), "cluster_id").join(core_ranks(warehouse.cores(spark, d)), "core_id").join(section_ranks(warehouse.sections(spark, d)), "section_id")
    return j.select("cell_id", F.col("order").cast("int").alias("cluster_ix"), F.col("core_rank").alias("core_ix"), F.col("section_rank").alias("section_ix"))


@query("j9_panel_default", canon("genes") + "select gene_id, case when panel = 'predesigned' then 'base' else 'custom' end as category from genes")
def j9(spark, d):
    base = warehouse.read(spark, d, "part").where(F.col("p_brand").startswith("Brand#1")).select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("gene_id"), F.lit("base").alias("category"))
    return warehouse.genes(spark, d).select("gene_id").join(base, "gene_id", "left").withColumn("category", F.coalesce("category", F.lit("custom")))


@query("j11_radius", canon("cells", "cores") + "select k.core_id as base, c.cell_id from cores k join cells c on k.section_id = c.section_id and sqrt((x_um-center_x_um)*(x_um-center_x_um)+(y_um-center_y_um)*(y_um-center_y_um)) <= 250")
def j11(spark, d):
    centers = warehouse.cores(spark, d).select("section_id", F.col("core_id").alias("base"), F.col("center_x_um").alias("cx"), F.col("center_y_um").alias("cy"))
    return spatial.within(_cells(spark, d), centers, 250.0, by=("section_id",)).select("base", "cell_id")


@query("j12_near_cells", canon("cells") + """, p as (select c_custkey as id, 'S' || (c_nationkey%5+1) as section_id, 1000.0e0 + (c_custkey*37)%4500 as x, 1000.0e0 + (c_custkey*91)%3000 as y from customer)
select id from p where exists (select 1 from cells c where c.section_id = p.section_id and sqrt((x_um-x)*(x_um-x)+(y_um-y)*(y_um-y)) < 20)""")
def j12(spark, d):
    """Places that a cell is near, among all cells of their section."""
    p = warehouse.read(spark, d, "customer", "c_custkey", "c_nationkey").selectExpr("c_custkey as id", "concat('S', c_nationkey % 5 + 1) as section_id", "1000.0D + (c_custkey*37) % 4500 as x_um", "1000.0D + (c_custkey*91) % 3000 as y_um")
    t = _cells(spark, d).select("section_id", F.col("x_um").alias("cx"), F.col("y_um").alias("cy"))
    return spatial.near_any(p, t, "id", 20.0, by=("section_id",)).select("id")


@query("j14_overlaps", """with c as (select c_custkey as id, c_nationkey as s, (c_custkey*37)%1000 as x, (c_custkey*91)%1000 as y, 3 + c_custkey%5 as r from customer)
select a.s, a.id as a, b.id as b from c a join c b on a.s = b.s and a.id < b.id where sqrt(((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y))::double) < a.r+b.r""")
def j14(spark, d):
    c = warehouse.read(spark, d, "customer", "c_custkey", "c_nationkey").selectExpr("c_nationkey as section_id", "c_custkey as core_id", "'core' as kind", "cast((c_custkey*37)%1000 as double) as center_x_um", "cast((c_custkey*91)%1000 as double) as center_y_um", "cast(3+c_custkey%5 as double) as radius_um")
    o = spatial.overlapping(c)
    return o.join(c.select(F.col("core_id").alias("a"), F.col("section_id").alias("s")), "a").select("s", "a", "b")


@query("j15_occupied_stencil", canon("cells") + """, b as (select distinct section_id, floor(x_um/50)::bigint as bx, floor(y_um/50)::bigint as by from cells),
 k as (select c_custkey as id, 'S' || (c_nationkey%5+1) as section_id, (c_custkey*13)%120 as bx, (c_custkey*7)%90 as by from customer),
 s as (select dx, dy from range(-4,5) a(dx), range(-4,5) b(dy) where dx*dx+dy*dy <= 16)
select k.id, count(b.bx) as covered, round(count(b.bx)/49.0e0,9) as share from k cross join s left join b on b.section_id = k.section_id and b.bx = k.bx+dx and b.by = k.by+dy group by k.id""")
def j15(spark, d):
    b = _cells(spark, d).select("section_id", spatial.grid("x_um", 50).alias("bx"), spatial.grid("y_um", 50).alias("by")).distinct()
    k = warehouse.read(spark, d, "customer", "c_custkey", "c_nationkey").selectExpr("c_custkey as id", "concat('S', c_nationkey % 5 + 1) as section_id", "(c_custkey*13)%120 as bx", "(c_custkey*7)%90 as by")
    return spatial.coverage(k, b, 4, by=("section_id",)).withColumn("share", F.round("share", 9))


@query("j16_first_box", canon("cells", "cores") + "select cell_id, (select min(k.core_id) from cores k where x_um between bbox_x0-50 and bbox_x1+50 and y_um between bbox_y0-50 and bbox_y1+50 and k.section_id = c.section_id) as box from cells c")
def j16(spark, d):
    boxes = warehouse.cores(spark, d).select("section_id", F.col("core_id").alias("box"), F.col("bbox_x0").alias("x0"), F.col("bbox_y0").alias("y0"), F.col("bbox_x1").alias("x1"), F.col("bbox_y1").alias("y1"))
    return spatial.first_box(_cells(spark, d), boxes, "cell_id", "box", 50.0, by=("section_id",))


@query("j19_run_difference", """with a as (select doc_id as rel, md5(coalesce(text,'')) as h from documents where doc_id % 9 <> 0), b as (select doc_id as rel, md5(case when doc_id % 10 = 3 then 'x' else coalesce(text,'') end) as h from documents where doc_id % 11 <> 0)
select coalesce(a.rel,b.rel) as rel, a.h as sha_one, b.h as sha_two from a full join b on a.rel=b.rel where a.h is distinct from b.h""")
def j19(spark, d):
    from ..operators.integrity import differing

    t = warehouse.read(spark, d, "documents", "doc_id", "text").withColumn("t", F.coalesce("text", F.lit("")))
    a = t.where("doc_id % 9 <> 0").select(F.col("doc_id").alias("rel"), F.md5(F.col("t").cast("binary")).alias("sha256"))
    b = t.where("doc_id % 11 <> 0").select(F.col("doc_id").alias("rel"), F.md5(F.when(F.col("doc_id") % 10 == 3, "x").otherwise(F.col("t")).cast("binary")).alias("sha256"))
    return differing(a, b)


@query("a1_library_size", canon("cells", "expression") + "select c.cell_id, coalesce(sum(count),0)::bigint as total from cells c left join expression e using (cell_id) group by 1")
def a1(spark, d):
    from ..operators.expression import library_size

    return library_size(warehouse.cells(spark, d), warehouse.expression(spark, d))


@query("a2_counts", canon("cells") + "select cluster_id, count(*) as n from cells group by 1")
def a2(spark, d):
    return _cells(spark, d, "cluster_id").groupBy("cluster_id").agg(F.count("*").alias("n"))


@query("a3_zero_filled", "select c_custkey as id, count(o_orderkey) as n from customer left join orders on c_custkey = o_custkey group by 1")
def a3(spark, d):
    """Counts of every customer, those without orders too."""
    n = warehouse.read(spark, d, "orders", "o_custkey").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    return warehouse.read(spark, d, "customer", "c_custkey").withColumnRenamed("c_custkey", "id").join(n, "id", "left").na.fill(0, ["n"])


@query("a4_distinct", canon("cells") + "select section_id, count(distinct patient_id) as patients, count(distinct core_id) as cores from cells group by 1")
def a4(spark, d):
    return _cells(spark, d).groupBy("section_id").agg(F.count_distinct("patient_id").alias("patients"), F.count_distinct("core_id").alias("cores"))


@query("a5_median", canon("cells") + "select cluster_id, median(n_transcripts)::double as med from cells group by 1 union all select 'all', median(n_transcripts)::double from cells")
def a5(spark, d):
    c = _cells(spark, d, "cluster_id", "n_transcripts")
    both = c.withColumn("cluster_id", F.explode(F.array(F.col("cluster_id"), F.lit("all"))))
    return selection.median(both, ["cluster_id"], "n_transcripts", "med")


@query("a5_median_prices", "select l_returnflag, median(l_extendedprice) as med, count(*) as n from lineitem group by 1")
def a5p(spark, d):
    """Medians of groups of hundreds of thousands of distinct values."""
    li = warehouse.read(spark, d, "lineitem", "l_returnflag", "l_extendedprice")
    return selection.median(li, ["l_returnflag"], "l_extendedprice", "med").join(li.groupBy("l_returnflag").agg(F.count("*").alias("n")), "l_returnflag")


@query("a6_extent", canon("cells") + "select core_id, floor(min(x_um))::bigint as x0, floor(min(y_um))::bigint as y0, ceil(max(x_um))::bigint as x1, ceil(max(y_um))::bigint as y1, round(max(x_um)-min(x_um),6) as span from cells group by 1")
def a6(spark, d):
    return _cells(spark, d).groupBy("core_id").agg(F.floor(F.min("x_um")).alias("x0"), F.floor(F.min("y_um")).alias("y0"), F.ceil(F.max("x_um")).alias("x1"), F.ceil(F.max("y_um")).alias("y1"), F.round(F.max("x_um") - F.min("x_um"), 6).alias("span"))


@query("a9_share_differing", canon("cells") + "select avg((has_umap <> (n_transcripts > 100))::int) as share, count_if(n_transcripts = 0)::bigint as zero from cells")
def a9(spark, d):
    return _cells(spark, d).agg(F.avg((F.col("has_umap") != (F.col("n_transcripts") > 100)).cast("int")).alias("share"), F.count_if(F.col("n_transcripts") == 0).alias("zero"))


@query("a13_densest_window", canon("cells") + "select floor(x_um/600)::bigint as bx, floor(y_um/600)::bigint as \"by\", count(*) as n from cells group by 1,2 order by n desc, bx, \"by\" limit 1")
def a13(spark, d):
    return spatial.densest(_cells(spark, d), 600.0)


@query("a14_occupancy", canon("cells") + ", o as (select min(x_um) as x0, min(y_um) as y0 from cells) select floor((x_um-x0)/50)::bigint as bx, floor((y_um-y0)/50)::bigint as by, count(*) as n from cells, o group by 1, 2")
def a14(spark, d):
    return spatial.occupancy(_cells(spark, d), 50.0)


@query("a22_first_of_group", "select o_orderpriority as grp, arg_min(o_orderstatus, o_orderkey) as first from orders group by 1")
def a22(spark, d):
    return warehouse.read(spark, d, "orders", "o_orderpriority", "o_orderstatus", "o_orderkey").groupBy(F.col("o_orderpriority").alias("grp")).agg(F.min_by("o_orderstatus", "o_orderkey").alias("first"))


@query("a24_status_counts", "select count_if(o_orderstatus='F')::bigint as done, count_if(o_orderstatus in ('O','P'))::bigint as open, bool_and(o_totalprice > 0) as all_ok, bool_or(o_totalprice > 400000) as any_big from orders")
def a24(spark, d):
    s = F.col("o_orderstatus")
    return warehouse.read(spark, d, "orders", "o_orderstatus", "o_totalprice").agg(F.count_if(s == "F").alias("done"), F.count_if(s.isin("O", "P")).alias("open"), F.bool_and(F.col("o_totalprice") > 0).alias("all_ok"), F.bool_or(F.col("o_totalprice") > 400000).alias("any_big"))


@query("w1_number_repeats", canon("genes") + "select gene_id, symbol from genes")
def w1(spark, d):
    return warehouse.genes(spark, d).select("gene_id", "symbol")


@query("w2_rank_map", canon("clusters") + 'select cluster_id, "order"::int as ix from clusters')
def w2(spark, d):
    return warehouse.clusters(spark, d).select("cluster_id", (F.row_number().over(Window.orderBy("order")) - 1).alias("ix"))


@query("w3_average_ranks", "select o_orderkey, rank() over (partition by o_orderstatus order by o_orderpriority) + (count(*) over (partition by o_orderstatus, o_orderpriority) - 1)/2.0e0 as rk from orders")
def w3(spark, d):
    from ..operators.stats import average_ranks

    o = warehouse.read(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority").withColumnRenamed("o_orderpriority", "v")
    return average_ranks(o, ["o_orderstatus"]).select("o_orderkey", "rk")


@query("w5_running_sums", "select l_orderkey, l_linenumber, sum(l_quantity) over (partition by l_orderkey order by l_linenumber range unbounded preceding) as upto from lineitem")
def w5(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rangeBetween(Window.unboundedPreceding, 0)
    return warehouse.read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select("l_orderkey", "l_linenumber", F.sum("l_quantity").over(w).alias("upto"))


@query("w6_duplicates", "select lower(p_name) as name, count(*) as n from part group by 1 having count(*) > 1")
def w6(spark, d):
    return warehouse.read(spark, d, "part", "p_name").groupBy(F.lower("p_name").alias("name")).agg(F.count("*").alias("n")).where("n > 1")


@query("o3_group_order", """select o_orderpriority as grp, count(*) as n, (row_number() over (order by lower(o_orderpriority) = '4-not specified', count(*) desc, o_orderpriority) - 1)::int as place from orders group by 1""")
def o3(spark, d):
    g = warehouse.read(spark, d, "orders", "o_orderpriority").groupBy(F.col("o_orderpriority").alias("grp")).agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.lower("grp") == "4-not specified", F.col("n").desc(), "grp")) - 1)


@query("o4_top_clusters", canon("clusters") + 'select cluster_id, n_cells from clusters order by n_cells desc, "order" limit 3')
def o4(spark, d):
    return warehouse.clusters(spark, d).orderBy(F.col("n_cells").desc(), "order").limit(3).select("cluster_id", "n_cells")


@query("o5_top_genes", canon("expression") + ", t as (select gene_id, count(*) as nnz from expression group by 1 order by nnz desc, gene_id limit 150) select gene_id, nnz, (row_number() over (order by gene_id) - 1)::int as ix from t")
def o5(spark, d):
    t = warehouse.expression(spark, d).groupBy("gene_id").agg(F.count("*").alias("nnz")).orderBy(F.col("nnz").desc(), "gene_id").limit(150)
    return t.withColumn("ix", F.row_number().over(Window.orderBy("gene_id")) - 1)


@query("o8_seeded_sample", "select o_orderkey from (select o_orderkey, md5('s:' || o_orderkey) as h from orders) order by h, o_orderkey limit 1000")
def o8(spark, d):
    o = warehouse.read(spark, d, "orders", "o_orderkey").withColumn("h", F.md5(F.concat(F.lit("s:"), F.col("o_orderkey").cast("string")).cast("binary")))
    return o.orderBy("h", "o_orderkey").limit(1000).select("o_orderkey")


@query("u1_concatenate", canon("cells") + "select section_id, cell_id || '-a' as cell_id from cells where section_id = 'S1' union all select section_id, cell_id || '-b' from cells where section_id <> 'S1'")
def u1(spark, d):
    c = _cells(spark, d, "section_id", "cell_id")
    part = lambda cond, tag: c.where(cond).select("section_id", F.concat("cell_id", F.lit(tag)).alias("cell_id"))
    return part("section_id = 'S1'", "-a").unionByName(part("section_id <> 'S1'", "-b"))


@query("u4_difference", "select distinct p_brand, p_size from part except select distinct p_brand, p_size from part where p_partkey % 3 = 0")
def u4(spark, d):
    p = warehouse.read(spark, d, "part", "p_partkey", "p_brand", "p_size")
    return p.select("p_brand", "p_size").subtract(p.where("p_partkey % 3 = 0").select("p_brand", "p_size"))


@query("u5_insert_if_absent", "select event_type, min(event_id) as first_seen from events group by 1")
def u5(spark, d):
    return warehouse.read(spark, d, "events", "event_id", "event_type").groupBy("event_type").agg(F.min("event_id").alias("first_seen"))


@query("u6_present_in_order", "select n_nationkey, n_name from nation where n_nationkey in (select c_nationkey from customer where c_acctbal > 9000) order by 1")
def u6(spark, d):
    c = warehouse.read(spark, d, "customer", "c_nationkey", "c_acctbal").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey"))
    return warehouse.read(spark, d, "nation", "n_nationkey", "n_name").join(c, "n_nationkey", "left_semi").orderBy("n_nationkey")


_ = (text, validation)
