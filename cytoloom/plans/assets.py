"""Assets, manifests, integrity and document checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import documents, integrity, merkle, ordering
from ..sources import warehouse
from .registry import canon, query

_A = "with a as (select 'doc/' || doc_id as rel, lang as family, octet_length(encode(coalesce(text,'')))::bigint as bytes, sha256(coalesce(text,'')) as sha256 from documents) "


def _assets(spark, d):
    docs = warehouse.read(spark, d, "documents", "doc_id", "lang", "text")
    return integrity.assets(docs.select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("rel"), F.col("lang").alias("family"), F.coalesce("text", F.lit("")).alias("payload")))


@query("k3_assets", _A + "select * from a")
def k3(spark, d):
    return _assets(spark, d)


@query("k4_family_sizes", _A + "select family, count(*) as files, sum(bytes)::bigint as bytes from a group by 1")
def k4(spark, d):
    return integrity.family_sizes(_assets(spark, d))


@query("v32_budget", _A + "select sum(bytes)::bigint as bytes, count(*) as files, sum(bytes) <= 5000000000 as ok from a")
def v32(spark, d):
    return integrity.over_budget(_assets(spark, d))


@query("k7_core_table", canon("placed", "cores") + """, r as (select core_id, min(idx) as first, max(idx)+1 as e from placed group by 1)
select core_id as id, section_id as section, patient_id as patient, kind, [center_x_um, center_y_um] as center_um, radius_um, [bbox_x0,bbox_y0,bbox_x1,bbox_y1] as bbox_um, [first, e] as cell_range from cores join r using (core_id)""")
def k7(spark, d):
    ds = warehouse.load(spark, d)
    r = ordering.core_ranges(ordering.placed(ds))
    return ds.cores.join(r, "core_id").select(F.col("core_id").alias("id"), F.col("section_id").alias("section"), F.col("patient_id").alias("patient"), "kind", F.array("center_x_um", "center_y_um").alias("center_um"), "radius_um", F.array("bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1").alias("bbox_um"), F.array("first", "end").alias("cell_range"))


@query("k7_gene_table", canon("quantised", "genes") + "select g.gene_id as id, symbol, panel, round(coalesce(max(max_v),0),6) as max_v, count(cell_id) as nnz, 'expr/' || g.gene_id || '.bin' as file from genes g left join quantised q using (gene_id) group by g.gene_id, symbol, panel")
def k7g(spark, d):
    from ..operators import expression

    ds = warehouse.load(spark, d)
    q = expression.quantised(expression.display_values(ds.expression)).groupBy("gene_id").agg(F.max("max_v").alias("m"), F.count("*").alias("nnz"))
    return ds.genes.join(q, "gene_id", "left").select(F.col("gene_id").alias("id"), "symbol", "panel", F.round(F.coalesce("m", F.lit(0.0)), 6).alias("max_v"), F.coalesce("nnz", F.lit(0)).alias("nnz"), F.concat(F.lit("expr/"), "gene_id", F.lit(".bin")).alias("file"))


@query("v40_index_hashes", _A + """, f as (select case family when 'en' then 'expression' else 'he' end as family, rel, bytes, rel || ' ' || bytes || ' ' || sha256 || chr(10) as l from a where family in ('en', 'de')),
 g as (select family, substr(md5(rel),1,3) as g, sha256(string_agg(l, '' order by rel)) as h, count(*) as files, sum(bytes) as bytes from f group by 1, 2)
select family, sum(files)::bigint as files, sum(bytes)::bigint as bytes, sha256(string_agg(h, '' order by g)) as sha256 from g group by 1""")
def v40(spark, d):
    a = _assets(spark, d).withColumn("family", F.when(F.col("family") == "en", "expression").when(F.col("family") == "de", "he").otherwise("tables"))
    return integrity.index_hashes(a)


@query("v39_verification", """with e as (select s_suppkey as k, s_name as name, case s_suppkey%3 when 0 then 'md5' when 1 then 'size' else 'unpacked' end as method, md5(s_name) as md5, s_suppkey/10.0e0 as mb from supplier),
 f as (select k, name as fn, case when k%5=0 then md5('x') else md5 end as fm, (mb*1e6 + case when k%4=0 then 90000 else 10 end)::bigint as fb from e where k%7 <> 0)
select name, method, case when fb is null then 'MISSING' when (method='md5' and e.md5 = fm) or (method='size' and abs(fb/1e6-mb) <= 0.05e0+1e-9) or (method='unpacked' and fb > 0) then 'ok' else 'MISMATCH' end as status from e left join f on f.fn = e.name""")
def v39(spark, d):
    k = F.col("s_suppkey")
    md5 = F.md5(F.col("s_name").cast("binary"))
    s = warehouse.read(spark, d, "supplier", "s_suppkey", "s_name")
    e = s.select(F.col("s_name").alias("name"), F.when(k % 3 == 0, "md5").when(k % 3 == 1, "size").otherwise("unpacked").alias("method"), md5.alias("md5"), (k / 10.0).alias("mb"))
    f = s.where(k % 7 != 0).select(F.col("s_name").alias("name"), F.when(k % 5 == 0, F.md5(F.lit("x").cast("binary"))).otherwise(md5).alias("md5"), F.rint(k / 10.0 * 1e6 + F.when(k % 4 == 0, 90000).otherwise(10)).cast("long").alias("bytes"))
    return integrity.verified(e, f)


@query("v42_repository", r"""with p as (select s_suppkey as k, case s_suppkey%4 when 0 then 'fixtures/a'||s_suppkey||'.parquet' when 1 then 'src/a'||s_suppkey||'.py' when 2 then 'data/a'||s_suppkey||'.NPZ' else 'docs/a'||s_suppkey||'.md' end as path, s_suppkey*80000 as bytes from supplier)
select path, case when k%4=2 then 'data file' else 'too large' end as why from p where k%4 <> 0 and (k%4=2 or bytes > 5000000)""")
def v42(spark, d):
    k = F.col("s_suppkey")
    s = k.cast("string")
    p = warehouse.read(spark, d, "supplier", "s_suppkey").select(F.when(k % 4 == 0, F.concat(F.lit("fixtures/a"), s, F.lit(".parquet"))).when(k % 4 == 1, F.concat(F.lit("src/a"), s, F.lit(".py"))).when(k % 4 == 2, F.concat(F.lit("data/a"), s, F.lit(".NPZ"))).otherwise(F.concat(F.lit("docs/a"), s, F.lit(".md"))).alias("path"), (k * 80000).alias("bytes"))
    return integrity.repository_findings(p)


@query("v43_requirements", "select 'FR-' || n_nationkey as id, case when n_nationkey%2=0 then 'Must' else 'Should' end as priority, n_name as title from nation")
def v43(spark, d):
    n = warehouse.read(spark, d, "nation")
    k = F.col("n_nationkey").cast("string")
    first = n.select(F.col("n_nationkey").alias("n"), F.concat(F.lit("| FR-"), k, F.lit(" | "), "n_name", F.lit(" | "), F.when(F.col("n_nationkey") % 2 == 0, "Must").otherwise("Should"), F.lit(" |")).alias("line"))
    again = n.select((F.col("n_nationkey") + 100).alias("n"), F.concat(F.lit("| FR-"), k, F.lit(" | again | Could |")).alias("line"))
    return integrity.requirements(first.unionByName(again))


@query("v43_untraced", "select 'FR-' || n_nationkey as id from nation where n_nationkey%2=0 and n_nationkey%3 <> 0")
def v43u(spark, d):
    n = warehouse.read(spark, d, "nation")
    tests = n.where("n_nationkey % 3 = 0").select(F.concat(F.lit("T-1 covers FR-"), F.col("n_nationkey").cast("string"), F.lit(" and FR-1")).alias("line"))
    return integrity.untraced(v43(spark, d), tests)


@query("v41_reproducible", "select 0::bigint as n_differing, count(distinct l_partkey)::bigint as n_files from lineitem")
def v41(spark, d):
    """Gene blobs made twice, the second time from rows in another order and number of partitions, agree in every file."""
    from ..operators import expression

    ds = warehouse.load(spark, d)

    def made(counts, cells):
        d = expression.quantised_deltas(expression.display_values(counts), ordering.placed(ds.having(cells=cells)))
        blobs = expression.blobs(d, cells.count())
        return integrity.assets(blobs.select(F.col("gene_id").alias("rel"), F.lit("expression").alias("family"), "payload"))

    one, two = made(ds.expression, ds.cells), made(ds.expression.repartition(7, F.rand(3)), ds.cells.repartition(5, F.rand(4)))
    return integrity.differing(one, two).agg(F.count("*").alias("n_differing")).crossJoin(one.agg(F.count("*").alias("n_files")))  # one row each


@query("k7_cluster_table", canon("cells", "clusters") + 'select cluster_id as id, label, color, "order"::int as "order", n_cells from clusters')
def k7c(spark, d):
    return warehouse.clusters(spark, d).select(F.col("cluster_id").alias("id"), "label", "color", F.col("order").cast("int").alias("order"), "n_cells")


@query("k7_section_table", canon("quant", "sections") + "select section_id as id, pixel_size as pixel_size_um, [bounds_x0, bounds_y0, bounds_x1, bounds_y1] as bounds_um, q_offset as xy_offset, round(q_scale, 12) as xy_scale from sections join quant using (section_id)")
def k7s(spark, d):
    s = warehouse.sections(spark, d)
    return s.join(ordering.section_quantisers(s), "section_id").select(F.col("section_id").alias("id"), F.col("pixel_size").alias("pixel_size_um"), F.array(*[f"bounds_{c}" for c in ("x0", "y0", "x1", "y1")]).alias("bounds_um"), F.col("q_offset").alias("xy_offset"), F.round("q_scale", 12).alias("xy_scale"))


@query("v43_dates", """with o as (select o_orderkey as k, o_orderdate::date as d from orders)
select k::varchar as path, 1 as n, strftime(d, '%Y-%m-%d') as date from o where k % 4 in (0, 1) union all select k::varchar, 1, strftime(d, '%-d.%-m.%Y') from o where k % 4 = 1 union all select k::varchar, 1, strftime(d, '%B %-d, %Y') from o where k % 4 = 3""")
def v43d(spark, d):
    """Calendar dates found in lines that say them in several ways, or don't."""
    said = lambda f: F.date_format("o_orderdate", f)
    k = F.col("o_orderkey") % 4
    line = F.when(k == 0, F.concat(F.lit("due "), said("yyyy-MM-dd"), F.lit(", today"))).when(k == 1, F.concat(F.lit("on "), said("d.M.yyyy"), F.lit(" or "), said("yyyy-MM-dd"))).when(k == 2, "see 1.2 and 12/2024").otherwise(F.concat(F.lit("by "), said("MMMM d, yyyy")))
    return documents.dates(warehouse.read(spark, d, "orders", "o_orderkey", "o_orderdate").select(F.col("o_orderkey").cast("string").alias("path"), F.lit(1).alias("n"), line.alias("line")))


@query("v43_criteria", "select 'FR-' || n_nationkey as id from nation where n_nationkey % 2 = 0 and n_nationkey % 3 <> 0")
def v43c(spark, d):
    """Requirements without a criterion that says given, when and then."""
    n = warehouse.read(spark, d, "nation", "n_nationkey")
    k = F.col("n_nationkey").cast("string")
    row = n.select(F.lit("prd").alias("path"), F.col("n_nationkey").alias("n"), F.concat(F.lit("| FR-"), k, F.lit(" | "), F.when(F.col("n_nationkey") % 2 == 0, "M").otherwise("W"), F.lit(" | text [A] |")).alias("line"))
    met = n.select(F.lit("prd").alias("path"), (F.col("n_nationkey") + 100).alias("n"), F.concat(F.lit("AC-FR-"), k, F.lit(".1 "), F.when(F.col("n_nationkey") % 3 == 0, "Given a, when b, then c.").otherwise("Given a, then c.")).alias("line"))
    lines = row.unionByName(met)
    return documents.without_criteria(documents.requirements(lines), lines)


_W = "(length({0}::varchar) || ':' || {0})"
_NODE = "select {} as node, sum(rows)::bigint as rows, sha256(string_agg(node || ' ' || hash, chr(10) order by node || ' ' || hash)) as hash from {} group by 1"


@query("f18_matrix_tree", canon("expression") + f""", r as (select substr(sha256({_W.format("cell_id")} || ',' || {_W.format("gene_id")}),1,2) as leaf, sha256({_W.format("cell_id")} || ',' || {_W.format("count")} || ',' || {_W.format("gene_id")}) as row from expression),
 f as (select leaf, row, count(*) as times from r group by all), l2 as (select leaf as node, sum(times)::bigint as rows, sha256(string_agg(row || ' ' || times, chr(10) order by row || ' ' || times)) as hash from f group by 1),
 l1 as ({_NODE.format("substr(node,1,1)", "l2")}), l0 as ({_NODE.format("''", "l1")})
select 2 as level, * from l2 union all select 1, * from l1 union all select 0, * from l0""")
def f18(spark, d):
    """The Merkle tree of the count matrix."""
    return merkle.tree(warehouse.expression(spark, d), ["cell_id", "gene_id"], 2)
