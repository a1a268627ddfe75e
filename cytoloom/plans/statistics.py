"""Statistics, neighbours and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import expression, factor, knn, neighbour_map, stats
from ..sources import warehouse
from ..staging import staged
from .registry import query

_S = "with s as (select n_regionkey as region, case when o_orderpriority in ('1-URGENT','2-HIGH') then 'a' else 'b' end as g, o_totalprice as v from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey) "


def _samples(spark, d):
    c = warehouse.read(spark, d, "customer", "c_custkey", "c_nationkey").join(warehouse.read(spark, d, "nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    o = warehouse.read(spark, d, "orders", "o_custkey", "o_orderpriority", "o_totalprice").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return o.select(F.col("n_regionkey").alias("region"), F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "a").otherwise("b").alias("g"), F.col("o_totalprice").alias("v"))


@query("a16_effect_size", _S + """, t as (select region, count(*) filter (where g='a') as na, count(*) filter (where g='b') as nb, avg(v) filter (where g='a') as ma, avg(v) filter (where g='b') as mb, var_samp(v) filter (where g='a') as va, var_samp(v) filter (where g='b') as vb from s group by 1)
select region, na as n_a, nb as n_b, round((ma-mb)/sqrt(((na-1)*va+(nb-1)*vb)/(na+nb-2)),6) as d from t""")
def a16(spark, d):
    return stats.cohens_d(_samples(spark, d), ["region"]).select("region", "n_a", "n_b", F.round("d", 6).alias("d"))


@query("a17_rank_sum", _S + """, r as (select *, rank() over (partition by region order by v) + (count(*) over (partition by region, v)-1)/2.0e0 as rk, count(*) over (partition by region, v) as c from s),
 t as (select region, count(*) filter (where g='a') as na, count(*) filter (where g='b') as nb, sum(rk) filter (where g='a') as ra, sum(c::double*c-1) as ties from r group by 1),
 u as (select *, ra - na*(na+1)/2.0e0 as u, na+nb as n from t)
select region, na::bigint as n_a, nb::bigint as n_b, u, round(2*u/(na*nb)-1,6) as rank_biserial, round((u-na*nb/2.0e0-0.5e0)/sqrt(na*nb/12.0e0*((n+1)-ties/(n*(n-1)))),6) as z from u""")
def a17(spark, d):
    return stats.rank_sum(_samples(spark, d), ["region"]).select("region", "n_a", "n_b", "u", F.round("rank_biserial", 6).alias("rank_biserial"), F.round("z", 6).alias("z"))


_M6 = """with s0 as (select n_regionkey as region, o_orderkey as k, o_orderpriority in ('1-URGENT','2-HIGH') as urgent, o_totalprice as v from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey),
 s as (select 'r' || region as region, false as control, case when urgent then 'a' else 'b' end as g, v + case when urgent then 300000 else 0 end as v from s0 union all select 'c' || region, true, case when k%2=0 then 'a' else 'b' end, v from s0),
 t as (select region, control, count(*) filter (where g='a') as na, count(*) filter (where g='b') as nb, avg(v) filter (where g='a') as ma, avg(v) filter (where g='b') as mb, var_samp(v) filter (where g='a') as va, var_samp(v) filter (where g='b') as vb from s group by 1, 2),
 e as (select region, control, (ma-mb)/sqrt(((na-1)*va+(nb-1)*vb)/(na+nb-2)) as d from t),
 r as (select *, rank() over (partition by region order by v) + (count(*) over (partition by region, v)-1)/2.0e0 as rk, count(*) over (partition by region, v) as c from s),
 q as (select region, count(*) filter (where g='a') as na, count(*) filter (where g='b') as nb, sum(rk) filter (where g='a') as ra, sum(c::double*c-1) as ties from r group by 1),
 u as (select region, na, nb, ra - na*(na+1)/2.0e0 as u, ties, na+nb as n from q),
 z as (select region, (u-na*nb/2.0e0-0.5e0)/sqrt(na*nb/12.0e0*((n+1)-ties/(n*(n-1)))) as z from u),
 x as (select control, z > 4.753424e0 and d >= 0.8e0 as ok from e join z using (region))
select not bool_or(control and ok) and bool_and(control or ok) and bool_or(control) and bool_or(not control) as passed, count_if(ok)::bigint as n_passed from x"""


@query("m6_suite", _M6)
def m6(spark, d):
    """The rule on comparisons with an effect, one for each region, and on as many controls without."""
    o = warehouse.read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice").join(warehouse.read(spark, d, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.join(warehouse.read(spark, d, "nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    side = lambda c: F.when(c, "a").otherwise("b").alias("g")
    region = F.col("n_regionkey").cast("string")
    real = o.select(F.concat(F.lit("r"), region).alias("region"), F.lit(False).alias("control"), side(urgent), (F.col("o_totalprice") + F.when(urgent, 300000.0).otherwise(0.0)).alias("v"))
    control = o.select(F.concat(F.lit("c"), region).alias("region"), F.lit(True).alias("control"), side(F.col("o_orderkey") % 2 == 0), F.col("o_totalprice").alias("v"))
    by = ["region", "control"]
    both = real.unionByName(control)
    return stats.suite(stats.rank_sum(both, by).join(stats.cohens_d(both, by).select(*by, "d"), by))


_NN = """with v as (select vec_id as id, label, embedding as e from embeddings), p as (select a.id as a, b.id as b, a.label as la, b.label as lb, list_sum(list_transform(list_zip(a.e::double[], b.e::double[]), lambda z: (z[1]-z[2])*(z[1]-z[2]))) as d2 from v a join v b on a.id <> b.id),
 n as (select *, row_number() over (partition by a order by d2, b) as rk from p) """


def _points(spark, d):
    return warehouse.read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


@query("j13_nearest", _NN + "select a, b, rk::int as rk, round(d2,4) as d2 from n where rk <= 15")
def j13(spark, d):
    return knn.knn(_points(spark, d)).select("a", "b", "rk", F.round("d2", 4).alias("d2"))


@query("j13_plane", """with v as (select c_custkey as id, ((c_custkey*37)%1000)::double as x, ((c_custkey*c_custkey)%777)::double as y from customer), p as (select a.id as a, b.id as b, (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) as d2 from v a join v b on a.id <> b.id),
 n as (select *, row_number() over (partition by a order by d2, b) as rk from p) select a, b, rk::int as rk, d2 from n where rk <= 15""")
def j13p(spark, d):
    """Nearest neighbours in a plane, with many ties."""
    c = warehouse.read(spark, d, "customer", "c_custkey").selectExpr("c_custkey as id", "cast((c_custkey*37)%1000 as double) as x", "cast((c_custkey*c_custkey)%777 as double) as y")
    return knn.knn_plane(c, 15, cell=128).select("a", "b", "rk", "d2")


@query("m1_coherence", _NN + "select round(avg(s),9) as score, count(*) as n from (select a, avg((la=lb)::int) as s from n where rk <= 15 group by 1)")
def m1(spark, d):
    p = _points(spark, d)
    return knn.coherence(knn.knn(p), p.select("id", "label")).withColumn("score", F.round("score", 9))


@query("m2_choice", "select id, case when r is not null and (p is null or r > p) then 'recomputed' else 'provided' end as choice from (select s_suppkey as id, nullif(s_suppkey%7, 3) as p, nullif(s_suppkey%5, 2) as r from supplier)")
def m2(spark, d):
    s = warehouse.read(spark, d, "supplier", "s_suppkey").selectExpr("s_suppkey as id", "nullif(s_suppkey % 7, 3) as p", "nullif(s_suppkey % 5, 2) as r")
    return s.select("id", knn.choice(F.col("p"), F.col("r")).alias("choice"))


@query("m7_components")
def m7(spark, d):
    """Principal components and two clusters of the vectors; signs and labels are not unique."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = _points(spark, d).withColumn("f", array_to_vector(F.col("vec").cast("array<double>")))
    v = PCA(k=5, inputCol="f", outputCol="p").fit(v).transform(v)
    return KMeans(k=2, seed=1, featuresCol="p").fit(v).transform(v).select("id", vector_to_array("p").alias("p"), "prediction")


@query("g12_leading_vectors")
def g12(spark, d):
    """Cells along the five leading singular vectors of the display values, from sparse rows; tests hold it to numpy."""
    genes = warehouse.genes(spark, d).select("gene_id", F.expr("row_number() over (order by gene_id) - 1").alias("j"))
    values = expression.display_values(warehouse.expression(spark, d)).join(genes, "gene_id").select(F.col("cell_id").alias("row"), "j", "v")
    rows = staged(factor.sparse_rows(values, warehouse.cells(spark, d).select(F.col("cell_id").alias("row"))), "leading-rows")
    return factor.places(rows, genes.count(), 5, rounds=8).select(F.col("row").alias("cell_id"), *[F.round(F.col("p")[i], 6).alias(f"p{i + 1}") for i in range(5)])


@query("m3_neighbour_map")
def m3(spark, d):
    """The vectors as a map of their neighbours, from their first two principal components on; tests hold it to what those keep."""
    points = staged(_points(spark, d), "map-points")
    entries = points.select(F.col("id").alias("row"), F.posexplode("vec").alias("j", "v"))
    rows = staged(factor.sparse_rows(entries), "map-rows")
    first = factor.places(rows, points.agg(F.max(F.size("vec"))).first()[0] or 1, 2, centred=True)
    start = staged(first.select(F.col("row").alias("id"), F.col("p")[0].alias("x"), F.col("p")[1].alias("y")), "map-components")
    graph = staged(neighbour_map.fuzzy_graph(knn.knn(points, 14), 15), "map-graph")
    return neighbour_map.layout(graph, start).select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))
