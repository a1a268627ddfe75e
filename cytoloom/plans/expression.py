"""Expression and codec queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec
from ..operators import expression, ordering
from ..sources import warehouse
from .registry import canon, query


@query("expr_quantized", canon("quantised") + "select cell_id, gene_id, round(max_v,6) as max_v, q from quantised")
def flagship(spark, d):
    """Quantised expression of every cell and gene: the flagship."""
    q = expression.quantised(expression.display_values(warehouse.expression(spark, d)))
    return q.select("cell_id", "gene_id", F.round("max_v", 6).alias("max_v"), "q")


@query("f9_display_values", canon("vals") + "select cell_id, gene_id, round(v,6) as v from vals")
def f9(spark, d):
    return expression.display_values(warehouse.expression(spark, d)).select("cell_id", "gene_id", F.round("v", 6).alias("v"))


@query("a11_detection", canon("genes", "expression") + "select gene_id, count(cell_id) as nnz, coalesce(max(count),0)::int as max_count from genes left join expression using (gene_id) group by 1")
def a11(spark, d):
    return expression.detection(warehouse.expression(spark, d), warehouse.genes(spark, d))


def _deltas(spark, d):
    ds = warehouse.load(spark, d)
    return expression.quantised_deltas(expression.display_values(ds.expression), ordering.placed(ds))


@query("c3_deltas", canon("delta") + "select gene_id, idx, delta, q from delta")
def c3(spark, d):
    return _deltas(spark, d)


_SIZES = ", n as (select count(*) as n from cells), s as (select gene_id, count(*) as nnz, sum(1+(delta>=128)::int+(delta>=16384)::int+(delta>=2097152)::int+(delta>=268435456)::int) as codes from delta group by 1) "


@query("c4_blob_sizes", canon("delta") + _SIZES + "select gene_id, nnz, case when codes+nnz < n then 0 else 1 end as fmt, (case when codes+nnz < n then codes+nnz else n end + 5)::bigint as bytes from s, n")
def c4(spark, d):
    return expression.blob_sizes(_deltas(spark, d), warehouse.read(spark, d, "orders", "o_orderkey").count())


_BYTES = "list_reduce(list_transform(list_filter([0,1,2,3,4], lambda i: i=0 or (delta >> (7*i)) > 0), lambda i: printf('%02x', (((delta >> (7*i)) & 127) | case when i<4 and (delta >> (7*(i+1))) > 0 then 128 else 0 end)::int)), lambda a, b: a || b)"


@query("k8_gene_blobs", canon("delta") + _SIZES + f""", p as (select gene_id, string_agg({_BYTES}, '' order by idx) || string_agg(printf('%02x', q), '' order by idx) as body from delta group by 1)
select gene_id, s.nnz, 0 as fmt, sha256(unhex('00' || printf('%02x%02x0000', (s.nnz%256)::int, (s.nnz//256)::int) || body)) as sha256 from p join s using (gene_id), n where codes+nnz < n
union all select s.gene_id, any_value(s.nnz), 1, sha256(unhex('01' || printf('%02x%02x0000', (any_value(s.nnz)%256)::int, (any_value(s.nnz)//256)::int) || string_agg(coalesce(printf('%02x', q), '00'), '' order by i)))
 from s, n, range(0, (select n from n)) t(i) left join delta dd on dd.gene_id = s.gene_id and dd.idx = i where codes+s.nnz >= n.n group by s.gene_id""")
def k8(spark, d):
    b = expression.blobs(_deltas(spark, d), warehouse.read(spark, d, "orders", "o_orderkey").count())
    return b.select("gene_id", "nnz", "fmt", F.sha2("payload", 256).alias("sha256"))


@query("c1_varints", f"with e as (select l_orderkey, l_linenumber, (l_orderkey*l_orderkey*l_partkey) % 4294967296 as delta from lineitem) select l_orderkey, l_linenumber, {_BYTES} as code from e")
def c1(spark, d):
    v = codec.product_u32(F.col("l_orderkey"), F.col("l_orderkey"), F.col("l_partkey"))
    return warehouse.read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select("l_orderkey", "l_linenumber", F.lower(codec.varint_hex(v)).alias("code"))


@query("c2_varint_decode", "select l_orderkey, list(l_partkey*l_linenumber order by l_linenumber, l_partkey) as v from lineitem group by 1")
def c2(spark, d):
    li = warehouse.read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    code = li.groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", codec.varint_hex(F.col("l_partkey") * F.col("l_linenumber")).alias("h")))), lambda x: x["h"]), "").alias("h"))
    return code.select("l_orderkey", codec.varint_decode(F.col("h")).alias("v"))


@query("f4_quantise", "select l_orderkey, l_linenumber, least(greatest(round_even((l_extendedprice-1000.0e0)/(greatest(90000.0e0-1000.0e0,1e-9)/65535),0),0),65535)::int as q from lineitem")
def f4(spark, d):
    q = codec.quant_encode(F.col("l_extendedprice"), F.lit(1000.0), codec.quant_scale(F.lit(1000.0), F.lit(90000.0)))
    return warehouse.read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice").select("l_orderkey", "l_linenumber", q.alias("q"))


@query("f5_dequantise", "select p_partkey, round(7.0e0 + p_size*0.25e0,9) as v from part")
def f5(spark, d):
    return warehouse.read(spark, d, "part", "p_partkey", "p_size").select("p_partkey", F.round(codec.quant_decode(F.col("p_size"), F.lit(7.0), F.lit(0.25)), 9).alias("v"))


@query("f8_morton", """with v as (select l_orderkey, l_linenumber, (l_partkey*31)%65536 as x, (l_suppkey*977)%65536 as y from lineitem)
select l_orderkey, l_linenumber, list_sum(list_transform(range(16), lambda i: (((x>>i)&1) << (2*i)) + (((y>>i)&1) << (2*i+1))))::bigint as z from v""")
def f8(spark, d):
    return warehouse.read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", codec.morton((F.col("l_partkey") * 31) % 65536, (F.col("l_suppkey") * 977) % 65536).alias("z"))
