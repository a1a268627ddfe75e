"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

#: The canonical tables in DuckDB's SQL, by name; each uses those before it.
CANON = {
    "sections": "select 'S' || (r_regionkey+1) as section_id, 0.0e0 as bounds_x0, 0.0e0 as bounds_y0, 6500.0e0 as bounds_x1, 5000.0e0 as bounds_y1, 0.2125e0 as pixel_size from region",
    "cores": """select 'C' || lpad((n_nationkey+1)::varchar,3,'0') as core_id, 'S' || (n_regionkey+1) as section_id, 'P' || lpad((n_nationkey%15+1)::varchar,2,'0') as patient_id, 'core' as kind,
        1000.0e0+((n_nationkey//5)%3+0.5e0)*1500.0e0 as center_x_um, 1000.0e0+(((n_nationkey//5)//3)+0.5e0)*1500.0e0 as center_y_um, 500.0e0 as radius_um,
        1000.0e0+((n_nationkey//5)%3+0.5e0)*1500.0e0-500 as bbox_x0, 1000.0e0+(((n_nationkey//5)//3)+0.5e0)*1500.0e0-500 as bbox_y0,
        1000.0e0+((n_nationkey//5)%3+0.5e0)*1500.0e0+500 as bbox_x1, 1000.0e0+(((n_nationkey//5)//3)+0.5e0)*1500.0e0+500 as bbox_y1 from nation""",
    "cells": r"""select o_orderkey::varchar as cell_id, 'S' || (n_regionkey+1) as section_id, 'C' || lpad((n_nationkey+1)::varchar,3,'0') as core_id, 'P' || lpad((n_nationkey%15+1)::varchar,2,'0') as patient_id,
        1000.0e0+((n_nationkey//5)%3+0.5e0)*1500.0e0+(o_totalprice/500000.0e0*2-1)*350.0e0 as x_um,
        1000.0e0+(((n_nationkey//5)//3)+0.5e0)*1500.0e0+(date_diff('day', date '1995-01-01', o_orderdate::date)/4000.0e0*2-1)*350.0e0 as y_um,
        case when e.n is not null then ln(1.0e0+e.n)::float else 'nan'::float end as umap_x, case when e.n is not null then e.disc::float else 'nan'::float end as umap_y,
        e.n is not null as has_umap, trim(regexp_replace(lower(o_orderpriority),'[^\p{L}\p{N}]+','-','g'),'-') as cluster_id, coalesce(e.n,0)::int as n_transcripts
        from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
        left join (select l_orderkey as k, sum(l_quantity)::int as n, 10.0e0*sum(round_even(l_discount*100,0))/(100.0e0*count(*)) as disc from lineitem group by 1) e on e.k=o_orderkey""",
    "genes": """select 'G' || p_partkey as gene_id, case when rn > 1 then p_name || '-' || rn else p_name end as symbol, case when p_brand like 'Brand#1%' then 'predesigned' else 'custom' end as panel
        from (select *, row_number() over (partition by lower(p_name) order by p_partkey) as rn from part)""",
    "expression": "select l_orderkey::varchar as cell_id, 'G' || l_partkey as gene_id, sum(l_quantity)::int as count from lineitem group by l_orderkey, l_partkey",
    "clusters": r"""select l.cluster_id, l.label, ['#1F77B4','#FF7F0E','#2CA02C','#D62728','#9467BD','#8C564B','#E377C2','#7F7F7F'][((row_number() over (order by lower(l.label)='unassigned', coalesce(c.n,0) desc, l.label))-1)%8+1] as color,
        ((row_number() over (order by lower(l.label)='unassigned', coalesce(c.n,0) desc, l.label))-1)::smallint as "order", coalesce(c.n,0)::int as n_cells
        from (select distinct o_orderpriority as label, trim(regexp_replace(lower(o_orderpriority),'[^\\p{L}\\p{N}]+','-','g'),'-') as cluster_id from orders) l left join (select cluster_id, count(*) as n from cells group by 1) c using (cluster_id)""".replace("\\\\p", "\\p"),
    "quant": "select section_id, least(bounds_x0,bounds_y0) as q_offset, greatest(greatest(bounds_x1,bounds_y1)-least(bounds_x0,bounds_y0),1e-9)/65535 as q_scale from sections",
    "coded": "select c.*, least(greatest(round_even((x_um-q_offset)/q_scale,0),0),65535)::int as qx, least(greatest(round_even((y_um-q_offset)/q_scale,0),0),65535)::int as qy, q_offset, q_scale from cells c join quant using (section_id)",
    "z1": "select *, qx::bigint as a0, qy::bigint as b0 from coded",
    "z2": "select *, (a0 | (a0<<8)) & 16711935 as a1, (b0 | (b0<<8)) & 16711935 as b1 from z1",
    "z3": "select *, (a1 | (a1<<4)) & 252645135 as a2, (b1 | (b1<<4)) & 252645135 as b2 from z2",
    "z4": "select *, (a2 | (a2<<2)) & 858993459 as a3, (b2 | (b2<<2)) & 858993459 as b3 from z3",
    "z5": "select *, ((a3 | (a3<<1)) & 1431655765) | (((b3 | (b3<<1)) & 1431655765) << 1) as morton from z4",
    "placed": "select z5.*, (row_number() over (order by z5.section_id, z5.core_id, morton, cell_id)) - 1 as idx from z5",
    "vals": "select cell_id, gene_id, count, case when tot > 0 then ln(1+10000.0e0*count/tot) else 0 end as v from (select *, sum(count) over (partition by cell_id) as tot from expression)",
    "quantised": "select *, case when max_v > 0 then greatest(1,least(255,round_even(255.0e0*v/max_v,0)))::int else 0 end as q from (select *, max(v) over (partition by gene_id) as max_v from vals)",
    "delta": "select gene_id, idx, idx - lag(idx,1,0) over (partition by gene_id order by idx) as delta, q from quantised join placed using (cell_id)",
}


def canon(*names: str) -> str:
    """WITH clause of the named canonical tables and all before them that they use."""
    need: list[str] = []

    def add(n: str) -> None:
        for other in CANON:
            if other != n and other not in need and f" {other}" in f" {CANON[n]} ".replace("\n", " ").replace("(", " ") and list(CANON).index(other) < list(CANON).index(n):
                add(other)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    return "with " + ", ".join(f"{n} as materialized ({CANON[n]})" for n in need) + " "


def query(name: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame; sql is its DuckDB equivalent."""

    def add(f: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add
