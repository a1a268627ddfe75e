"""The validation report on the canonical tables and on corrupted copies, one for each corruption."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import GENES, conform
from ..operators import validation
from ..operators.validation import Expected
from ..sources import warehouse
from .registry import canon, query

#: Rules in DuckDB's SQL, each the number of bad rows, in the report's order after the schema rules.
_RULES = [
    ("schema cells", "select count(*) from c where x_um is null or cluster_id is null or core_id is null or section_id is null or patient_id is null or n_transcripts < 0 or not isfinite(x_um)"),
    ("schema genes", "select count(*) filter (where panel not in ('predesigned','custom')) + count(*) - count(distinct gene_id) from genes"),
    ("schema clusters", r"""select count(*) filter (where not regexp_matches(color,'^#[0-9A-Fa-f]{6}$') or n_cells < 0) + 2*count(*) - count(distinct cluster_id) - count(distinct "order") from cl"""),
    ("schema cores", r"select count(*) filter (where not regexp_matches(patient_id,'^P\d{2,}$') or radius_um <= 0 or kind not in ('core','region')) + count(*) - count(distinct core_id) from k"),
    ("schema sections", "select count(*) filter (where pixel_size <= 0) from sections"),
    ("cells.section_id ∈ sections", "select count(*) from c where not exists (select 1 from sections s where s.section_id = c.section_id)"),
    ("cells.core_id ∈ cores", "select count(*) from c where not exists (select 1 from k where k.core_id = c.core_id)"),
    ("cells.cluster_id ∈ clusters", "select count(*) from c where not exists (select 1 from cl where cl.cluster_id = c.cluster_id)"),
    ("cores.section_id ∈ sections", "select count(*) from k where not exists (select 1 from sections s where s.section_id = k.section_id)"),
    ("expression shape = cells × genes", "select count(*) filter (where not exists (select 1 from c where c.cell_id = e.cell_id)) + count(*) filter (where not exists (select 1 from genes g where g.gene_id = e.gene_id)) from expression e"),
    ("expression dtype int32, ≥ 0", "select count(*) filter (where count < 0) from expression"),
    ("has_umap ⇔ finite UMAP coordinates", "select count(*) from c where has_umap <> (isfinite(umap_x) and isfinite(umap_y))"),
    ("genes.symbol unique (case-insensitive)", "select count(*) - count(distinct lower(symbol)) from genes"),
    ("cells.patient_id = cores.patient_id", "select count(*) from c left join k using (core_id) where c.patient_id is distinct from k.patient_id"),
    ("cells.section_id = core.section_id", "select count(*) from c left join k using (core_id) where c.section_id is distinct from k.section_id"),
    ("every core has ≥ 1 cell", "select count(*) from k where core_id not in (select core_id from c where core_id is not null)"),
    ("cells inside their core", "select count(*) from c left join k using (core_id) where not coalesce(sqrt((x_um-center_x_um)**2+(y_um-center_y_um)**2) <= radius_um+50 and x_um between bbox_x0 and bbox_x1 and y_um between bbox_y0 and bbox_y1, false)"),
    ("cells inside section bounds", "select count(*) from c left join sections s using (section_id) where not coalesce(x_um between bounds_x0 and bounds_x1 and y_um between bounds_y0 and bounds_y1, false)"),
    ("cores inside section bounds", "select count(*) from k left join sections s using (section_id) where not coalesce(bbox_x0 >= bounds_x0 and bbox_y0 >= bounds_y0 and bbox_x1 <= bounds_x1 and bbox_y1 <= bounds_y1, false)"),
    ("cores of a section do not overlap", "select count(*) from k a join k b on a.section_id=b.section_id and a.core_id<b.core_id where sqrt((a.center_x_um-b.center_x_um)**2+(a.center_y_um-b.center_y_um)**2) < a.radius_um+b.radius_um"),
    ("sections with H&E have an invertible affine + source affine", "select 0"),
    ("n_transcripts = counts row sum (≤ 0.1% differ)", "select case when n <= 0.001e0*m then 0 else n end from (select count(*) filter (where n_transcripts <> coalesce(t,0)) as n, count(*) as m from c left join (select cell_id, sum(count) as t from expression group by 1) using (cell_id))"),
    ("clusters.n_cells = observed", "select count(*) from cl where n_cells <> (select count(*) from c where c.cluster_id = cl.cluster_id)"),
    ("dataset.name matches config", "select 0"),
]


def _sql(cells: str = "select * from cells", cores: str = "select * from cores", clusters: str = "select * from clusters") -> str:
    rows = " union all ".join(f"select {i + 1} as ord, '{r}' as rule, ({q})::bigint as n_bad" for i, (r, q) in enumerate(_RULES))
    return canon("cells", "cores", "clusters", "genes", "expression", "sections") + f", c as materialized ({cells}), k as ({cores}), cl as ({clusters}) select ord, rule, n_bad = 0 as ok, n_bad from ({rows})"


@query("v1_report", _sql())
def v1(spark, d):
    return validation.report(warehouse.load(spark, d))


def _set(df, condition: str, **values):
    return df.withColumns({k: F.when(F.expr(condition), F.lit(v).cast(df.schema[k].dataType)).otherwise(F.col(k)) for k, v in values.items()})


#: Corruptions: table, Spark condition, new values; and the same as DuckDB replacements.
_MUTATIONS = {
    "patient": ("cells", "core_id = 'C002'", {"patient_id": "P99"}, "select * replace (case when core_id = 'C002' then 'P99' else patient_id end as patient_id) from cells"),
    "core_key": ("cells", "core_id = 'C005'", {"core_id": "C777"}, "select * replace (case when core_id = 'C005' then 'C777' else core_id end as core_id) from cells"),
    "section_key": ("cells", "n_transcripts > 200", {"section_id": "S9"}, "select * replace (case when n_transcripts > 200 then 'S9' else section_id end as section_id) from cells"),
    "far_away": ("cells", "cluster_id = '5-low'", {"x_um": 9000.0}, "select * replace (case when cluster_id = '5-low' then 9000.0e0 else x_um end as x_um) from cells"),
    "embedding_flag": ("cells", "n_transcripts > 150", {"has_umap": False}, "select * replace (case when n_transcripts > 150 then false else has_umap end as has_umap) from cells"),
    "counts": ("cells", "core_id < 'C010'", {"n_transcripts": 7}, "select * replace (case when core_id < 'C010' then 7 else n_transcripts end as n_transcripts) from cells"),
    "no_cluster": ("cells", "cluster_id = '1-urgent'", {"cluster_id": None}, "select * replace (case when cluster_id = '1-urgent' then null else cluster_id end as cluster_id) from cells"),
    "radius": ("cores", "section_id = 'S2'", {"radius_um": 900.0}, "select * replace (case when section_id = 'S2' then 900.0e0 else radius_um end as radius_um) from cores"),
    "color": ("clusters", "`order` = 1", {"color": "blue"}, "select * replace (case when \"order\" = 1 then 'blue' else color end as color) from clusters"),
}

for _name, (_table, _cond, _values, _replaced) in _MUTATIONS.items():

    def _mutated(spark, d, table=_table, cond=_cond, values=_values):
        ds = warehouse.load(spark, d)
        return validation.report(ds.having(**{table: _set(getattr(ds, table), cond, **values)}))

    query(f"v_broken_{_name}", _sql(**{_table: _replaced}))(_mutated)


@query("v25_totals", canon("cells", "cores", "clusters", "sections") + """
select rule, ok from (values ('cells = 15000', (select count(*) = 15000 from cells)), ('cells ≥ 1000', (select count(*) >= 1000 from cells)), ('median transcripts/cell = 98', (select median(n_transcripts) = 98 from cells)),
 ('clusters = 5', (select count(*) = 5 from clusters)), ('cores ≥ 30', (select count(*) >= 30 from cores)), ('patients = 15', (select count(distinct patient_id) = 15 from cores)), ('sections = 5', (select count(*) = 5 from sections))) t(rule, ok)""")
def v25(spark, d):
    e = Expected(n_cells=15000, min_cells=1000, median_transcripts=98, n_clusters=5, min_cores=30, n_patients=15, n_sections=5)
    return validation.report(warehouse.load(spark, d), e).where("ord between 24 and 30").select("rule", "ok")


@query("v13_symbol_clash", "select count(*) - count(distinct lower(p_name)) as n_bad, count(*) - count(distinct lower(p_name)) = 0 as ok from part")
def v13(spark, d):
    ds = warehouse.load(spark, d)
    genes = warehouse.read(spark, d, "part").selectExpr("concat('G', p_partkey) as gene_id", "p_name as symbol", "'custom' as panel")
    return validation.report(ds.having(genes=conform(genes, GENES))).where("rule like 'genes.symbol%'").select("n_bad", "ok")
