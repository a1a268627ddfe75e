"""The jobs as queries over whole tables: each runs twice into one new folder of the shared ones, and gives what is there then."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from cytoloom.operators.documents import DATE
from cytoloom.plans.registry import canon

from . import core_profiles, document_ledger


def folder(spark: SparkSession, name: str) -> str:
    """A new name below spark.checkpoint.dir; a local session without it (tests) gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='cytoloom-jobs-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def job1_core_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = folder(spark, "job1-core-profiles")
    core_profiles.run(spark, sf_dir, to)
    return core_profiles.run(spark, sf_dir, to)


def job2_document_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = folder(spark, "job2-document-ledger")
    documents = f"{sf_dir}/{{documents}}.parquet"  # a pattern, as the table may be one file and a stream's plain path must be a folder
    for _ in range(2):
        rows = document_ledger.run(spark, documents, to, f"{to}/checkpoint")
    return rows.drop("batch")  # how many files a batch takes is the folder's matter


JOB1_SQL = canon("cells", "vals") + """, g as (select section_id, core_id, cluster_id, count(*) as of_ from cells group by all)
select section_id, core_id, cluster_id, gene_id, count(*) as n_cells, sum(count)::bigint as counts, round(count(*) / of_::double, 6) as share, round(sum(v) / of_, 6) as mean_value
from vals join cells using (cell_id) join g using (section_id, core_id, cluster_id) where count > 0 group by section_id, core_id, cluster_id, gene_id, of_"""

_SLUG = r"coalesce(nullif(trim(regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}]+', '-', 'g'), '-'), ''), 'none')"
JOB2_SQL = f"""with d as (select *, coalesce(text, '') as t from documents)
select 'docs/' || {_SLUG.format("lang")} || '/' || coalesce(doc_id::varchar, 'none') || '.txt' as rel, {_SLUG.format("source")} as family, octet_length(encode(t))::bigint as bytes, sha256(t) as sha256, doc_id,
 case when t = '' then 0 else len(string_split(t, chr(10))) end::bigint as n_lines, len(list_filter(string_split(t, chr(10)), lambda x: length(x) > 1000))::bigint as n_long, len(regexp_extract_all(t, '{DATE}'))::bigint as n_dates from d"""

QUERIES = {"job1_core_profiles": job1_core_profiles, "job2_document_ledger": job2_document_ledger}
ORACLES = {"job1_core_profiles": JOB1_SQL, "job2_document_ledger": JOB2_SQL}
