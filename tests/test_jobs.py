"""The two jobs: repeated runs, growing input, configurations, command lines."""

import hashlib
import logging
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from cytoloom.operators.validation import ContractError
from cytoloom.sources import warehouse
from jobs import common, core_profiles, document_ledger, queries

ROOT = str(Path(__file__).parent.parent)
TABLES = "region nation customer supplier part orders lineitem documents".split()


def plain(v):
    return repr(round(v, 7) + 0.0) if isinstance(v, float) else str(v)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("name", ["job1_core_profiles", "job2_document_ledger"])
def test_query(name, spark, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    kept = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df, want = queries.QUERIES[name](spark, sf), con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns) and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == kept
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(tuple(plain(v) for v in r) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_profiles_of_some_sections_replace_these_alone(spark, sf, tmp_path, caplog):
    caplog.set_level(logging.INFO, "jobs")
    out = str(tmp_path / "out")
    whole = rows(core_profiles.run(spark, sf, out))
    first = {p.name for p in (tmp_path / "out").glob("section_id=S1/*.parquet")}
    spark.range(1).selectExpr("'C001' as core_id", "'x' as cluster_id", "'G1' as gene_id", "1L as n_cells", "1L as counts", "1.0D as share", "1.0D as mean_value").write.mode("append").parquet(f"{out}/section_id=S2")
    assert len(rows(spark.read.parquet(out))) == len(whole) + 1  # what a run that was cut off may have left
    caplog.clear()
    assert rows(core_profiles.run(spark, sf, out, core_profiles.Config(sections=["S2"]))) == whole
    assert {p.name for p in (tmp_path / "out").glob("section_id=S1/*.parquet")} == first
    said = caplog.text
    assert "rules of the contract hold" in said and "section_id=S2" in said and said.count("from before") == len({r[0] for r in whole}) - 1


def test_profiles_parameters_and_gate(spark, sf, tmp_path):
    ds = warehouse.load(spark, sf)
    some = core_profiles.profiles(ds, min_cells=2)
    assert 0 < some.count() < core_profiles.profiles(ds).count() and some.where("n_cells < 2 or share > 1 or mean_value <= 0").count() == 0
    with pytest.raises(ValueError, match="S99"):
        core_profiles.run(spark, sf, str(tmp_path / "out"), core_profiles.Config(sections=["S99"]))
    for t in TABLES[:7]:
        (tmp_path / f"{t}.parquet").symlink_to(f"{sf}/{t}.parquet")
    (tmp_path / "customer.parquet").unlink()
    warehouse.read(spark, sf, "customer").unionByName(warehouse.read(spark, sf, "customer").limit(1)).write.parquet(str(tmp_path / "customer.parquet"))  # its cells come twice
    with pytest.raises(ContractError, match="schema cells"):
        core_profiles.run(spark, str(tmp_path), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    assert core_profiles.run(spark, str(tmp_path), str(tmp_path / "out"), core_profiles.Config(check_contract=False)).limit(1).count() == 1


DOCS = [(1, "one line", "en", "Src A"), (2, "two\nlines " + "é" * 1200, "en", "Src A"), (3, None, "fr", None), (4, "", None, "--"), (5, "on 2024-05-01, 1 May 2024\n", "en", "b")]


def arrive(spark, folder, docs):
    spark.createDataFrame(docs, document_ledger.DOCUMENTS).coalesce(1).write.mode("append").parquet(folder)


def test_ledger_takes_only_what_is_new(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO, "jobs")
    here, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    arrive(spark, here, DOCS[:3])
    one = rows(document_ledger.run(spark, here, out, checkpoint))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [r[:9] for r in one] == [
        ("docs/en/1.txt", "src-a", 8, digest(DOCS[0][1]), 1, 1, 0, 0, 0), ("docs/en/2.txt", "src-a", 10 + 2400, digest(DOCS[1][1]), 2, 2, 1, 0, 0), ("docs/fr/3.txt", "none", 0, digest(""), 3, 0, 0, 0, 0),
    ]
    files = {p.name for p in (tmp_path / "out/ledger").rglob("*.parquet")}
    caplog.clear()
    assert rows(document_ledger.run(spark, here, out, checkpoint)) == one and "nothing new" in caplog.text
    arrive(spark, here, DOCS[3:])
    caplog.clear()
    two = rows(document_ledger.run(spark, here, out, checkpoint))
    assert "batch 1, 2 documents" in caplog.text and "batch 0" not in caplog.text
    assert [r for r in two if r[-1] == 0] == one and [(r[0], r[1], r[5], r[7]) for r in two if r[-1] == 1] == [("docs/en/5.txt", "b", 2, 2), ("docs/none/4.txt", "none", 0, 0)]
    assert files <= {p.name for p in (tmp_path / "out/ledger").rglob("*.parquet")}  # what was there is as it was
    sums = {r["family"]: r for r in spark.read.parquet(f"{out}/families").collect()}
    assert (sums["none"]["files"], sums["none"]["contents"], sums["src-a"]["n_long"], sums["b"]["n_dates"]) == (2, 1, 1, 2) and all(r["within"] for r in sums.values())


def test_ledger_repeats_a_batch_that_was_cut_off(spark, tmp_path):
    here, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    arrive(spark, here, DOCS)
    whole = rows(document_ledger.run(spark, here, out, checkpoint))
    for p in (tmp_path / "checkpoint/commits").glob("*0*"):  # as if the job had ended after its write and before its mark
        p.unlink()
    assert rows(document_ledger.run(spark, here, out, checkpoint)) == whole


def test_ledger_in_small_batches_is_the_same(spark, tmp_path):
    here = str(tmp_path / "in")
    for d in DOCS:
        arrive(spark, here, [d])
    a = document_ledger.run(spark, here, str(tmp_path / "a"), str(tmp_path / "ca"))
    b = document_ledger.run(spark, here, str(tmp_path / "b"), str(tmp_path / "cb"), document_ledger.Config(files_per_batch=2, max_family_bytes=100))
    assert rows(a.drop("batch")) == rows(b.drop("batch")) and b.select("batch").distinct().count() == 3
    assert [r["family"] for r in spark.read.parquet(str(tmp_path / "b/families")).where("not within").collect()] == ["src-a"]


def test_ledger_before_the_first_document(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert document_ledger.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")).count() == 0


def test_configurations(spark, tmp_path):
    for module, name in ((core_profiles, "core_profiles"), (document_ledger, "document_ledger")):
        given = common.config(spark, module.Config, f"{ROOT}/jobs/{name}.toml")
        assert {k: list(v) if isinstance(v, tuple) else v for k, v in vars(given).items()} == {k: list(v) if isinstance(v, tuple) else v for k, v in vars(module.Config()).items()}
    (tmp_path / "x.toml").write_text("min_cell = 3\n")
    with pytest.raises(ValueError, match="min_cell"):
        common.config(spark, core_profiles.Config, str(tmp_path / "x.toml"))


def test_command_line(tmp_path, spark):
    arrive(spark, str(tmp_path / "in"), DOCS)
    args = [sys.executable, "-m", "jobs.document_ledger", "--documents", "in", "--out", "out", "--checkpoint", "checkpoint"]
    args = [str(tmp_path / a) if a in ("in", "out", "checkpoint") else a for a in args] + ["--config", f"{ROOT}/jobs/document_ledger.toml"]
    done = subprocess.run(args, cwd=ROOT, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0 and "5 documents" in done.stderr and "family=src-a: 2 documents" in done.stderr, done.stderr[-2000:]
    assert spark.read.parquet(str(tmp_path / "out/ledger")).count() == 5
