"""How often large tables are gone through: rows that pass a step in front of them are counted."""

from pyspark.sql import functions as F

from cytoloom.operators import derive, validation
from cytoloom.sources import warehouse
from jobs import core_profiles


def watched(df):
    """df and an accumulator of the rows that were read of it."""
    n = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), n


def test_report_goes_through_cells_once_and_counts_twice(spark, sf):
    ds = warehouse.load(spark, sf)
    n_cells, n_counts = ds.cells.count(), ds.expression.count()
    plain = validation.report(ds).orderBy("ord").collect()
    cells, seen = watched(ds.cells)
    counts, met = watched(ds.expression)
    assert validation.report(ds.having(cells=cells, expression=counts)).orderBy("ord").collect() == plain
    assert seen.value == n_cells and met.value <= 2 * n_counts


def test_report_of_repeated_stray_and_nameless_rows(spark, sf):
    ds = warehouse.load(spark, sf)
    some = ds.cells.limit(3)
    nameless = some.withColumn("cell_id", F.lit(None).cast("string"))
    stray = spark.createDataFrame([("none", "G1", 1), ("none", "G2", -1), (None, "G1", 1), ("1", "none", 2), ("1", None, 2)], ds.expression.schema)
    plain = {r["rule"]: r["n_bad"] for r in validation.report(ds).collect()}
    got = {r["rule"]: r["n_bad"] for r in validation.report(ds.having(cells=ds.cells.unionByName(some).unionByName(nameless), expression=ds.expression.unionByName(stray))).collect()}
    assert got["schema cells"] == plain["schema cells"] + 3 + 3 + 2  # repeats of names, no name, repeats of no name
    assert got["expression shape = cells × genes"] == plain["expression shape = cells × genes"] + 3 + 2
    assert got["expression dtype int32, ≥ 0"] == plain["expression dtype int32, ≥ 0"] + 1
    none = {r["rule"]: r["n_bad"] for r in validation.report(ds.having(cells=ds.cells.limit(0), expression=ds.expression.limit(0))).collect()}
    assert none["every core has ≥ 1 cell"] == ds.cores.count() and none["cells inside their core"] == 0


def test_derived_cells_are_cut_once(spark, sf):
    ds = warehouse.load(spark, sf)
    cells, seen = watched(ds.cells)
    made = derive.derive(ds.having(cells=cells), derive.Plan(seed=3, radius=250.0, sections=2, min_cores=6))
    before = seen.value
    validation.report(made).collect()
    assert seen.value == before


def test_profiles_shuffle_values_twice(spark, sf):
    rows = core_profiles.profiles(warehouse.load(spark, sf))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(section_id" not in plan and plan.count("Exchange hashpartitioning") == 2  # by cell, by group and gene; cells are few here
