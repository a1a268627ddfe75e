"""Every query that has SQL gives the rows of its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 7) + 0.0)
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", [n for n in entry.catalog.QUERIES if n in entry.catalog.ORACLES])
def test_query(name, spark, sf, duck):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted(tuple(plain(v) for v in r) for r in df.select(*cols).collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry_has_rows(spark, sf):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
