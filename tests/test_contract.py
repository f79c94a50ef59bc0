"""The driver's contract: names, columns, and results against the SQL on the smallest data."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from loomtable.plans import registry

DATA = Path("/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.skipif(not DATA.exists(), reason="no data")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, sql, name):
    df = registry.queries()[name](spark, str(DATA))
    found = sql.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(df.columns)
    want = sorted(tuple(plain(row[names.index(c)]) for c in order) for row in found.fetchall())
    assert sorted(tuple(plain(row[c]) for c in order) for row in df.collect()) == want


@pytest.mark.skipif(not DATA.exists(), reason="no data")
@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_queries_without_sql_run(spark, name):
    df = registry.queries()[name](spark, str(DATA))
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
