"""The queries over the smallest data: their columns, their keys, and their SQL where there is some."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from loomtable.llm import queries as llm_queries

DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "p1_found": [("table_name", "string"), ("record_id", "bigint")],
    "p2_found": [("table_name", "string"), ("record_id", "bigint")],
    "p3_found": [("record_id", "bigint")],
    "p4_found": [("table_name", "string"), ("record_id", "bigint")],
    "p5_found": [("record_id", "bigint"), ("field_name", "string"), ("pii_type", "string")],
    "p6_found": [("table_name", "string"), ("key_lo", "bigint"), ("key_hi", "bigint")],
    "p7_found": [("record_id", "bigint"), ("school_id", "string")],
    "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p10_found": [("doc_id", "bigint")],
}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no data")


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_one_row_for_each_case(spark, name):
    df = __spark_entry__.queries()[name](spark, str(DATA))
    assert df.dtypes == COLUMNS[name]
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert len(rows) == len(set(rows))
    if name == "p8_ids":
        assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(set(llm_queries.QUERIES) - set(COLUMNS) - set(llm_queries.SQL)))
def test_other_queries_run(spark, name):
    assert __spark_entry__.queries()[name](spark, str(DATA)).count() > 0


@pytest.mark.parametrize("name", sorted(llm_queries.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    found = con.execute(llm_queries.SQL[name])
    names = [d[0] for d in found.description]
    df = llm_queries.QUERIES[name](spark, str(DATA))
    order = sorted(df.columns)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    want = sorted(tuple(plain(row[names.index(c)]) for c in order) for row in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in order) for r in df.collect()) == want
