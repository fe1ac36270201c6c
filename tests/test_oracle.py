"""Every registered query with SQL gives the rows DuckDB gives on the same tables."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry
from rivulet.plans import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(rows, order):
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = result.fetchall()
    order = [columns.index(c) for c in df.columns]
    assert len(got) == len(expected)
    assert got, "a query without rows proves nothing"
    assert canonical(got, range(len(columns))) == canonical(expected, order)


def test_queries_without_sql_give_rows(spark):
    for name in set(QUERIES) - set(entry.oracle_sql()):
        assert entry.queries()[name](spark, SF_DIR).count() > 0, name


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_end", "item", "cnt", "rank"]
