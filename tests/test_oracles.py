"""Every registered query against its SQL, run by another engine on the same files."""

import glob
import os

import pytest

import __spark_entry__ as entry
from loadkeeper.plans.oracles import SQL
from loadkeeper.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample data is not here")
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow", "Window"):
        assert operator not in plan
    columns = sorted(df.columns)
    expected = duck.sql(entry.oracle_sql()[name])
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    for field in df.schema:
        shown = field.dataType.simpleString()
        assert types[field.name] == TYPES.get(shown, shown.upper())
    mine = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    theirs = sorted(map(repr, expected.select(*[f'"{c}"' for c in columns]).fetchall()))
    assert mine == theirs


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
