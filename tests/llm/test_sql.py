"""Queries of this package against their SQL, run by another engine: on the sample, and on a table of odd rows."""

import glob
import os

import pytest

from loadkeeper.llm.queries import QUERIES, SQL
from tests.llm.conftest import FOLDER, ODD

duckdb = pytest.importorskip("duckdb")
NAMES = ("op11_spelling_variants", "op12_quality_rules", "op13_resampling")


def same(spark, folder, name):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    df, expected = QUERIES[name](spark, folder), con.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    mine = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    return mine, sorted(map(repr, expected.select(*[f'"{c}"' for c in columns]).fetchall()))


@pytest.mark.parametrize("name", NAMES)
def test_sample(spark, sample, name):
    mine, theirs = same(spark, FOLDER, name)
    assert mine == theirs and mine


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, docs, table, tmp_path, name):
    docs([*ODD, *((10 + i, f"Variants Variante variantes of wordings wordinge {i} " * 9) for i in range(30))]).write.parquet(str(tmp_path / "documents.parquet"))
    table("item_id bigint, text string", (1, "wordings of variants"), (2, None)).write.parquet(str(tmp_path / "benchmark.parquet"))
    mine, theirs = same(spark, str(tmp_path), name)
    assert mine == theirs
