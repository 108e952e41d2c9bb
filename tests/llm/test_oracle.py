"""Queries with SQL against DuckDB on the small tables, and every query's registration."""

import pathlib

import duckdb
import pytest

from wickworks.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).is_dir(), reason="no test data")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    theirs = con.sql(ORACLE[name])
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    assert columns == sorted(theirs.columns)
    ours = sorted(map(str, ([r[c] for c in columns] for r in df.collect())))
    expected = sorted(map(str, (list(r) for r in theirs.select(*columns).fetchall())))
    assert ours == expected


def test_one_query_for_each_operator():
    assert [k.split("_")[0] for k in QUERIES] == [*[f"op{n}" for n in range(1, 14)], "pipeline"]
