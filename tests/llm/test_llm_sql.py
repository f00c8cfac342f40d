"""Registered queries with SQL against DuckDB; all queries give stable columns."""

import duckdb
import pytest

import __spark_entry__ as E
from ticketlens.llm import queries as Q

TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    yield con
    con.close()


def test_registered():
    names = set(E.queries())
    assert set(Q.queries()) <= names
    assert "pipeline" in names
    assert {n.split("_")[0] for n in Q.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(Q.oracle_sql()) <= set(Q.queries())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, sf_dir, duck, name):
    df = Q.queries()[name](spark, sf_dir)
    res = duck.execute(Q.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr(tuple(r[columns.index(c)] for c in df.columns)) for r in res.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == want
