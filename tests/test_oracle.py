"""Every registered query against its DuckDB SQL on the driver fixture (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from ticketlens.plans.oracle import oracle_sql
from ticketlens.plans.registry import queries

TABLES = ("lineitem", "orders", "customer", "part")
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    fetched = res.fetchall()
    assert sorted(ocols) == sorted(df.columns)
    otypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == otypes
    idx = [ocols.index(c) for c in df.columns]
    orows = [tuple(_norm(r[i]) for i in idx) for r in fetched]
    srows = [tuple(_norm(v) for v in r) for r in df.collect()]
    assert _sorted(srows) == _sorted(orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["file_year", "time_bin", "violation_code", "n", "rk"]
    assert df.count() > 0
