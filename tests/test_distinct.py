"""Bitmaps of distinct values: added years, replaced years, unions."""

import glob
import os

from ticketlens.operators.distinct import add_years, distinct_counts, distinct_over
from ticketlens.plans import analyses as A
from ticketlens.plans.registry import queries
from ticketlens.sources.fixture import stored_clean


def frame(spark, rows):
    return spark.createDataFrame(rows, "file_year int, state string")


def told(spark, path):
    return {r["file_year"]: r["n"] for r in distinct_counts(spark, path, "n").collect()}


def test_an_added_year_reads_the_new_year_only(spark, tmp_path):
    path = f"{tmp_path}/states"
    add_years(spark, path, frame(spark, [(2015, "NY"), (2015, "NJ"), (2015, "NY"), (2015, None), (2016, "NY")]), "state")
    assert told(spark, path) == {2015: 2, 2016: 1}
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bitmaps/by=*/*.parquet")}
    # The call has no row of an older year.
    add_years(spark, path, frame(spark, [(2017, "NJ"), (2017, "PA"), (2017, "#1"), (2017, "pa"), (2017, "")]), "state")
    assert told(spark, path) == {2015: 2, 2016: 1, 2017: 5}
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bitmaps/by=*/*.parquet")}
    assert {f: after[f] for f in before} == before
    assert distinct_over(spark, path) == 6 and distinct_over(spark, path, [2015, 2016]) == 2 and distinct_over(spark, path, [1999]) == 0


def test_a_year_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/states"
    add_years(spark, path, frame(spark, [(2015, "NY"), (2015, "NJ"), (2016, "NY")]), "state")
    add_years(spark, path, frame(spark, [(2015, "CT"), (2016, None)]), "state")
    assert told(spark, path) == {2015: 1} and distinct_over(spark, path) == 1
    add_years(spark, path, frame(spark, []), "state")
    assert told(spark, path) == {2015: 1}


def test_many_values_stay_exact_and_dense(spark, tmp_path):
    path = f"{tmp_path}/plates"
    for year in (2015, 2016, 2017):
        rows = spark.range(20_000).selectExpr(f"{year} AS file_year", f"concat('P', id + {year % 2015 * 10_000}) AS state")
        add_years(spark, path, rows.unionAll(rows.limit(500)), "state")
    assert told(spark, path) == {2015: 20_000, 2016: 20_000, 2017: 20_000}
    assert distinct_over(spark, path) == 40_000 and distinct_over(spark, path, [2015, 2016]) == 30_000
    values = spark.read.parquet(f"{path}/values")
    numbers = [r[0] for r in values.selectExpr("place * 64 + deal").collect()]
    assert len(set(numbers)) == 40_000 and max(numbers) < 60_000


def test_the_question_equals_the_rows(spark, sf_dir):
    want = [tuple(r) for r in A.unique_states_by_year(stored_clean(spark, sf_dir)).collect()]
    df = queries()["unique_states_by_year"](spark, sf_dir)
    assert [tuple(r) for r in df.collect()] == want
    assert all("/bitmaps/by=" in f for f in df.inputFiles())
