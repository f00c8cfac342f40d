"""Lookups: a semi join on the rows with pruning, and files laid out by code and precinct."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ticketlens.operators.agg import top_k_per
from ticketlens.plans import analyses as A
from ticketlens.plans.registry import LOOKUP_CODES, LOOKUP_PRECINCTS, queries
from ticketlens.sources.fixture import stored_clean, stored_cube
from ticketlens.sources.layout import LOOKUP_COLS, indexed, ordered


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_semi_join_prunes_the_years(spark, sf_dir):
    plan = final_plan(queries()["peak_year_precincts"](spark, sf_dir))
    assert "LeftSemi" in plan and "dynamicpruning" in plan.lower(), plan


def test_semi_join_equals_keys_by_hand(spark, sf_dir):
    clean = stored_clean(spark, sf_dir)
    years = {r[0]: r[1] for r in clean.groupBy("file_year").count().collect()}
    peak = min(years, key=lambda y: (-years[y], y))
    rows = clean.where(F.col("file_year") == peak)
    tops = rows.where("issuer_precinct IS NOT NULL").groupBy("issuer_precinct").count().collect()
    want = {r[0]: r[1] for r in sorted(tops, key=lambda r: (-r[1], r[0]))[:3]}
    for source in (clean, stored_cube(spark, sf_dir)):
        got = A.peak_year_precincts(clean, source).collect()
        assert {r["issuer_precinct"]: r["n"] for r in got} == want and {r["file_year"] for r in got} == {peak}
    assert top_k_per is not None


def test_lookup_lists_reach_the_scan(spark, sf_dir):
    df = queries()["code_lookup"](spark, sf_dir)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "In(violation_code" in pushed and "In(issuer_precinct" in pushed
    rows = [r for r in stored_clean(spark, sf_dir).collect() if r["violation_code"] in LOOKUP_CODES and r["issuer_precinct"] in LOOKUP_PRECINCTS]
    assert sum(r["n"] for r in df.collect()) == len(rows) > 0


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """80,000 rows in files of several small row groups, in lookup order and as they come."""
    base = tmp_path_factory.mktemp("layout")
    rows = spark.range(0, 80_000, 1, 2).select(
        (F.col("id") * 7919 % 1_000_003).alias("summons_number"),
        (F.xxhash64("id") % 50).cast("int").alias("violation_code"),
        (F.xxhash64("id", F.lit(1)) % 30).cast("int").alias("issuer_precinct"),
        F.md5(F.col("id").cast("string")).alias("street_name"),
    )
    indexed(ordered(rows).write, row_group_bytes=200_000).parquet(f"{base}/ordered")
    indexed(rows.write, bloom=(), row_group_bytes=200_000).parquet(f"{base}/plain")
    return base


def groups(folder):
    """Row groups of a table as (file, number, ranges by column)."""
    for f in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            columns = (meta.row_group(g).column(c) for c in range(meta.num_columns))
            yield {c.path_in_schema: c.statistics for c in columns}


def share(folder, code):
    every = list(groups(folder))
    return sum(g["violation_code"].min <= code <= g["violation_code"].max for g in every) / len(every), len(every)


def rows_read(df):
    """Rows that the scans of a run query gave out, after they passed over row groups and pages."""
    df.collect()
    out, queue = 0, [df._jdf.queryExecution().executedPlan()]
    while queue:
        node = queue.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            queue.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            queue.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            out += node.metrics().apply("numOutputRows").value()
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return out


def test_a_lookup_reads_few_row_groups(spark, laid_out):
    ordered_share, n = share(f"{laid_out}/ordered", 17)
    plain_share, _ = share(f"{laid_out}/plain", 17)
    assert n >= 10 and ordered_share <= 0.2 and plain_share == 1.0
    want = spark.read.parquet(f"{laid_out}/plain").where("violation_code = 17")
    got = spark.read.parquet(f"{laid_out}/ordered").where("violation_code = 17")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert rows_read(got) <= 0.2 * 80_000 < rows_read(want)


def test_two_keys_read_fewer(spark, laid_out):
    one = spark.read.parquet(f"{laid_out}/ordered").where("violation_code = 17")
    both = one.where("issuer_precinct = 4")
    assert 0 < both.count() <= rows_read(both) <= rows_read(one)


def test_bloom_filters_find_single_tickets(spark, laid_out):
    table = spark.read.parquet(f"{laid_out}/ordered")
    inside = [r[0] for r in table.select("summons_number").limit(3).collect()]
    for number in inside:
        found = table.where(F.col("summons_number") == number)
        assert found.count() == 1 and rows_read(found) <= 0.5 * 80_000
    lowest, highest = table.agg(F.min("summons_number"), F.max("summons_number")).first()
    missing = next(x for x in range(lowest + 1, highest) if x not in {r[0] for r in table.select("summons_number").collect()})
    absent = table.where(F.col("summons_number") == missing)
    # a plain range says nothing here; the filters pass over nearly every group
    assert absent.count() == 0 and rows_read(absent) <= 0.2 * 80_000


def test_the_citation_table_is_laid_out(spark, sf_dir):
    for f in stored_clean(spark, sf_dir).inputFiles()[:4]:
        table = pq.read_table(f.removeprefix("file://"), columns=list(LOOKUP_COLS), partitioning=None).to_pylist()
        keys = [tuple((r[c] is not None, r[c] or 0) for c in LOOKUP_COLS) for r in table]
        assert keys == sorted(keys)
