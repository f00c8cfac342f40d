"""Physical-plan properties: one scan, no Python, no cross joins, pushed filters."""

import pytest

from ticketlens.plans import registry as E
from ticketlens.operators.clean import keep_issue_year
from ticketlens.plans import analyses as A
from ticketlens.sources.fixture import fixture_years, stored_clean, stored_tickets, tickets

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonMapInArrow")
CROSS_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")
TOP_K = {
    "top5_codes", "top5_body_types", "top5_makes", "top5_violation_precincts", "top5_issuer_precincts",
    "top3_codes", "top5_streets", "codes_in_top_precincts", "top3_codes_by_time_bin", "top3_codes_by_season", "revenue_top3",
}


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_plan(spark, sf_dir, name):
    plan = final_plan(E.queries()[name](spark, sf_dir))
    if name == "union_years":
        # one scan per yearly table, each pruned to its own year's folders
        assert plan.count("Scan parquet") == len(fixture_years(spark, sf_dir)) and "Union" in plan, plan
        # rows are counted before the rollup doubles anything
        assert plan.index("Expand") < plan.rindex("HashAggregate") < plan.index("Scan parquet"), plan
    elif name == "peak_year_precincts":
        assert plan.count("Scan parquet") == 3, plan  # the rows once, the cube for year and keys
    else:
        assert plan.count("Scan parquet") == 1, plan
    assert not any(n in plan for n in PYTHON_NODES), plan
    assert not any(n in plan for n in CROSS_NODES), plan
    if name in TOP_K:
        assert "WindowGroupLimit" in plan, plan


def test_fixture_scan_pushdown_and_big_join(spark, sf_dir):
    df = tickets(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan  # lineitem meets orders by a shuffle on the order key
    # column pruning: lineitem is read with 5 of its columns
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert (
        "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_shipdate"
        in formatted
    )


def test_clean_questions_prune_partitions(spark, sf_dir):
    formatted = spark._jvm.PythonSQLUtils.explainString(
        E.queries()["missing_address"](spark, sf_dir)._jdf.queryExecution(), "formatted"
    )
    assert "PartitionFilters: [isnotnull(in_file_year" in formatted
    assert "ReadSchema: struct<house_number:string,street_name:string>" in formatted


def test_yearly_tables_are_pruned_to_their_year(spark, sf_dir):
    df = E.queries()["union_years"](spark, sf_dir)
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    for y in fixture_years(spark, sf_dir):
        assert f"(file_year#" in formatted and f"= {y})" in formatted


def test_year_rule_is_no_join_key(spark, sf_dir):
    """Unstored, the year filter stays a filter: no date text is a sort key of the join."""
    plan = keep_issue_year(tickets(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert joins and sorts and not any("substring" in line.split("], [")[0] or "substring" in line.split("Inner")[0] for line in joins)
    assert not any("substring" in line or "date_format" in line for line in sorts), plan


JOINED = {
    "revenue_top3": E.queries()["revenue_top3"],
    "top_revenue_code": E.queries()["top_revenue_code"],
    "peak_year_precincts": E.queries()["peak_year_precincts"],
    "hist": lambda spark, sf_dir: A.hist(stored_clean(spark, sf_dir), "violation_code"),
}


@pytest.mark.parametrize("name", sorted(JOINED))
def test_small_sides_are_left_to_aqe(spark, sf_dir, name):
    logical = JOINED[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in logical, logical
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in final_plan(JOINED[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_code_overlap_counts_without_a_distinct_pass(spark, sf_dir):
    plan = E.queries()["code_overlap"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "distinct" not in plan.lower()


def test_histogram_has_no_window(spark, sf_dir):
    plan = E.queries()["hist_issuer_precinct"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_all_rows_reach_the_table(spark, sf_dir):
    assert stored_tickets(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
