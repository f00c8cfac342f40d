
from pyspark.sql import functions as F

from helpers import rows_of, ticket, tickets_df
from ticketlens.functions.exprs import season, time_bin
from ticketlens.operators.agg import histogram, ranked_within, top_k_per, within_top_groups
from ticketlens.operators.clean import (
    invalid_states,
    issue_years,
    keep_issue_year,
    missing_address,
    null_profile,
    without_state,
)
from ticketlens.plans import analyses as A


def test_m1_file_year_filter_and_issue_year_mode(spark):
    df = tickets_df(
        spark,
        [
            ticket(summons_number=1, file_year=2015, issue_date="03/01/2015"),
            ticket(summons_number=2, file_year=2015, issue_date="12/30/2014"),
            ticket(summons_number=3, file_year=2016, issue_date="01/02/2015"),
            ticket(summons_number=4, file_year=2016, issue_date="05/05/2016"),
        ],
    )
    assert rows_of(keep_issue_year(df), "summons_number") == [(1,), (4,)]
    retag = keep_issue_year(df, mode="issue_year", years=[2015, 2016])
    assert rows_of(retag, "summons_number", "file_year") == [(1, 2015), (3, 2015), (4, 2016)]


def test_issue_years_distinct_desc(spark):
    df = tickets_df(spark, [ticket(issue_date=d) for d in ("01/01/1970", "02/02/2069", "03/03/2015", "04/04/2015")])
    assert [r[0] for r in issue_years(df).collect()] == ["2069", "2015", "1970"]


def test_m2_m6_time_bins(spark):
    times = ["0143A", "0400A", "1159A", "1201P", "0330P", "0400P", "1100P", "1230A", "0012P", None, "12"]
    df = spark.createDataFrame([(t,) for t in times], "violation_time string")
    got = [r[0] for r in df.select(time_bin("violation_time")).collect()]
    assert got == [
        "Early_Morning_AM", "Morning_AM", "Before_Noon_AM", "After_Noon_PM", "After_Noon_PM",
        "Evening_PM", "Night_PM", None, None, None, None,
    ]
    got_else = [r[0] for r in df.select(time_bin("violation_time", otherwise="")).collect()]
    assert got_else[7:] == ["", "", "", ""]
    # the Column form gives the same bins
    col_form = [r[0] for r in df.select(time_bin(F.col("violation_time"))).collect()]
    assert col_form == got


def test_seasons(spark):
    dates = ["06/01/2015", "09/30/2015", "12/31/2015", "02/28/2015", "03/01/2015", "13/01/2015", None]
    df = spark.createDataFrame([(d,) for d in dates], "issue_date string")
    assert [r[0] for r in df.select(season("issue_date")).collect()] == [
        "Summer", "Fall", "Winter", "Winter", "Spring", None, None,
    ]


def test_m3_null_key_is_a_group_with_count_zero(spark):
    df = tickets_df(spark, [ticket(violation_code=None), ticket(violation_code=None), ticket(violation_code=5)])
    out = A.top_k_values(df, "violation_code", 5)
    assert rows_of(out, "violation_code", "n", "rk") == [(5, 1, 1), (None, 0, 2)]


def test_m4_not_equal_drops_null_states(spark):
    df = tickets_df(spark, [ticket(registration_state=s) for s in ("NY", "99", None, "NJ", "NY")])
    assert rows_of(without_state(df), "registration_state") == [("NJ",), ("NY",), ("NY",)]
    assert rows_of(A.unique_states_by_year(df), "n_states") == [(2,)]
    assert rows_of(A.state_counts(df), "registration_state", "n") == [("NJ", 1), ("NY", 2)]


def test_m5_state_patterns(spark):
    df = tickets_df(spark, [ticket(registration_state=s) for s in ("99", "9A", "N9", "NY", "ny", None, "1")])
    assert rows_of(invalid_states(df), "registration_state") == [("99",), ("ny",)]
    assert rows_of(invalid_states(df, strict=True), "registration_state") == [
        ("1",), ("99",), ("9A",), ("N9",), ("ny",),
    ]


def test_m7_blank_group_is_kept(spark):
    rows = [ticket(violation_code=21, violation_time=t) for t in ("0900A", "0930A", "1230A", None)]
    rows += [ticket(violation_code=38, violation_time="0100P")]
    df = tickets_df(spark, rows)
    out = A.time_bins_of_top_codes(df, k=3)
    assert rows_of(out, "time_bin", "n") == [("", 2), ("After_Noon_PM", 1), ("Before_Noon_AM", 2)]


def test_m8_dense_rank_keeps_ties_row_number_cuts_by_key(spark):
    counts = spark.createDataFrame(
        [(2015, 1, 10), (2015, 2, 8), (2015, 3, 5), (2015, 4, 5), (2015, 5, 1)],
        "file_year int, k int, n long",
    )
    assert rows_of(ranked_within(counts, "file_year", "n", 3), "k", "rk") == [(1, 1), (2, 2), (3, 3), (4, 3)]
    assert rows_of(top_k_per(counts, "file_year", "n", 3, "k"), "k", "rk") == [(1, 1), (2, 2), (3, 3)]


def test_m9_season_rank_by_code_count_but_shows_summons_count(spark):
    rows = [ticket(summons_number=None, violation_code=7, issue_date="07/01/2015") for _ in range(3)]
    rows += [ticket(summons_number=i, violation_code=9, issue_date="07/02/2015") for i in range(2)]
    df = tickets_df(spark, rows)
    out = A.top3_codes_by_season(df, k=1)
    assert rows_of(out, "season", "violation_code", "n", "rk") == [("Summer", 7, 0, 1)]


def test_m11_code_without_fine_gets_null_amount(spark):
    rows = [ticket(violation_code=1)] * 3 + [ticket(violation_code=2)] * 2 + [ticket(violation_code=3)]
    df = tickets_df(spark, rows)
    out = A.revenue_top3(df, {1: 10, 3: 100})
    assert rows_of(out, "violation_code", "cnt", "amount") == [(1, 3, 30), (2, 2, None), (3, 1, 100)]
    top = A.top_revenue_code(df, {1: 10, 3: 100})
    assert rows_of(top, "violation_code", "amount") == [(3, 100)]


def test_m13_null_profile_omits_zero_groups(spark):
    df = tickets_df(
        spark,
        [
            ticket(file_year=2015, violation_time=None),
            ticket(file_year=2015, violation_time=None, violation_code=None),
            ticket(file_year=2016),
        ],
    )
    assert rows_of(null_profile(df)) == [("violation_code", 2015, 1), ("violation_time", 2015, 2)]


def test_m14_missing_address_is_null_only(spark):
    df = tickets_df(
        spark,
        [
            ticket(house_number=None),
            ticket(street_name=None),
            ticket(house_number=None, street_name=None),
            ticket(house_number="", street_name=""),
        ],
    )
    assert rows_of(missing_address(df)) == [(2015, 3)]


def test_m15_no_hidden_limit(spark):
    states = [f"S{chr(65 + i % 26)}{i}" for i in range(40)]
    df = tickets_df(spark, [ticket(registration_state=s) for s in states])
    assert A.state_counts(df).count() == 40


def test_within_top_groups_null_key_takes_a_rank(spark):
    df = spark.createDataFrame(
        [(2015, None, 1, 9), (2015, 1, 1, 5), (2015, 2, 1, 3), (2015, 3, 1, 1)],
        "file_year int, p int, c int, w long",
    )
    kept = within_top_groups(df, "file_year", "p", "w", 2)
    assert rows_of(kept, "p") == [(1,)]


def test_histogram_edges_zero_fill_and_constant(spark):
    df = spark.createDataFrame(
        [(2015, v) for v in (0, 1, 2, 12)] + [(2016, 7), (2016, 7), (2016, None)],
        "file_year int, x int",
    )
    h = histogram(df, "x", nbins=12)
    got = {(r["file_year"], r["bin"]): (r["centroid"], r["n"]) for r in h.collect()}
    assert len(got) == 24
    # 2015: width 1, right-closed, minimum in bin 0
    assert got[(2015, 0)] == (0.5, 2)
    assert got[(2015, 1)] == (1.5, 1)
    assert got[(2015, 11)] == (11.5, 1)
    assert sum(n for (y, _), (_, n) in got.items() if y == 2015) == 4
    assert got[(2015, 5)][1] == 0
    # 2016: constant column, all in bin 0, NULL left out
    assert got[(2016, 0)] == (7.0, 2)
    assert all(n == 0 for (y, b), (_, n) in got.items() if y == 2016 and b > 0)
    # the continuous path gives the same counts
    h2 = histogram(df, "x", nbins=12, discrete=False)
    assert {(r["file_year"], r["bin"]): r["n"] for r in h2.collect()} == {k: v[1] for k, v in got.items()}


def test_histogram_double_column(spark):
    df = spark.createDataFrame([(2015, v) for v in (0.0, 0.5, 1.0)], "file_year int, x double")
    got = {r["bin"]: r["n"] for r in histogram(df, "x", nbins=2).collect()}
    assert got == {0: 2, 1: 1}


def test_histogram_null_groups_and_both_paths(spark):
    rows = [(None, 1), (None, 5), (2015, 2), (2015, None), (2016, 3)]
    df = spark.createDataFrame(rows, "file_year int, x int")
    a, b = (rows_of(histogram(df, "x", nbins=4, discrete=d)) for d in (True, False))
    assert a == b and sum(r[-1] for r in a) == 4 and len(a) == 3 * 4


def test_histogram_keeps_the_largest_double(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 1.0), (1, 1.6)], "file_year int, x double")
    assert sum(r["n"] for r in histogram(df, "x").collect()) == 3


def test_a_fine_listed_twice_counts_once(spark):
    import pytest

    from ticketlens.operators.joins import attach_fines

    df = spark.createDataFrame([(1, 10), (2, 20)], "violation_code int, cnt int")
    fines = spark.createDataFrame([(1, 55), (1, 55)], "violation_code int, fine int")
    assert rows_of(attach_fines(df, fines)) == [(1, 10, 55), (2, 20, None)]
    with pytest.raises(Exception, match="two fines for code 1"):
        attach_fines(df, fines.unionByName(spark.createDataFrame([(1, 60)], fines.schema))).collect()


def test_empty_input(spark):
    df = tickets_df(spark, [])
    assert A.top3_codes_by_time_bin(df).count() == 0
    assert A.revenue_top3(df, {1: 5}).count() == 0
    assert histogram(df, "violation_code").count() == 0
    assert null_profile(df).count() == 0


def test_histograms_in_one_scan_equal_single_ones(spark, sf_dir):
    from ticketlens.operators.agg import histograms
    from ticketlens.sources.fixture import stored_clean
    from ticketlens.sources.store import persisted

    clean = stored_clean(spark, sf_dir)
    cols = ["violation_code", "violation_precinct", "issuer_precinct"]
    together = histograms(clean, cols)
    got = {(r["column_name"], r["file_year"], r["bin"]): (r["centroid"], r["n"]) for r in together.collect()}
    plan = together._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    with persisted(clean.select("file_year", *cols)) as narrow:
        for c in cols:
            for r in histogram(narrow, c).collect():
                assert got[(c, r["file_year"], r["bin"])] == (r["centroid"], r["n"])
    assert len(got) == 3 * 7 * 12
    assert plan.count("Scan parquet") <= 1


def test_semi_join_form_equals_window_form(spark, sf_dir):
    """J1 as the reference shapes it (filter rows by the computed top
    precincts, then count) gives the rows of the one-scan window form."""
    from ticketlens.operators.agg import counts_by
    from ticketlens.operators.joins import semi_join_keys
    from ticketlens.sources.fixture import stored_clean

    clean = stored_clean(spark, sf_dir)
    top_precincts = top_k_per(counts_by(clean, ["file_year", "issuer_precinct"], "issuer_precinct"),
                              "file_year", "n", 3, "issuer_precinct")
    rows = semi_join_keys(clean, top_precincts, ["file_year", "issuer_precinct"])
    pairs = counts_by(rows, ["file_year", "issuer_precinct", "violation_code"], "violation_code")
    by_join = top_k_per(pairs, "file_year", "n", 10, ["issuer_precinct", "violation_code"])
    cols = ("file_year", "issuer_precinct", "violation_code", "n", "rk")
    assert rows_of(by_join, *cols) == rows_of(A.codes_in_top_precincts(clean), *cols)


def test_semi_join_keys_null_never_matches(spark):
    from ticketlens.operators.joins import semi_join_keys

    df = spark.createDataFrame([(1, None), (1, 2), (1, 3)], "file_year int, k int")
    keys = spark.createDataFrame([(1, None), (1, 2)], "file_year int, k int")
    assert rows_of(semi_join_keys(df, keys, ["file_year", "k"])) == [(1, 2)]
