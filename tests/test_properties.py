
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import ticket, tickets_df
from ticketlens.operators.agg import histogram
from ticketlens.operators.clean import keep_issue_year
from ticketlens.plans import analyses as A
from ticketlens.sources.fixture import FIXTURE_FINES, stored_tickets

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _map(df, key, val="n"):
    return {r[key]: r[val] for r in df.collect()}


def test_laws_on_fixture(spark, sf_dir):
    t = stored_tickets(spark, sf_dir)
    clean = keep_issue_year(t)
    stages = _map(A.row_counts(t), "stage")
    per_year = _map(A.ticket_count_by_year(clean), "file_year")
    # 1. year counts add up to the clean total
    assert sum(_map(A.clean_counts(clean), "file_year").values()) == stages["clean"]
    assert sum(per_year.values()) == stages["clean"] - clean.where("summons_number IS NULL").count()
    # 2. season counts add up to the year counts
    seasons = {}
    for r in A.season_counts(clean).collect():
        seasons[r["file_year"]] = seasons.get(r["file_year"], 0) + r["n"]
    assert seasons == per_year
    # 4. amount = cnt * fine
    for r in A.revenue_top3(clean, FIXTURE_FINES).collect():
        fine = FIXTURE_FINES.get(r["violation_code"])
        assert r["amount"] == (None if fine is None else r["cnt"] * fine)
    # 5. bins of the top codes, '' included, add up to the codes' total
    top = {}
    for r in A.top_k_values(clean, "violation_code", 3).collect():
        top[r["file_year"]] = top.get(r["file_year"], 0) + r["n"]
    bins = {}
    for r in A.time_bins_of_top_codes(clean).collect():
        bins[r["file_year"]] = bins.get(r["file_year"], 0) + r["n"]
    assert bins == top
    # union total row equals the loaded rows
    union = {r["file_year"]: r["n"] for r in A.union_years([t.where(f"file_year = {y}") for y in range(1995, 2002)]).collect()}
    assert union[None] == stages["loaded"] == sum(v for k, v in union.items() if k is not None)


times = st.one_of(
    st.none(),
    st.builds(
        lambda h, m, ap: f"{h:02d}{m:02d}{ap}",
        st.integers(0, 12),
        st.integers(0, 59),
        st.sampled_from("AP"),
    ),
)
rows = st.lists(
    st.builds(
        lambda y, month, code, t, prec: ticket(
            file_year=y,
            issue_date=f"{month:02d}/15/{y}",
            violation_code=code,
            violation_time=t,
            issuer_precinct=prec,
        ),
        st.sampled_from([2015, 2016]),
        st.integers(1, 12),
        st.one_of(st.none(), st.integers(1, 6)),
        times,
        st.one_of(st.none(), st.integers(0, 4)),
    ),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(rows)
def test_generated_laws(spark, data):
    df = tickets_df(spark, data)
    # histogram bins add up to the non-NULL count per year
    hist = {}
    for r in histogram(df, "violation_code", nbins=5).collect():
        hist[r["file_year"]] = hist.get(r["file_year"], 0) + r["n"]
    expect = {}
    for d in data:
        if d["violation_code"] is not None:
            expect[d["file_year"]] = expect.get(d["file_year"], 0) + 1
    assert hist == expect
    # top codes' bins ('' included) add up to the codes' total
    top = {}
    for r in A.top_k_values(df, "violation_code", 3).collect():
        if r["violation_code"] is not None:
            top[r["file_year"]] = top.get(r["file_year"], 0) + r["n"]
    bins = {}
    for r in A.time_bins_of_top_codes(df).collect():
        bins[r["file_year"]] = bins.get(r["file_year"], 0) + r["n"]
    assert bins == top


@SETTINGS
@given(rows)
def test_input_order_does_not_matter(spark, data):
    a = A.codes_in_top_precincts(tickets_df(spark, data)).collect()
    b = A.codes_in_top_precincts(tickets_df(spark, list(reversed(data)))).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.one_of(st.none(), st.integers(1, 3)), st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))),
        min_size=1,
        max_size=40,
    ),
    nbins=st.integers(1, 15),
)
def test_histogram_counts_every_value(spark, rows, nbins):
    df = spark.createDataFrame(rows, "file_year int, x double")
    a = sorted(map(repr, histogram(df, "x", nbins=nbins).collect()))
    b = sorted(map(repr, histogram(df, "x", nbins=nbins, discrete=False).collect()))
    assert a == b
    total = {}
    for r in histogram(df, "x", nbins=nbins).collect():
        total[r["file_year"]] = total.get(r["file_year"], 0) + r["n"]
    want = {}
    for y, x in rows:
        if x is not None:
            want[y] = want.get(y, 0) + 1
    assert total == want
