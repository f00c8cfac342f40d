"""Ranked questions against a plain-Python brute force on generated frames."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import ticket, tickets_df
from ticketlens.plans import analyses as A

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def py_time_bin(t):
    if t is None:
        return None
    hour, mark = int(t[0:2]), t[4:5]
    if mark == "A":
        names = ["Early_Morning_AM", "Morning_AM", "Before_Noon_AM"]
        return names[hour // 4] if hour < 12 else None
    if mark == "P":
        names = ["After_Noon_PM", "Evening_PM", "Night_PM"]
        return names[hour % 12 // 4] if hour > 0 else None
    return None


def nulls_last(v):
    return (v is None, v if v is not None else 0)


def brute_time_bins(rows, k=3):
    counts = Counter()
    for r in rows:
        b = py_time_bin(r["violation_time"])
        if b is None:
            continue
        key = (r["file_year"], b, r["violation_code"])
        counts[key] += 0 if r["violation_code"] is None else 1
    out = []
    groups = {}
    for (y, b, c), n in counts.items():
        groups.setdefault((y, b), []).append((c, n))
    for (y, b), items in groups.items():
        distinct = sorted({n for _, n in items}, reverse=True)
        for c, n in items:
            rk = distinct.index(n) + 1
            if rk <= k:
                out.append((y, b, c, n, rk))
    return sorted(out, key=lambda t: tuple(nulls_last(x) for x in t))


def brute_top_pairs(rows, n_precincts=3, k=10):
    out = []
    for y in {r["file_year"] for r in rows}:
        yr = [r for r in rows if r["file_year"] == y]
        per_p = Counter()
        for r in yr:
            per_p[r["issuer_precinct"]] += 0 if r["issuer_precinct"] is None else 1
        ranked = sorted(per_p.items(), key=lambda kv: (-kv[1], nulls_last(kv[0])))
        top = {p for p, _ in ranked[:n_precincts] if p is not None}
        pairs = Counter()
        for r in yr:
            if r["issuer_precinct"] in top:
                pairs[(r["issuer_precinct"], r["violation_code"])] += 0 if r["violation_code"] is None else 1
        best = sorted(pairs.items(), key=lambda kv: (-kv[1], nulls_last(kv[0][0]), nulls_last(kv[0][1])))[:k]
        out += [(y, p, c, n, i + 1) for i, ((p, c), n) in enumerate(best)]
    return sorted(out, key=lambda t: tuple(nulls_last(x) for x in t))


times = st.one_of(
    st.none(),
    st.builds(lambda h, m, ap: f"{h:02d}{m:02d}{ap}", st.integers(0, 12), st.integers(0, 59), st.sampled_from("AP")),
)
rows = st.lists(
    st.builds(
        lambda y, code, t, prec: ticket(file_year=y, issue_date=f"01/01/{y}", violation_code=code,
                                        violation_time=t, issuer_precinct=prec),
        st.sampled_from([2015, 2016]),
        st.one_of(st.none(), st.integers(1, 5)),
        times,
        st.one_of(st.none(), st.integers(0, 5)),
    ),
    min_size=1,
    max_size=60,
)


def spark_rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(nulls_last(x) for x in t))


@SETTINGS
@given(rows)
def test_time_bin_ranks_match_brute_force(spark, data):
    got = spark_rows(A.top3_codes_by_time_bin(tickets_df(spark, data)),
                     ("file_year", "time_bin", "violation_code", "n", "rk"))
    assert got == brute_time_bins(data)


@SETTINGS
@given(rows)
def test_top_pairs_match_brute_force(spark, data):
    got = spark_rows(A.codes_in_top_precincts(tickets_df(spark, data)),
                     ("file_year", "issuer_precinct", "violation_code", "n", "rk"))
    assert got == brute_top_pairs(data)


SEASON_OF = {"06": "Summer", "07": "Summer", "08": "Summer", "09": "Fall", "10": "Fall", "11": "Fall",
             "12": "Winter", "01": "Winter", "02": "Winter", "03": "Spring", "04": "Spring", "05": "Spring"}

season_rows = st.lists(
    st.builds(
        lambda y, month, code, summons: ticket(file_year=y, issue_date=f"{month:02d}/10/{y}",
                                               violation_code=code, summons_number=summons),
        st.sampled_from([2015, 2016]),
        st.integers(1, 13),
        st.one_of(st.none(), st.integers(1, 4)),
        st.one_of(st.none(), st.integers(1, 10**6)),
    ),
    min_size=1,
    max_size=60,
)


def brute_season_ranks(rows, k=3):
    n_summons, n_code = Counter(), Counter()
    for r in rows:
        s = SEASON_OF.get(r["issue_date"][0:2])
        if s is None:
            continue
        key = (r["file_year"], s, r["violation_code"])
        n_summons[key] += 0 if r["summons_number"] is None else 1
        n_code[key] += 0 if r["violation_code"] is None else 1
    groups = {}
    for (y, s, c), n in n_code.items():
        groups.setdefault((y, s), []).append((c, n))
    out = []
    for (y, s), items in groups.items():
        distinct = sorted({n for _, n in items}, reverse=True)
        for c, n in items:
            rk = distinct.index(n) + 1
            if rk <= k:
                out.append((y, s, c, n_summons[(y, s, c)], rk))
    return sorted(out, key=lambda t: tuple(nulls_last(x) for x in t))


@SETTINGS
@given(season_rows)
def test_season_ranks_match_brute_force(spark, data):
    got = spark_rows(A.top3_codes_by_season(tickets_df(spark, data)),
                     ("file_year", "season", "violation_code", "n", "rk"))
    assert got == brute_season_ranks(data)


def brute_bins_of_top_codes(rows, k=3):
    out = Counter()
    for y in {r["file_year"] for r in rows}:
        yr = [r for r in rows if r["file_year"] == y]
        per_code = Counter()
        for r in yr:
            per_code[r["violation_code"]] += 0 if r["violation_code"] is None else 1
        ranked = sorted(per_code.items(), key=lambda kv: (-kv[1], nulls_last(kv[0])))
        top = {c for c, _ in ranked[:k] if c is not None}
        for r in yr:
            if r["violation_code"] in top:
                out[(y, py_time_bin(r["violation_time"]) or "")] += 1
    return sorted((y, b, n) for (y, b), n in out.items())


def brute_revenue(rows, fines, k=3):
    out = []
    for y in {r["file_year"] for r in rows}:
        cnt = Counter(r["violation_code"] for r in rows
                      if r["file_year"] == y and r["violation_code"] is not None and r["issue_date"] is not None)
        for c, n in sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:k]:
            out.append((y, c, n, None if c not in fines else n * fines[c]))
    return sorted(out)


@SETTINGS
@given(rows)
def test_bins_of_top_codes_match_brute_force(spark, data):
    got = sorted(tuple(r) for r in A.time_bins_of_top_codes(tickets_df(spark, data)).select(
        "file_year", "time_bin", "n").collect())
    assert got == brute_bins_of_top_codes(data)


@SETTINGS
@given(rows)
def test_revenue_matches_brute_force(spark, data):
    fines = {1: 55, 2: 115, 4: 50}
    got = sorted(tuple(r) for r in A.revenue_top3(tickets_df(spark, data), fines).select(
        "file_year", "violation_code", "cnt", "amount").collect())
    assert got == brute_revenue(data, fines)
