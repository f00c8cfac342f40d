"""Cube and states that follow a yearly table: what is counted again, and that answers stay those of the rows."""

import csv
import glob
import os

import pytest

from ticketlens.operators.distinct import distinct_counts, distinct_over
from ticketlens.plans import analyses as A
from ticketlens.plans.registry import queries
from ticketlens.schema import USED_COLUMNS
from ticketlens.sources import derived as D
from ticketlens.sources import yearly as Y

HEADER = list(USED_COLUMNS)


def _file(path, year, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        for n, (code, state, precinct) in enumerate(rows):
            row = {"Summons Number": 100 * year + n, "Issue Date": f"01/05/{year}", "Violation Code": code, "Registration State": state,
                   "Issuer Precinct": precinct, "Violation Precinct": precinct, "Violation Time": "0143A", "Vehicle Make": "FORD"}
            w.writerow([row.get(c, "") for c in HEADER])
    return str(path)


@pytest.fixture
def paths(tmp_path):
    return {
        2015: _file(tmp_path / "a.csv", 2015, [(21, "NY", 1), (21, "NJ", 2), (38, "99", 1), ("", "", "")]),
        2016: _file(tmp_path / "b.csv", 2016, [(14, "NY", 3), (14, "NY", 3), (21, "PA", 1)]),
        2017: _file(tmp_path / "c.csv", 2017, [(46, "NJ", 2), (21, "CT", 2)]),
    }


def _parts(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/cube/**/*.parquet", recursive=True)}


def _same(spark, target, cube, states):
    """The questions' answers from the cube are those from the rows."""
    _, clean = Y.open_years(spark, target)
    for question in (A.clean_counts, A.state_counts, A.top3_codes_by_time_bin, A.codes_in_top_precincts, A.season_counts):
        assert [tuple(r) for r in question(cube).collect()] == [tuple(r) for r in question(clean).collect()]
    want = {r["file_year"]: r["n_states"] for r in A.unique_states_by_year(clean).collect()}
    assert {r["file_year"]: r["n"] for r in distinct_counts(spark, states, "n").collect()} == want


def test_an_added_year_is_counted_alone(spark, tmp_path, paths):
    target, path = f"{tmp_path}/table", f"{tmp_path}/derived"
    Y.store_years(spark, {y: paths[y] for y in (2015, 2016)}, target)
    _same(spark, target, *D.follow(spark, target, path))
    before = _parts(path)
    Y.store_years(spark, paths, target)
    cube, states = D.follow(spark, target, path)
    _same(spark, target, cube, states)
    after = _parts(path)
    assert {f: after[f] for f in before} == before and all("file_year=2017" in f for f in set(after) - set(before))
    assert distinct_over(spark, states) == 4
    assert _parts(path) == after and D.follow(spark, target, path)[0].rows.count() == cube.rows.count()


def test_a_changed_year_replaces_its_part(spark, tmp_path, paths):
    target, path = f"{tmp_path}/table", f"{tmp_path}/derived"
    Y.store_years(spark, paths, target)
    D.follow(spark, target, path)
    _file(paths[2016], 2016, [(5, "99", 9)])
    Y.store_years(spark, paths, target)
    cube, states = D.follow(spark, target, path)
    _same(spark, target, cube, states)
    assert {r["file_year"] for r in distinct_counts(spark, states, "n").collect()} == {2015, 2017}


def test_a_killed_count_is_done_again(spark, tmp_path, paths, monkeypatch):
    target, path = f"{tmp_path}/table", f"{tmp_path}/derived"
    Y.store_years(spark, paths, target)
    with monkeypatch.context() as m:
        m.setattr(D, "add_years", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            D.follow(spark, target, path)
    assert D._done(spark, path) == set()
    _same(spark, target, *D.follow(spark, target, path))


def test_no_table(spark, tmp_path):
    with pytest.raises(ValueError):
        D.follow(spark, f"{tmp_path}/none", f"{tmp_path}/derived")


@pytest.mark.parametrize("name", ["csv_top_codes", "csv_unique_states"])
def test_questions_on_files_read_what_followed(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    assert df.inputFiles() and all("/followed-cube" in f for f in df.inputFiles())
    rows = {"csv_top_codes": "top3_codes", "csv_unique_states": "unique_states_by_year"}[name]
    assert [tuple(r) for r in df.collect()] == [tuple(r) for r in queries()[rows](spark, sf_dir).collect()]
