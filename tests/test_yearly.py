"""Durable yearly tables: added, changed and damaged years, broken records, types over parts."""

import csv
import glob
import os
import shutil

import pytest
from pyspark.sql import types as T

from ticketlens.schema import EXTRA_COLUMNS, TICKET_COLUMNS, USED_COLUMNS
from ticketlens.sources import yearly as Y
from ticketlens.sources.csv import read_years
from ticketlens.sources.types import stated, wider

HEADER = [*USED_COLUMNS, "Plate ID", "Feet From Curb"]


def _row(n, year, **more):
    row = {"Summons Number": str(n), "Issue Date": f"01/05/{year}", "Violation Code": "21", "Violation Time": "0143A", "Vehicle Make": "FORD"}
    return row | {"Plate ID": f"P{n}", "Feet From Curb": "0"} | more


def _file(path, rows, header=HEADER):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow(r if isinstance(r, list) else [r.get(c, "") for c in header])
    return str(path)


@pytest.fixture
def years(tmp_path):
    def make(*names, n=3):
        return {y: _file(tmp_path / f"{y}.csv", [_row(10 * y + i, y) for i in range(n)]) for y in names}

    return make


def _data(target):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{target}/data/**/*.parquet", recursive=True)}


def _numbers(df):
    return sorted(r["summons_number"] for r in df.collect())


def test_a_year_more(spark, tmp_path, years):
    target = f"{tmp_path}/table"
    first, _ = Y.store_years(spark, years(2015, 2016), target)
    before = _data(target)
    everything, clean = Y.store_years(spark, years(2015, 2016) | years(2017), target)
    # The rewritten source files differ in their time only when they are written again; here they were.
    assert everything.count() == 9 and clean.count() == 9 and first.count() == 6
    assert set(before) <= set(_data(target))
    assert tuple(everything.columns) == TICKET_COLUMNS


def test_no_old_folder_is_written_again(spark, tmp_path, years):
    target, two, one = f"{tmp_path}/table", years(2015, 2016), years(2017)
    Y.store_years(spark, two, target)
    before = _data(target)
    everything, _ = Y.store_years(spark, two | one, target)
    after = _data(target)
    assert {f: after[f] for f in before} == before
    assert all("file_year=2017" in f for f in set(after) - set(before)) and len(after) > len(before)
    assert _numbers(everything) == [10 * y + i for y in (2015, 2016, 2017) for i in range(3)]
    # Asked for one year, the table gives that year and keeps the others.
    only, _ = Y.store_years(spark, one, target)
    assert _numbers(only) == [20170, 20171, 20172] and _data(target) == after
    assert Y.open_years(spark, target)[0].count() == 9


def test_a_changed_file_is_read_again(spark, tmp_path, years):
    target, paths = f"{tmp_path}/table", years(2015, 2016)
    old, _ = Y.store_years(spark, paths, target)
    _file(paths[2016], [_row(7, 2016)])
    before = _data(target)
    new, _ = Y.store_years(spark, paths, target)
    assert _numbers(new) == [7, 20150, 20151, 20152]
    assert all("file_year=2016" in f for f in set(_data(target)) - set(before))
    assert old.count() == 6  # who reads the older state goes on


def test_content_knows_copied_files(spark, tmp_path, years):
    target, paths = f"{tmp_path}/table", years(2015)
    Y.store_years(spark, paths, target, content=True)
    before = _data(target)
    os.utime(paths[2015], (1, 1))
    Y.store_years(spark, paths, target, content=True)
    assert _data(target) == before
    text = open(paths[2015]).read().replace("FORD", "FIAT")
    open(paths[2015], "w").write(text)
    os.utime(paths[2015], (1, 1))
    rows, _ = Y.store_years(spark, paths, target, content=True)
    assert {r["vehicle_make"] for r in rows.collect()} == {"FIAT"}


def test_other_columns_are_read_anew(spark, tmp_path, years):
    target, paths = f"{tmp_path}/table", years(2015, 2016)
    used, _ = Y.store_years(spark, paths, target)
    every, _ = Y.store_years(spark, paths, target, columns="all")
    assert "plate_id" not in used.columns and {"plate_id", "feet_from_curb"} <= set(every.columns)
    assert sorted(r["plate_id"] for r in every.collect()) == [f"P{10 * y + i}" for y in (2015, 2016) for i in range(3)]


def test_a_killed_load_is_never_read(spark, tmp_path, years, monkeypatch):
    target, paths = f"{tmp_path}/table", years(2015, 2016)
    Y.store_years(spark, {2015: paths[2015]}, target)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Y, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            Y.store_years(spark, paths, target)
    assert any("file_year=2016" in f for f in _data(target))
    assert Y.open_years(spark, target)[0].count() == 3
    assert Y.store_years(spark, paths, target)[0].count() == 6


def test_a_killed_first_load_blocks_nothing(spark, tmp_path, years, monkeypatch):
    target, paths = f"{tmp_path}/table", years(2015)
    with monkeypatch.context() as m:
        m.setattr(Y, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            Y.store_years(spark, paths, target)
    with pytest.raises(Y.DamagedTable):
        Y.open_years(spark, target)
    assert Y.store_years(spark, paths, target)[0].count() == 3


@pytest.mark.parametrize("how", ["missing", "cut", "more"])
def test_damaged_data_is_refused_and_loaded_again(spark, tmp_path, years, how):
    target, paths = f"{tmp_path}/table", years(2015, 2016)
    Y.store_years(spark, paths, target)
    victim = next(f for f in _data(target) if "file_year=2015" in f)
    if how == "missing":
        os.remove(victim)
    elif how == "cut":
        with open(victim, "r+b") as f:
            f.truncate(50)
    else:
        shutil.copy(victim, victim.replace("part-", "part-9"))
    with pytest.raises(Y.DamagedTable, match="2015"):
        Y.open_years(spark, target)
    kept = {f for f in _data(target) if "file_year=2016" in f}
    assert Y.store_years(spark, paths, target)[0].count() == 6
    assert {f for f in _data(target) if "file_year=2016" in f} == kept
    assert Y.open_years(spark, target)[0].count() == 6


def test_two_writers_are_told(spark, tmp_path, years):
    target, paths = f"{tmp_path}/table", years(2015)
    Y.store_years(spark, paths, target)
    number, entries = Y._latest(spark, target)
    with pytest.raises(RuntimeError, match="two writers"):
        Y._commit(spark, target, number, entries)


def test_clean_rows_are_folders(spark, tmp_path):
    path = _file(tmp_path / "a.csv", [_row(1, 2015), _row(2, 2014), _row(3, 2015, **{"Issue Date": ""})])
    everything, clean = Y.store_years(spark, {2015: path}, f"{tmp_path}/table")
    assert _numbers(everything) == [1, 2, 3] and _numbers(clean) == [1]
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(in_file_year" in plan


def test_an_empty_file(spark, tmp_path):
    everything, clean = Y.store_years(spark, {2015: _file(tmp_path / "a.csv", [])}, f"{tmp_path}/table")
    assert everything.collect() == clean.collect() == []
    assert tuple(everything.columns) == TICKET_COLUMNS


def test_broken_records(spark, tmp_path):
    plain = [_row(1, 2015), _row(2, 2015, **{"Street Name": 'A, "B" and C'})]
    path = _file(tmp_path / "a.csv", plain)
    n = len(HEADER)
    lines = [",".join(["3"] + [""] * n), ",".join(["4"] + [""] * (n - 2)), '5,"x' + "," * (n - 2), "6"]
    with open(path, "a") as f:
        f.write("\n".join(lines) + "\n")
        f.write("\n".join(",".join(_row(9, 2015, **{"Violation Code": "bad"}).get(c, "") for c in HEADER) for _ in range(2)) + "\n")
    target = f"{tmp_path}/table"
    kept, _ = Y.store_years(spark, {2015: path, 2016: _file(tmp_path / "b.csv", [_row(8, 2016)])}, target)
    clean_of, _ = Y.store_years(spark, {2015: path}, target, broken="quarantine")
    assert _numbers(kept) == [1, 2, 3, 4, 5, 6, 8, 9, 9]  # the reference's reading: as far as it goes
    assert _numbers(clean_of) == [1, 2, 9, 9]
    found = sorted((r["reason"], r["record"]) for r in Y.broken_records(spark, target).collect())
    assert found == sorted(zip(["too long", "too short", "open quote", "too short"], lines, strict=True))
    assert all(r["source_file"].endswith("a.csv") and r["file_year"] == 2015 for r in Y.broken_records(spark, target).collect())
    report = {r["file_year"]: (r["rows"], r["broken"], r["unreadable"]) for r in Y.load_report(spark, target).collect()}
    assert report == {2015: (8, 4, {"violation_code": 2}), 2016: (1, 0, {})}
    with pytest.raises(ValueError):
        Y.store_years(spark, {2015: path}, target, broken="drop")


# --- types over parts --------------------------------------------------------------

INT, LONG, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def test_wider_types():
    dec = T.DecimalType
    assert wider(INT, LONG) == LONG and wider(LONG, DOUBLE) == DOUBLE and wider(INT, INT) == INT
    assert wider(LONG, dec(25, 0)) == dec(25, 0) and wider(dec(5, 2), INT) == dec(12, 2) and wider(dec(38, 0), dec(20, 10)) == DOUBLE
    assert wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert wider(T.BooleanType(), INT) == wider(T.DateType(), INT) == wider(TEXT, DOUBLE) == TEXT
    assert wider(None, INT) == wider(INT, None) == INT and wider(None, None) is None
    kinds = [None, INT, LONG, DOUBLE, dec(25, 0), TEXT, T.DateType(), T.TimestampType(), T.BooleanType()]
    for a in kinds:
        for b in kinds:
            assert wider(a, b) == wider(b, a)
    assert stated([{"a": INT, "b": None}, {"a": TEXT}, {"b": LONG, "c": None}]) == {"a": TEXT, "b": LONG, "c": None}


def _typed(tmp_path):
    one = _file(tmp_path / "one.csv", [_row(1, 2015, **{"Plate ID": "007", "Feet From Curb": "4"})])
    two = _file(tmp_path / "two.csv", [_row(2, 2015, **{"Plate ID": "A12", "Feet From Curb": "0.5"})], list(reversed(HEADER)))
    return one, two


def test_parts_with_other_types_have_one_stated_type(spark, tmp_path):
    one, two = _typed(tmp_path)
    alone = read_years(spark, {2015: one}, columns="all", infer_schema=True)
    assert dict(alone.dtypes)["plate_id"] == "int" and dict(alone.dtypes)["feet_from_curb"] == "int"
    for paths in ({2015: [one, two]}, {2015: two, 2016: one}):
        both = read_years(spark, paths, columns="all", infer_schema=True)
        kinds = dict(both.dtypes)
        assert kinds["plate_id"] == "string" and kinds["feet_from_curb"] == "double" and kinds["violation_code"] == "int"
        rows = {r["summons_number"]: (r["plate_id"], r["feet_from_curb"]) for r in both.collect()}
        assert rows == {1: ("007", 4.0), 2: ("A12", 0.5)}


def test_a_column_without_values_widens_nothing(spark, tmp_path):
    empty = _file(tmp_path / "e.csv", [_row(3, 2015, **{"Plate ID": "", "Feet From Curb": ""})], list(reversed(HEADER)))
    one, _ = _typed(tmp_path)
    rows = read_years(spark, {2015: [one, empty]}, columns="all", infer_schema=True)
    assert dict(rows.dtypes)["plate_id"] == "int" and _numbers(rows) == [1, 3]


def test_a_new_part_widens_an_old_year(spark, tmp_path):
    """The year that was stored as numbers is read again, so its text is the file's."""
    one, two = _typed(tmp_path)
    target = f"{tmp_path}/table"
    Y.store_years(spark, {2015: one}, target, columns="all", infer_schema=True)
    rows, _ = Y.store_years(spark, {2015: one, 2016: two}, target, columns="all", infer_schema=True)
    assert {r["summons_number"]: (r["plate_id"], r["feet_from_curb"]) for r in rows.collect()} == {1: ("007", 4.0), 2: ("A12", 0.5)}
    before = _data(target)
    Y.store_years(spark, {2015: one, 2016: two}, target, columns="all", infer_schema=True)
    assert _data(target) == before


def test_years_with_other_carried_columns(spark, tmp_path):
    a = _file(tmp_path / "a.csv", [_row(1, 2015)], [*HEADER, *EXTRA_COLUMNS])
    b = _file(tmp_path / "b.csv", [_row(2, 2016)], [*USED_COLUMNS, "Plate ID"])
    rows, _ = Y.store_years(spark, {2015: a, 2016: b}, f"{tmp_path}/table", columns="all")
    assert {r["summons_number"]: (r["plate_id"], r["feet_from_curb"]) for r in rows.collect()} == {1: ("P1", "0"), 2: ("P2", None)}
    assert not {"latitude", "bin"} & set(rows.columns)


def test_csv_ingest_grew_by_a_year(spark, sf_dir):
    from ticketlens.plans.registry import queries
    from ticketlens.sources import roundtrip

    queries()["csv_ingest"](spark, sf_dir).collect()
    _, target = roundtrip._stored(spark, sf_dir)
    assert Y._latest(spark, target)[0] == 2
    last = max(r["file_year"] for r in Y.load_report(spark, target).collect())
    assert all(f"file_year={last}" in f for f in _data(target.removeprefix("file:")) if os.stat(f).st_mtime_ns == max(_data(target.removeprefix("file:")).values()))


def test_storage_is_released_after_errors(spark, monkeypatch, tmp_path):
    """The table that is kept while the files are written is let go, also if a write fails."""
    from ticketlens.sources import roundtrip
    from helpers import ticket, tickets_df

    def kept():
        return spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    df, before = tickets_df(spark, [ticket(summons_number=3), ticket(summons_number=4)]), kept()
    roundtrip.write_yearly_csv(df, [2015], f"{tmp_path}/fine")
    assert kept() == before
    with pytest.raises(Exception):
        roundtrip.write_yearly_csv(df, [2015], f"{tmp_path}/fine")  # the folders are there
    assert kept() == before


def test_sums_beyond_a_bigint(spark):
    """Millions of long summons numbers in a year add up to more than a bigint holds; small sums stay one."""
    from helpers import ticket, tickets_df
    from ticketlens.plans import analyses as A
    from ticketlens.sources import roundtrip

    many = [ticket(summons_number=n, file_year=y) for n, y in ((2**62, 2015), (2**62, 2015), (5, 2015), (7, 2016), (None, 2017))]
    for rows, kind, want in ((many, "decimal(38,0)", {2015: 2**63 + 5, 2016: 7, 2017: None}), (many[2:], "bigint", {2015: 5, 2016: 7, 2017: None})):
        df = tickets_df(spark, rows)
        for got in (roundtrip.profiled(df), A.code_lookup(df, [21], [19])):
            assert dict(got.dtypes)["sum_summons"] == kind
            assert {r["file_year"]: r["sum_summons"] for r in got.collect()} == want


def test_a_year_is_written_by_several_tasks(spark, tmp_path):
    """No task gathers a year for the CSV files: each writes the rows that it reads."""
    from helpers import ticket, tickets_df
    from ticketlens.sources import roundtrip

    df = tickets_df(spark, [ticket(summons_number=n, file_year=2015 + n % 2, street_name="A" * (1 + n % 4 // 2)) for n in range(400)]).repartition(4)
    paths = roundtrip.write_yearly_csv(df, [2015, 2016], str(tmp_path))
    assert [len(paths[y]) for y in (2015, 2016)] == [2, 3]
    for year, of in paths.items():
        assert all(len(glob.glob(f"{p}/*.csv")) >= 4 for p in of[:2])
        assert sorted(r["summons_number"] for r in read_years(spark, {year: of[:2]}).collect()) == [n for n in range(400) if 2015 + n % 2 == year]


def test_years_are_inferred_side_by_side(spark, tmp_path, monkeypatch):
    """The passes over one year's text don't wait for those over another's."""
    import threading

    both, own = threading.Barrier(2, timeout=60), Y.inferred
    monkeypatch.setattr(Y, "inferred", lambda *given: (both.wait(), own(*given))[1])
    paths = {y: _file(tmp_path / f"{y}.csv", [_row(1, y, **{"Feet From Curb": feet})]) for y, feet in ((2015, "1"), (2016, "2.5"))}
    rows, _ = Y.store_years(spark, paths, f"{tmp_path}/table", columns="all", infer_schema=True)
    assert {r["file_year"]: r["feet_from_curb"] for r in rows.collect()} == {2015: 1.0, 2016: 2.5}
