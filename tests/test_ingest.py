"""CSV ingest: header scan, 51 vs 43 columns, drift, order change, typing."""

import csv

import pytest

from ticketlens.operators.clean import keep_issue_year
from ticketlens.plans import analyses as A
from ticketlens.schema import EXTRA_COLUMNS, TICKET_COLUMNS, USED_COLUMNS
from ticketlens.sources.csv import conform, read_year_csv, read_years, register_views, schema_drift, union_years

NAMED = list(USED_COLUMNS)
FILLER = [f"Extra {i:02d}" for i in range(1, 33)]
BASE = NAMED[:3] + FILLER[:10] + NAMED[3:] + FILLER[10:]  # 43 columns, names interleaved


def _row(summons, date, code, time, state="NY", house="12", street="MAIN"):
    values = {
        "Summons Number": summons,
        "Registration State": state,
        "Issue Date": date,
        "Violation Code": code,
        "Violation Time": time,
        "Violation Precinct": "19",
        "Issuer Precinct": "19",
        "House Number": house,
        "Street Name": street,
        "Vehicle Body Type": "SUBN",
        "Vehicle Make": "FORD",
    }
    return values


def _write(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for r in rows:
            w.writerow([r.get(c, "x") if r.get(c) is not None else "" for c in header])


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    wide = BASE + list(EXTRA_COLUMNS)
    p15, p16, p17 = d / "fy2015.csv", d / "fy2016.csv", d / "fy2017.csv"
    _write(p15, wide, [_row("1", "01/05/2015", "21", "0143A"), _row("2", "12/31/2014", "38", "0900A"),
                       _row("3", "02/01/2015", "bad", None, house=None)])
    _write(p16, wide, [_row("4", "03/01/2016", "21", "1230A", state="99")])
    # 2017: 43 columns in another order
    _write(p17, list(reversed(BASE)), [_row("5", "07/04/2017", "14", "0400P"), _row("6", "07/04/2017", "14", "0401P")])
    return {2015: str(p15), 2016: str(p16), 2017: str(p17)}


def test_read_conform_types_and_order(spark, files):
    df = read_year_csv(spark, files[2015], 2015)
    assert tuple(df.columns) == TICKET_COLUMNS
    types = dict(df.dtypes)
    assert types["summons_number"] == "bigint" and types["violation_code"] == "int"
    assert types["file_year"] == "int"
    rows = {r["summons_number"]: r for r in df.collect()}
    assert rows[3]["violation_code"] is None  # malformed number -> NULL
    assert rows[3]["violation_time"] is None and rows[3]["house_number"] is None  # empty cell -> NULL


def test_schema_drift_lists_the_eight_extra_columns(spark, files):
    raw = {y: spark.read.option("header", True).csv(p) for y, p in files.items()}
    drift = {r["column_name"]: r["n_files"] for r in schema_drift(raw).collect()}
    assert drift == {c: 2 for c in EXTRA_COLUMNS}


def test_union_by_name_despite_column_order(spark, files):
    master = read_years(spark, files)
    assert master.count() == 6
    by_year = {r["file_year"]: r["count"] for r in master.groupBy("file_year").count().collect()}
    assert by_year == {2015: 3, 2016: 1, 2017: 2}
    codes = {r["summons_number"]: r["violation_code"] for r in master.collect()}
    assert codes[5] == 14 and codes[1] == 21
    clean = keep_issue_year(master)
    assert sorted(r["summons_number"] for r in clean.collect()) == [1, 3, 4, 5, 6]
    # questions run unchanged on ingested data
    assert {r["n"] for r in A.ticket_count_by_year(clean).collect()} == {2, 1, 2}


def test_union_keeps_duplicates(spark, files):
    a = read_year_csv(spark, files[2016], 2016)
    assert union_years([a, a]).count() == 2


def test_all_columns_mode_drops_extras_and_snake_cases(spark, files):
    df = read_year_csv(spark, files[2015], 2015, columns="all")
    assert "latitude" not in df.columns and "Latitude" not in df.columns
    assert "extra_01" in df.columns and "summons_number" in df.columns and "file_year" in df.columns
    assert len(df.columns) == 44


def test_infer_schema_option(spark, files):
    df = read_year_csv(spark, files[2017], 2017, infer_schema=True)
    assert dict(df.dtypes)["summons_number"] == "bigint"
    assert df.count() == 2


def test_missing_named_column_is_an_error(spark, files):
    raw = spark.read.option("header", True).csv(files[2015]).drop("Issue Date")
    with pytest.raises(ValueError):
        conform(raw, 2015)


def test_register_views_and_sql(spark, files):
    register_views({"tickets_2015": read_year_csv(spark, files[2015], 2015)})
    n = spark.sql("SELECT count(*) AS n FROM tickets_2015 WHERE violation_code IS NOT NULL").collect()[0]["n"]
    assert n == 2


def test_parts_with_other_columns_are_bound_by_name(spark, tmp_path):
    wide = BASE + list(EXTRA_COLUMNS)
    a, b, c = (tmp_path / f"{x}.csv" for x in "abc")
    _write(a, wide, [_row("1", "01/05/2015", "21", "0143A")])
    _write(b, list(reversed(BASE)), [_row("2", "02/05/2015", "38", "0143P")])
    _write(c, wide, [_row("3", "03/05/2015", "14", "0143P")])
    df = read_year_csv(spark, [str(a), str(b), str(c)], 2015)
    rows = sorted((r["summons_number"], r["issue_date"], r["violation_code"], r["vehicle_make"]) for r in df.collect())
    assert rows == [(1, "01/05/2015", 21, "FORD"), (2, "02/05/2015", 38, "FORD"), (3, "03/05/2015", 14, "FORD")]
    assert read_year_csv(spark, [str(a), str(b)], 2015, columns="all").count() == 2


def test_a_folder_of_parts_with_other_headers_is_an_error(spark, tmp_path):
    _write(tmp_path / "a.csv", BASE, [_row("1", "01/05/2015", "21", "0143A")])
    _write(tmp_path / "b.csv", list(reversed(BASE)), [_row("2", "02/05/2015", "38", "0143P")])
    with pytest.raises(Exception, match="(?i)header"):
        read_year_csv(spark, str(tmp_path), 2015).collect()


def test_cells_that_typing_loses_are_counted(spark, files):
    from ticketlens.sources.csv import unreadable

    raw = spark.read.option("header", True).csv(files[2015])
    assert [tuple(r) for r in unreadable(raw, 2015).collect()] == [("violation_code", 2015, 1)]


def test_store_years_tells_its_arguments_apart(spark, files):
    from ticketlens.sources.yearly import store_years

    used, _ = store_years(spark, files)
    every, _ = store_years(spark, {2015: files[2015]}, columns="all")
    narrow, _ = store_years(spark, {2015: files[2015]})
    assert tuple(used.columns) == tuple(narrow.columns) == TICKET_COLUMNS
    assert "extra_01" in every.columns and every.count() == narrow.count()


def test_store_years_once_and_clean_by_partition(spark, files):
    from ticketlens.sources.yearly import store_years

    everything, clean = store_years(spark, files)
    assert everything.count() == 6
    assert sorted(r["summons_number"] for r in clean.collect()) == [1, 3, 4, 5, 6]
    again, _ = store_years(spark, files)
    assert again.inputFiles() == everything.inputFiles()  # written once, same files
    assert tuple(everything.columns) == TICKET_COLUMNS
