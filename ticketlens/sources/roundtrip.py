"""The citation table through CSV: written as yearly files, stored year by year, read back and profiled.

Each year is written as two parts whose columns come in different orders;
every other year has the eight surplus columns (51 columns against 43). Some of the carried
columns hold other kinds of values in the one part than in the other, and a third part of each year
holds lines that are no records: too long, too short, or with a quote left open. The files go to the shared folder
once per application. The table is stored in two steps, all years but the last, then all,
so what the queries read has grown by a year.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.agg import exact_sum, fitted, top_k_per
from ..operators.cube import Cube, counts
from ..operators.distinct import distinct_counts
from ..schema import EXTRA_COLUMNS, USED_COLUMNS, YEAR_COL, build_name
from .derived import follow
from .fixture import fixture_years, stored_tickets
from .store import own_folder, spooled
from .yearly import at_once, broken_records, store_years

#: Carried columns whose parts hold different kinds of values, with the type that holds both.
MIXED = {
    "Feet From Curb": "double",
    "Vehicle Year": "bigint",
    "Meter Number": "string",
    "Unregistered Vehicle": "int",
}
#: Columns that are only carried, as many as the real files have.
CARRIED = tuple(f"Extra {i:02d}" for i in range(1, 33 - len(MIXED)))
#: Of so many summons numbers one brings a line that is no record, by its remainder.
PLANTED_OF = 120
PLANTED = {3: "too long", 43: "too short", 83: "open quote"}
_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)
_WRITTEN: set[str] = set()


def _mixed_cells(part: int) -> list[Column]:
    """Whole numbers in the first part; in the second fractions, larger numbers, text, and any number at all."""
    code, summons = F.col("violation_code"), F.col("summons_number")
    cells = (
        (code, summons, F.lpad(code.cast("string"), 4, "0"), F.lit(None).cast("int")),
        (code + F.lit(0.5), summons + F.lit(10**12), F.concat(F.lit("M"), code.cast("string")), code),
    )[part]
    return [c.cast("string").alias(name) for name, c in zip(MIXED, cells, strict=True)]


def _columns(wide: bool, part: int) -> list[Column]:
    own = [F.col(name).cast("string").alias(source) for source, (name, _) in USED_COLUMNS.items()]
    carried = [F.lit("x").alias(c) for c in (*CARRIED, *(EXTRA_COLUMNS if wide else ()))]
    out = own + _mixed_cells(part) + carried
    return list(reversed(out)) if part else out


def _planted_line(header: list[str]) -> Column:
    """A line that is no record of ``header``, by the summons number's remainder."""
    cells = [F.col("summons_number").cast("string")] + [F.lit("")] * (len(header) - 1)
    kinds = {
        "too long": F.concat_ws(",", *cells, F.lit("one more")),
        "too short": F.concat_ws(",", *cells[:-1]),
        "open quote": F.concat_ws(",", cells[0], F.lit('"x'), *cells[2:]),
    }
    remainder = F.col("summons_number") % PLANTED_OF
    out = F
    for k, name in PLANTED.items():
        out = out.when(remainder == k, kinds[name])
    return out


def write_yearly_csv(tickets: DataFrame, years: list[int], base: str) -> dict[int, list[str]]:
    """Write a citation table as CSV parts; ``{year: its parts}``.

    Each folder holds one part of one year and is written by a job of its own, several years at a time: rows
    leave a task as it reads them, where a job on many folders would sort them first.
    """
    half = (F.coalesce("violation_precinct", F.lit(0)) + F.coalesce(F.length("street_name"), F.lit(0))) % 2
    planted = tickets.where((F.col("summons_number") % PLANTED_OF).isin(*PLANTED))
    held = {r[0] for r in planted.select(YEAR_COL).distinct().collect()}
    header = tickets.select(*_columns(False, 0)).columns
    wide = {y: i % 2 == 0 for i, y in enumerate(years)}

    def write(year: int) -> list[str]:
        paths = [f"{base}/{'wide' if wide[year] else 'narrow'}-{part}/{YEAR_COL}={year}" for part in (0, 1)]
        for part, path in enumerate(paths):
            rows = tickets.where((F.col(YEAR_COL) == year) & (half == part))
            rows.select(*_columns(wide[year], part)).write.option("header", True).csv(path)
        if year not in held:
            return paths
        lines = f"{base}/planted/{YEAR_COL}={year}"
        # One column whose name is the header and whose cells are lines: nothing in them is quoted.
        (
            planted.where(F.col(YEAR_COL) == year)
            .select(_planted_line(header).alias(",".join(header)))
            .write.option("header", True)
            .option("sep", "\u0002")
            .option("quote", "\u0003")
            .csv(lines)
        )
        return [*paths, lines]

    return at_once(write, years)


_PATHS: dict[str, dict[int, list[str]]] = {}


def _yearly_files(spark: SparkSession, sf_dir: str) -> dict[int, list[str]]:
    base = own_folder(spark, f"yearly-csv:{sf_dir}")
    with _LOCKS[base]:
        if base not in _PATHS:
            _PATHS[base] = write_yearly_csv(stored_tickets(spark, sf_dir), fixture_years(spark, sf_dir), base)
        return _PATHS[base]


def _stored(spark: SparkSession, sf_dir: str, **how) -> tuple[DataFrame, str]:
    """The table that was first stored without its last year, then with all; and its folder."""
    paths = _yearly_files(spark, sf_dir)
    target = own_folder(spark, f"yearly-table:{sf_dir}:{sorted(how.items())}")
    with _LOCKS[target]:
        if target not in _WRITTEN:
            first = dict(sorted(paths.items())[:-1]) or paths
            store_years(spark, first, target, **how)
            _WRITTEN.add(target)
        rows, _ = store_years(spark, paths, target, broken="quarantine", **how)
    return rows, target


def _followed(spark: SparkSession, sf_dir: str) -> tuple[Cube, str]:
    """The cube and the states' bitmaps of the stored files, counted after each of the two steps."""
    paths = _yearly_files(spark, sf_dir)
    target, path = (own_folder(spark, f"followed-{what}:{sf_dir}") for what in ("table", "cube"))
    with _LOCKS[target]:
        if target not in _WRITTEN:
            store_years(spark, dict(sorted(paths.items())[:-1]) or paths, target)
            follow(spark, target, path, broken="quarantine")
            _WRITTEN.add(target)
        store_years(spark, paths, target)
        return follow(spark, target, path, broken="quarantine")


def csv_top_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 most frequent codes per year, from the cube that followed the files: ``file_year, violation_code, n, rk``."""
    per_code = counts(_followed(spark, sf_dir)[0], [YEAR_COL, "violation_code"], n="violation_code")
    return top_k_per(per_code, YEAR_COL, "n", 3, "violation_code").orderBy(YEAR_COL, "rk")


def csv_unique_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct states per year, from the bitmaps that followed the files: ``file_year, n_states``."""
    return distinct_counts(spark, _followed(spark, sf_dir)[1], "n_states").orderBy(YEAR_COL)


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per year of the stored files: rows, NULLs and sums of typed columns, broken records left out.

    ``sum_summons`` is a bigint; if a year's sum is beyond it, a decimal.
    """
    return profiled(_stored(spark, sf_dir)[0])


def profiled(rows: DataFrame) -> DataFrame:
    """What ``csv_ingest`` tells of a citation table; its row a year is written before the sums are looked at."""
    per_year = (
        rows.groupBy(YEAR_COL)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("summons_number", "registration_state", "issue_date", "violation_time", "house_number", "street_name")],
            exact_sum("summons_number").alias("sum_summons"),
            F.sum("violation_code").alias("sum_code"),
            F.sum("violation_precinct").alias("sum_precinct"),
            F.sum("issuer_precinct").alias("sum_issuer"),
            F.count_distinct("vehicle_make").alias("n_makes"),
            F.count_distinct("vehicle_body_type").alias("n_body_types"),
        )
    )
    return fitted(spooled(per_year, "profile"), "sum_summons").orderBy(YEAR_COL)


def csv_broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are too long, too short or badly quoted, per year: ``file_year, reason, n, chars``."""
    _, target = _stored(spark, sf_dir)
    return (
        broken_records(spark, target)
        .groupBy(YEAR_COL, "reason")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("record")).alias("chars"))
        .orderBy(YEAR_COL, "reason")
    )


def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated types of columns whose parts hold different kinds of values, per year:
    ``file_year, column_name, type, n, total`` (tenths of numbers added up, or characters of text)."""
    rows, _ = _stored(spark, sf_dir, columns="all", infer_schema=True)
    names = [build_name(c) for c in MIXED]
    kinds = dict(rows.dtypes)

    def told(c: str) -> Column:
        cell = F.length(c) if kinds[c] == "string" else F.round(F.col(c).cast("decimal(30,1)") * 10, 0)
        return F.struct(
            F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("type"),
            F.count(c).alias("n"), F.coalesce(F.sum(cell.cast("decimal(30,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"),
        )

    per_year = rows.groupBy(YEAR_COL).agg(F.array(*(told(c) for c in names)).alias("columns"))
    return per_year.select(YEAR_COL, F.inline("columns")).select(YEAR_COL, "column_name", "type", "n", F.col("total").cast("double").alias("total"))
