"""Citation table derived from the driver's TPC-H-like tables.

The real input is a CSV file per fiscal year (see ``sources.csv``). The test
and bench data are parquet tables ``lineitem orders customer part``; this
module turns them into a citation table with the same columns and the same
kinds of dirt (NULLs, bad states, odd times, tickets issued outside the file
year), by the rules of FIXTURES.md §F2. Every order year is one fiscal year:
no row of the join is left out.

Plan shape: each table is pruned to the columns the rules read; orders meet
customer first (both far smaller than lineitem), so lineitem is joined once
on the order key and once on the part key. The joins and the deal to the
year's folders move the numbers that the rules read; the citations' text is formed
after them, in the task that writes it. The lineitem
join is a sort-merge join on the order key (AQE splits skewed keys, or,
where the session's number of shuffle partitions is too small for the lines, there are more); the
customer and part joins are left to Catalyst/AQE, which broadcast a side only
when its size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffle
otherwise.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cube as C
from ..operators.distinct import add_years
from ..schema import TICKET_COLUMNS, YEAR_COL
from .store import clean_ranges, folder_counts, own_folder, stored, stored_citations, stored_years

# --- Fixed values -----------------------------------------------------------
# Violation fines for the fixture's codes (code 13, a top code, is left out on
# purpose so that its amount is NULL).
FIXTURE_FINES: dict[int, int] = {1: 55, 7: 115, 19: 50, 25: 50}
# Columns that the rules read beside file year and issue date.
RAW = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "c_nationkey", "p_name", "p_type", "p_brand")
#: Lines that a task of the large join sorts, about.
EACH = 1_000_000
# ---------------------------------------------------------------------------

_LOCK = threading.RLock()
_STATES: set[str] = set()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _name(sf_dir: str) -> str:
    return f"tickets:{sf_dir.rstrip('/')}"


def stored_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tickets(spark, sf_dir)`` written once per application, then scanned."""
    return _citations(spark, sf_dir)[0]


def stored_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean rows of the stored table (``keep_issue_year``), by partition pruning."""
    return _citations(spark, sf_dir)[1]


def _citations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return stored_citations(spark, _name(sf_dir), lambda: _joined(spark, sf_dir), _formed)


def stored_cube(spark: SparkSession, sf_dir: str) -> C.Cube:
    """The cube of the clean rows, counted once per application."""
    rows = stored(spark, f"cube:{_name(sf_dir)}", lambda: C.build(stored_clean(spark, sf_dir)), partition_by=[C.CUBOID_COL])
    return C.Cube(rows)


def stored_states(spark: SparkSession, sf_dir: str, excluded: str = "99") -> str:
    """Folder of the bitmaps of each year's states, made once per application from the cube."""
    path = own_folder(spark, f"states:{excluded}:{_name(sf_dir)}")
    with _LOCK:
        if path not in _STATES:
            states = stored_cube(spark, sf_dir).cuboid(["registration_state"])
            add_years(spark, path, states.where(F.col("registration_state") != excluded), "registration_state")
            _STATES.add(path)
    return path


def fixture_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """The fiscal years that the ingest wrote, in order."""
    stored_tickets(spark, sf_dir)
    return stored_years(spark, _name(sf_dir))


def fixture_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by year and year filter, from file footers: ``file_year, in_file_year, n``."""
    stored_tickets(spark, sf_dir)
    return folder_counts(spark, _name(sf_dir))


def fixture_ranges(spark: SparkSession, sf_dir: str, column: str) -> dict[int, tuple[int, int]]:
    """Each year's least and largest value of an integral column among clean rows, from file footers."""
    stored_tickets(spark, sf_dir)
    return clean_ranges(spark, _name(sf_dir), column)


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master citation table (all years' "files" bound), narrow build schema."""
    return _formed(_joined(spark, sf_dir)).select(*TICKET_COLUMNS)


def _dealt(rows: DataFrame, number: int, key: str) -> DataFrame:
    """``rows`` in tasks of about ``EACH``, if the session's number of shuffle partitions would give them more."""
    tasks = -(-number // EACH)
    return rows.repartition(tasks, key) if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with what the rules read of their orders, customers and parts: ``file_year``, ``issue_date`` and ``RAW``."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    lineitem = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    order_nation = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.year("o_orderdate").cast("int").alias(YEAR_COL), "c_nationkey"
    )
    # The lineitem join is the big one: keep it a sort-merge join on the order
    # key at every size. (Without column statistics Catalyst sizes an inner
    # join as the product of its inputs, so it would otherwise broadcast
    # lineitem itself whenever the file is under the threshold.)
    number = lineitem.count()  # from footers
    lines, order_nation = _dealt(lineitem, number, "l_orderkey"), _dealt(order_nation, number, "o_orderkey")
    rows = lines.join(order_nation.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    issue_date = F.when(F.col("l_orderkey") % 149 == 0, F.lit(None).cast("string")).otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
    return rows.select(YEAR_COL, issue_date.alias("issue_date"), *RAW)


def _formed(rows: DataFrame) -> DataFrame:
    """The citations of joined lines, by the rules; each is worked out from its own row."""
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    h = (ok * 7 + pk * 5 + ln) % 24
    # Hour 12 comes as "12" or "00": 12xxA and 00xxP fall in no bin.
    hour = (
        F.when(h >= 13, h - 12)
        .when((h == 0) & (ln % 2 == 0), F.lit(12))
        .when((h == 12) & (ln % 2 == 1), F.lit(0))
        .otherwise(h)
    )
    minute = (pk * 11 + ln) % 60
    mark = F.when(h >= 12, F.lit("P")).otherwise(F.lit("A"))
    hhmm = F.concat(
        F.lpad(hour.cast("string"), 2, "0"), F.lpad(minute.cast("string"), 2, "0"), mark
    )
    precinct = sk % 25
    nation = F.col("c_nationkey")
    state = (
        F.when(ok % 131 == 0, F.lit(None).cast("string"))
        .when(nation == 24, F.lit("99"))
        .when(nation == 23, F.lit("9A"))
        .when(nation == 22, F.lit("#1"))
        .otherwise(F.concat(F.char(F.lit(65) + nation), F.lit("Y")))
    )
    cells = {
        "summons_number": F.when(pk % 20 == 0, F.lit(None)).otherwise(ok * 1000000 + pk * 10 + ln).cast("bigint"),
        "violation_time": F.when(ok % 97 == 0, F.lit(None).cast("string")).otherwise(hhmm),
        "violation_code": F.when(pk % 211 == 0, F.lit(None)).otherwise((pk % 10) * ln + 1).cast("int"),
        "violation_precinct": F.when(precinct.between(9, 14), F.lit(8)).otherwise(precinct).cast("int"),
        "issuer_precinct": F.when(ok % 16 == 0, F.lit(0)).otherwise(precinct).cast("int"),
        "registration_state": state,
        "vehicle_body_type": F.col("p_type"),
        "vehicle_make": F.col("p_brand"),
        "house_number": F.when(ok % 5 == 0, F.lit(None).cast("string")).otherwise(pk.cast("string")),
        "street_name": F.when(pk % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")),
    }
    own = [cells[c].alias(c) if c in cells else F.col(c) for c in TICKET_COLUMNS]
    return rows.select(*own, *(c for c in rows.columns if c not in (*RAW, YEAR_COL, "issue_date")))
