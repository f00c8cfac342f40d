"""Named queries over a data directory: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables in ``sf_dir`` whole: the citation table is
derived from them by Spark (``sources.fixture``) and written once per
application as partitioned parquet in the shared checkpoint folder
(``sources.store``), partitioned by year and by the year-filter flag; a
question on clean rows reads only the clean partitions. Each returns a lazy
result over the stored table; the first of an application runs the job that
writes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import invalid_states, issue_years, missing_address, null_profile
from ..schema import YEAR_COL
from ..operators.cube import Cube
from ..operators.distinct import distinct_counts
from ..operators.heavy import top_k_heavy
from ..sources.fixture import (
    FIXTURE_FINES,
    fixture_folders,
    fixture_ranges,
    fixture_years,
    stored_clean,
    stored_cube,
    stored_states,
    stored_tickets,
)
from ..sources.roundtrip import csv_broken_records, csv_inferred_types, csv_ingest, csv_top_codes, csv_unique_states
from . import analyses as A

Query = Callable[[SparkSession, str], DataFrame]


def _on_tickets(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(stored_tickets(spark, sf_dir))


def _on_clean(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(stored_clean(spark, sf_dir))


def _on_cube(fn: Callable[[Cube], DataFrame]) -> Query:
    """Questions that count clean rows by keys that the cube has read the cube only."""
    return lambda spark, sf_dir: fn(stored_cube(spark, sf_dir))


def _hist(col: str) -> Query:
    """Counts from the cube, ranges from file footers: no row is read."""
    return lambda spark, sf_dir: A.hist(stored_cube(spark, sf_dir), col, 12, fixture_ranges(spark, sf_dir, col))


def _unique_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_counts(spark, stored_states(spark, sf_dir), "n_states").orderBy(YEAR_COL)


def _yearly_files(fn: Callable[[list[DataFrame]], DataFrame]) -> Query:
    """Hand ``fn`` one table per fiscal year: the year's folders of the stored
    table (partition pruning), as the reference holds one table per file. The
    years are those that the ingest wrote."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = stored_tickets(spark, sf_dir)
        return fn([t.where(F.col(YEAR_COL) == F.lit(y)) for y in fixture_years(spark, sf_dir)])

    return run


# Top-5 questions: query name -> counted key.
TOP5_KEYS: dict[str, str] = {
    "top5_codes": "violation_code",
    "top5_body_types": "vehicle_body_type",
    "top5_makes": "vehicle_make",
    "top5_violation_precincts": "violation_precinct",
    "top5_issuer_precincts": "issuer_precinct",
}

# Histogram questions: query name -> binned column.
HIST_COLUMNS: dict[str, str] = {
    "hist_violation_code": "violation_code",
    "hist_violation_precinct": "violation_precinct",
    "hist_issuer_precinct": "issuer_precinct",
}


#: The lists that ``code_lookup`` asks for.
LOOKUP_CODES, LOOKUP_PRECINCTS = (7, 13, 25), (0, 8, 19)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "row_counts": lambda spark, sf_dir: A.row_counts_of_folders(fixture_folders(spark, sf_dir)),
        "union_years": _yearly_files(A.union_years),
        "csv_ingest": csv_ingest,
        "csv_broken_records": csv_broken_records,
        "csv_inferred_types": csv_inferred_types,
        "csv_top_codes": csv_top_codes,
        "csv_unique_states": csv_unique_states,
        "issue_years": _on_tickets(issue_years),
        "clean_counts": _on_cube(A.clean_counts),
        "null_profile": _on_clean(null_profile),
        "invalid_states": _on_cube(lambda cube: invalid_states(cube.cuboid(["registration_state"]))),
    }
    for name, col in HIST_COLUMNS.items():
        q[name] = _hist(col)
    q.update(
        {
            "ticket_count_by_year": _on_cube(A.ticket_count_by_year),
            "unique_states_by_year": _unique_states,
            "state_counts": _on_cube(A.state_counts),
            "missing_address": _on_clean(missing_address),
        }
    )
    for name, key in TOP5_KEYS.items():
        q[name] = _on_cube(lambda cube, k=key: A.top_k_values(cube, k, 5))
    q.update(
        {
            "top5_streets": _on_clean(lambda df: top_k_heavy(df, "street_name", 5).orderBy(YEAR_COL, "rk")),
            "codes_in_top_precincts": _on_cube(A.codes_in_top_precincts),
            "code_overlap": _on_cube(A.code_overlap),
            "peak_year_precincts": lambda spark, sf_dir: A.peak_year_precincts(stored_clean(spark, sf_dir), stored_cube(spark, sf_dir)),
            "code_lookup": _on_clean(lambda df: A.code_lookup(df, LOOKUP_CODES, LOOKUP_PRECINCTS)),
            "top3_codes_by_time_bin": _on_cube(A.top3_codes_by_time_bin),
            "top3_codes": _on_cube(lambda cube: A.top_k_values(cube, "violation_code", 3)),
            "time_bins_of_top_codes": _on_cube(A.time_bins_of_top_codes),
            "season_counts": _on_cube(A.season_counts),
            "top3_codes_by_season": _on_cube(A.top3_codes_by_season),
            "revenue_top3": _on_cube(lambda cube: A.revenue_top3(cube, FIXTURE_FINES)),
            "top_revenue_code": _on_cube(lambda cube: A.top_revenue_code(cube, FIXTURE_FINES)),
        }
    )
    return q
