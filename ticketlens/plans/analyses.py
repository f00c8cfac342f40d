"""The reference's questions, each one lazy DataFrame keyed by ``file_year``.

The reference runs every question three times, once per fiscal-year table,
and pastes the answer of one question (top precincts, top codes) into the
filter of the next. Here each question is one plan over all years, and the
keys are computed per year inside the same plan.

Inputs: ``tickets`` is the master table (all files bound); ``clean`` is
``keep_issue_year(tickets)``. Functions that need the clean table take it; those
that only count it (argument ``source``) take the clean rows or a cube of
their counts (``operators.cube``).

Questions that chain two steps (top keys, then a breakdown) first count the
clean rows once per fine-grained key and derive both steps from those counts
with windows, so the citation table is scanned once per question and only
partial counts cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.agg import binned, counts_by, exact_sum, fitted, histogram, ranked_within, top_k_per, within_top_groups
from ..operators.clean import issued_in_file_year, without_state
from ..operators.cube import Cube, counts
from ..operators.joins import attach_fines, fine_table, semi_join_keys
from ..schema import YEAR_COL
from ..sources.csv import union_years as bind_years
from ..sources.store import IN_YEAR_COL

Y = YEAR_COL
Source = DataFrame | Cube


# --- load and clean --------------------------------------------------------------

def row_counts(tickets: DataFrame) -> DataFrame:
    """Rows before and after the year filter, from one scan: ``stage, n``."""
    both = tickets.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(issued_in_file_year()).alias("clean"),
    )
    return both.unpivot([], ["loaded", "clean"], "stage", "n")


def row_counts_of_folders(folders: DataFrame) -> DataFrame:
    """``row_counts`` from the rows of each partition folder (``in_file_year, n``), as file footers tell them."""
    both = folders.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum(F.when(F.col(IN_YEAR_COL), F.col("n"))), F.lit(0)).alias("clean"),
    )
    return both.unpivot([], ["loaded", "clean"], "stage", "n")


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Row bind of yearly tables (UNION ALL by name), counted per year and in
    total (``file_year`` NULL): ``file_year, n``.

    Rows are counted per year; the rollup that adds the total runs on those
    counts, so no row is doubled for it.
    """
    counts = counts_by(bind_years(frames), Y)
    return counts.rollup(Y).agg(F.sum("n").alias("n")).orderBy(F.col(Y).asc_nulls_last())


def clean_counts(source: Source) -> DataFrame:
    """Rows kept per year: ``file_year, n``."""
    return counts(source, [Y], n=None).orderBy(Y)


def ticket_count_by_year(source: Source) -> DataFrame:
    """Tickets per year, counting summons numbers: ``file_year, n``."""
    return counts(source, [Y], n="summons_number").orderBy(F.desc("n"), Y)


def unique_states_by_year(clean: DataFrame, excluded: str = "99") -> DataFrame:
    """Distinct registration states per year, ``excluded`` left out: ``file_year, n_states``."""
    return (
        without_state(clean, excluded)
        .groupBy(Y)
        .agg(F.count_distinct("registration_state").alias("n_states"))
        .orderBy(Y)
    )


def state_counts(source: Source, excluded: str = "99") -> DataFrame:
    """Tickets per state and year, ``excluded`` left out: ``file_year, registration_state, n``."""
    per_state = counts(source, [Y, "registration_state"], n="registration_state")
    return without_state(per_state, excluded).orderBy(Y, F.desc("n"), "registration_state")


# --- histograms -------------------------------------------------------------------

def hist(source: Source, col: str, nbins: int = 12, ranges: Mapping[int, tuple[int, int]] | None = None) -> DataFrame:
    """Equi-width histogram of an integral column per year: ``file_year, bin, centroid, n``.

    ``ranges`` are the years' least and largest values where they are known, as from
    file footers; without them they are taken from the counts.
    """
    if ranges is not None:
        # A row, or a count of the cube, goes straight to its bin.
        rows = source.cuboid([Y, col]) if isinstance(source, Cube) else source.withColumn("n", F.lit(1).cast("bigint"))
        return binned(rows.select(Y, col, "n"), col, "n", ranges, nbins)
    per_value = counts(source, [Y, col], n=None).where(F.col(col).isNotNull())
    return histogram(per_value, col, nbins=nbins, by=Y, weight="n")


# --- top-k ------------------------------------------------------------------------

def top_k_values(source: Source, key: str, k: int = 5) -> DataFrame:
    """The k most frequent values of ``key`` per year: ``file_year, key, n, rk``.

    Counts are ``count(key)``; ties are cut by key ascending.
    """
    return top_k_per(counts(source, [Y, key], n=key), Y, "n", k, key).orderBy(Y, "rk")


def _top_pairs(source: Source, n_precincts: int, k: int) -> DataFrame:
    pairs = counts(source, [Y, "issuer_precinct", "violation_code"], n="violation_code", n_precinct_rows="issuer_precinct")
    in_top = within_top_groups(pairs, Y, "issuer_precinct", "n_precinct_rows", n_precincts)
    return top_k_per(
        in_top.select(Y, "issuer_precinct", "violation_code", "n"),
        Y,
        "n",
        k,
        ["issuer_precinct", "violation_code"],
    )


def codes_in_top_precincts(source: Source, n_precincts: int = 3, k: int = 10) -> DataFrame:
    """The k most frequent (issuer precinct, code) pairs within the year's
    ``n_precincts`` busiest issuer precincts: ``file_year, issuer_precinct, violation_code, n, rk``.

    One scan: rows are counted per (year, precinct, code); the precinct
    ranking and the pair ranking are windows over those counts.
    """
    return _top_pairs(source, n_precincts, k).orderBy(Y, "rk")


def code_overlap(source: Source, n_precincts: int = 3, k: int = 10) -> DataFrame:
    """For each code among the top pairs, in how many of the top precincts it
    appears (its pairs are distinct, so they are counted): ``file_year,
    violation_code, n_precincts``."""
    return (
        _top_pairs(source, n_precincts, k)
        .groupBy(Y, "violation_code")
        .agg(F.count("issuer_precinct").alias("n_precincts"))
        .orderBy(Y, F.desc("n_precincts"), F.col("violation_code").asc_nulls_last())
    )


# --- lookups in the rows -----------------------------------------------------------

def _told(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum("summons_number").alias("sum_summons"),
        F.count_if(F.col("house_number").isNull() | F.col("street_name").isNull()).alias("n_missing_address"),
        F.count_if(F.col("violation_time").isNull()).alias("n_missing_time"),
    )


def peak_year_precincts(clean: DataFrame, source: Source, n_precincts: int = 3) -> DataFrame:
    """Tickets of the busiest issuer precincts of the year with most tickets:
    ``file_year, issuer_precinct, n, sum_summons, n_missing_address, n_missing_time``.

    The keys are computed from ``source`` (the rows or their cube); the rows that have them are
    picked by a semi join, whose keys also prune the years' folders while the query runs.
    """
    peak = counts(source, [Y], n=None).orderBy(F.desc("n"), Y).limit(1).select(Y)
    per_precinct = counts(source, [Y, "issuer_precinct"], n="issuer_precinct").where("issuer_precinct IS NOT NULL")
    keys = top_k_per(per_precinct, Y, "n", n_precincts, "issuer_precinct").join(peak, Y, "left_semi")
    picked = semi_join_keys(clean, keys, [Y, "issuer_precinct"])
    return fitted(_told(picked, Y, "issuer_precinct"), "sum_summons").orderBy(Y, F.desc("n"), "issuer_precinct")


def code_lookup(clean: DataFrame, codes: Sequence[int], precincts: Sequence[int]) -> DataFrame:
    """Tickets of some codes in some issuer precincts:
    ``file_year, violation_code, issuer_precinct, n, sum_summons, n_missing_address, n_missing_time``.

    Both lists reach the scan; in files ordered by code and precinct it passes over what can't have them.
    """
    picked = clean.where(F.col("violation_code").isin(*codes) & F.col("issuer_precinct").isin(*precincts))
    return fitted(_told(picked, Y, "violation_code", "issuer_precinct"), "sum_summons").orderBy(Y, "violation_code", "issuer_precinct")


# --- time of day ------------------------------------------------------------------

def top3_codes_by_time_bin(source: Source, k: int = 3) -> DataFrame:
    """Codes with dense rank <= k by count within each time bin:
    ``file_year, time_bin, violation_code, n, rk``. Rows without a bin are left out."""
    per_code = counts(source, [Y, "time_bin", "violation_code"], n="violation_code").where(F.col("time_bin").isNotNull())
    return ranked_within(per_code, [Y, "time_bin"], "n", k).orderBy(Y, "time_bin", "rk", "violation_code")


def time_bins_of_top_codes(source: Source, k: int = 3) -> DataFrame:
    """Tickets per time bin for the year's k most frequent codes taken
    together: ``file_year, time_bin, n``. Rows without a bin form the ``''`` group.

    One scan: count per (year, code, bin); the top codes are the largest
    per-code sums of those counts (a window), so no second pass picks them.
    """
    by_code_bin = counts(source, [Y, "violation_code", "time_bin"], n="violation_code")
    return (
        within_top_groups(by_code_bin, Y, "violation_code", "n", k)
        .groupBy(Y, F.coalesce("time_bin", F.lit("")).alias("time_bin"))
        .agg(F.sum("n").cast("bigint").alias("n"))
        .orderBy(Y, F.desc("n"), "time_bin")
    )


# --- seasons ----------------------------------------------------------------------

def season_counts(source: Source) -> DataFrame:
    """Tickets per season: ``file_year, season, n`` (count of summons numbers)."""
    return (
        counts(source, [Y, "season"], n="summons_number")
        .where(F.col("season").isNotNull())
        .orderBy(Y, F.desc("n"), "season")
    )


def top3_codes_by_season(source: Source, k: int = 3) -> DataFrame:
    """Codes with dense rank <= k within each season: ``file_year, season, violation_code, n, rk``.

    As in the reference, the rank orders by ``count(violation_code)`` while
    ``n`` is ``count(summons_number)``.
    """
    per_code = counts(source, [Y, "season", "violation_code"], n="summons_number", n_code="violation_code")
    return (
        ranked_within(per_code.where(F.col("season").isNotNull()), [Y, "season"], "n_code", k)
        .select(Y, "season", "violation_code", "n", "rk")
        .orderBy(Y, "season", "rk", "violation_code")
    )


# --- revenue ----------------------------------------------------------------------

def revenue_top3(source: Source, fines: Mapping[int, int], k: int = 3) -> DataFrame:
    """Fine revenue of the year's k most frequent codes:
    ``file_year, violation_code, cnt, amount`` (NULL amount for a code without a fine).

    The k codes are picked by count first, then ordered by amount.
    """
    return _revenue(source, fines, k).orderBy(Y, F.col("amount").desc_nulls_last(), "violation_code")


def _revenue(source: Source, fines: Mapping[int, int], k: int) -> DataFrame:
    # Codes of rows with a date: a code without one has no count.
    per_code = counts(source, [Y, "violation_code"], cnt="issue_date").where("violation_code IS NOT NULL AND cnt > 0")
    top = top_k_per(per_code, Y, "cnt", k, "violation_code")
    schedule = fine_table(per_code.sparkSession, fines)
    return attach_fines(top, schedule).select(
        Y, "violation_code", "cnt", (F.col("cnt") * F.col("fine")).cast("bigint").alias("amount")
    )


def top_revenue_code(source: Source, fines: Mapping[int, int], k: int = 3) -> DataFrame:
    """The code with the highest fine total among the top k, per year:
    ``file_year, violation_code, amount``."""
    rev = _revenue(source, fines, k)
    return (
        top_k_per(rev, Y, "amount", 1, "violation_code")
        .select(Y, "violation_code", "amount")
        .orderBy(Y)
    )
