"""Cleaning and profiling: the year filter, NULL profile, bad states, addresses.

Every function maps a DataFrame to a DataFrame and is keyed by ``file_year``,
so one pass answers for all years at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import invalid_state, issue_year, issue_year_text
from ..schema import YEAR_COL

# Columns checked for NULLs by the profile, in the order the reference checks them.
PROFILE_COLUMNS: tuple[str, ...] = (
    "summons_number",
    "registration_state",
    "issue_date",
    "violation_code",
    "violation_time",
)


def issued_in_file_year() -> Column:
    """True if the issue date's year text equals the file year (the M1 rule); false for NULL dates.

    The coalesce also keeps the test a filter: where date and year come from
    two sides of a join, a bare equality would become a join key, and the date
    text would be formed in every comparison of its sort.
    """
    return F.coalesce(issue_year_text("issue_date") == F.col(YEAR_COL).cast("string"), F.lit(False))


def keep_issue_year(
    df: DataFrame, mode: str = "file_and_issue_year", years: Sequence[int] | None = None
) -> DataFrame:
    """Keep the rows issued in the year they belong to.

    ``file_and_issue_year`` (default, as the reference): a row of the file for
    year Y stays only if its issue date is in calendar year Y.

    ``issue_year``: rows are re-tagged with their own issue year and kept if
    that year is in ``years``, so a ticket of year Y filed in year Y+1 counts
    for Y instead of being dropped.
    """
    if mode == "file_and_issue_year":
        return df.where(issued_in_file_year())
    if mode == "issue_year":
        if not years:
            raise ValueError("mode='issue_year' needs the list of years to keep")
        return df.withColumn(YEAR_COL, issue_year("issue_date")).where(
            F.col(YEAR_COL).isin(*years)
        )
    raise ValueError(f"unknown mode {mode!r}")


def issue_years(df: DataFrame) -> DataFrame:
    """Distinct ``yyyy`` texts of the issue date, newest first.

    Written as SQL over the frame passed as a named relation (a view scoped
    to this one statement), as the reference asked it.
    """
    return df.sparkSession.sql(
        "SELECT DISTINCT substring(issue_date, 7, 4) AS issue_year FROM {tickets} ORDER BY issue_year DESC",
        tickets=df,
    )


def null_profile(df: DataFrame, columns: Iterable[str] = PROFILE_COLUMNS) -> DataFrame:
    """NULL count per (column, year), in one scan; pairs without NULLs are absent."""
    cols = list(columns)
    per_year = df.groupBy(YEAR_COL).agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    return (
        per_year.unpivot([YEAR_COL], cols, "column_name", "n")
        .where(F.col("n") > 0)
        .select("column_name", YEAR_COL, "n")
    )


def invalid_states(df: DataFrame, strict: bool = False) -> DataFrame:
    """Distinct malformed registration states."""
    return (
        df.where(invalid_state("registration_state", strict=strict))
        .select("registration_state")
        .distinct()
    )


def missing_address(df: DataFrame) -> DataFrame:
    """Tickets per year whose house number or street name is NULL."""
    return (
        df.where(F.col("house_number").isNull() | F.col("street_name").isNull())
        .groupBy(YEAR_COL)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), YEAR_COL)
    )


def without_state(df: DataFrame, state: str = "99") -> DataFrame:
    """Rows whose state differs from ``state``; NULL states go too (SQL ``!=``)."""
    return df.where(F.col("registration_state") != F.lit(state))
