"""Column expressions over the string-typed date and time fields.

All are plain Catalyst expressions (substring, IN, CASE), so they stay
inside whole-stage codegen; no Python runs per row.

Positions are 1-based. The reference writes ``substring(x, 0, 2)``, which
Spark treats as position 1; other engines do not, so position 1 is spelt
out everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Six 4-hour bins of the day, from the two-digit hour and the A/P mark of an
# HHMM[AP] string. "12" counts as an afternoon hour only with P; "12..A" and
# "00..P" fall in no bin.
TIME_BINS: tuple[tuple[str, tuple[str, ...], str], ...] = (
    ("Early_Morning_AM", ("00", "01", "02", "03"), "A"),
    ("Morning_AM", ("04", "05", "06", "07"), "A"),
    ("Before_Noon_AM", ("08", "09", "10", "11"), "A"),
    ("After_Noon_PM", ("12", "01", "02", "03"), "P"),
    ("Evening_PM", ("04", "05", "06", "07"), "P"),
    ("Night_PM", ("08", "09", "10", "11"), "P"),
)

# Seasons from the two-digit month of an MM/dd/yyyy string.
SEASONS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Summer", ("06", "07", "08")),
    ("Fall", ("09", "10", "11")),
    ("Winter", ("12", "01", "02")),
    ("Spring", ("03", "04", "05")),
)

# A registration state is suspect if its first two characters are both
# outside A-Z ("99" is caught, "9A" is not).
LOOSE_STATE_PATTERN = "^[^A-Z]{2}"
# Sound form: exactly two capitals.
STRICT_STATE_PATTERN = "^[A-Z]{2}$"
# ---------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _first_match(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """A searched CASE: the name of the first condition that holds."""
    expr = F
    for condition, name in rules:
        expr = expr.when(condition, F.lit(name))
    return expr if otherwise is None else expr.otherwise(F.lit(otherwise))


def time_bin(col: str | Column = "violation_time", otherwise: str | None = None) -> Column:
    """Bin name of an ``HHMM[AP]`` time; NULL (or ``otherwise``) if no bin fits."""
    hour, mark = F.substring(_c(col), 1, 2), F.substring(_c(col), 5, 1)
    return _first_match([(hour.isin(*hours) & (mark == m), name) for name, hours, m in TIME_BINS], otherwise)


def season(col: str | Column = "issue_date") -> Column:
    """Season of an ``MM/dd/yyyy`` date; NULL if the month is not recognised."""
    month = F.substring(_c(col), 1, 2)
    return _first_match([(month.isin(*months), name) for name, months in SEASONS])


def issue_year_text(col: str | Column = "issue_date") -> Column:
    """The ``yyyy`` part of an ``MM/dd/yyyy`` date, as text."""
    return F.substring(_c(col), 7, 4)


def issue_year(col: str | Column = "issue_date") -> Column:
    """The ``yyyy`` part of an ``MM/dd/yyyy`` date as int; NULL if not a number."""
    return issue_year_text(col).try_cast("int")


def invalid_state(col: str | Column = "registration_state", strict: bool = False) -> Column:
    """True for a malformed state code.

    ``strict=False`` is the reference's test (first two characters both
    non-capitals). ``strict=True`` flags anything but exactly two capitals.
    NULL stays NULL (so a filter drops it), as in SQL.
    """
    c = _c(col)
    if strict:
        return ~c.rlike(STRICT_STATE_PATTERN)
    return c.rlike(LOOSE_STATE_PATTERN)
