"""Column names and types of the citation table.

The yearly source files use human column names with spaces ("Issue Date").
At ingest they are renamed once to snake_case build names, so every later
expression is a plain ``F.col("issue_date")``.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Source column name -> (build name, Spark type) for the columns the analyses
# read. The other source columns are only carried.
USED_COLUMNS: dict[str, tuple[str, T.DataType]] = {
    "Summons Number": ("summons_number", T.LongType()),
    "Registration State": ("registration_state", T.StringType()),
    "Issue Date": ("issue_date", T.StringType()),
    "Violation Code": ("violation_code", T.IntegerType()),
    "Violation Time": ("violation_time", T.StringType()),
    "Violation Precinct": ("violation_precinct", T.IntegerType()),
    "Issuer Precinct": ("issuer_precinct", T.IntegerType()),
    "House Number": ("house_number", T.StringType()),
    "Street Name": ("street_name", T.StringType()),
    "Vehicle Body Type": ("vehicle_body_type", T.StringType()),
    "Vehicle Make": ("vehicle_make", T.StringType()),
}

# Columns present in the first two fiscal years only (positions 44-51); they
# are dropped so that all years share one schema.
EXTRA_COLUMNS: tuple[str, ...] = (
    "Latitude",
    "Longitude",
    "Community Board",
    "Community Council",
    "Census Tract",
    "BIN",
    "BBL",
    "NTA",
)
# ---------------------------------------------------------------------------

YEAR_COL = "file_year"

# Build schema of the narrow citation table, in output order.
TICKET_FIELDS: tuple[tuple[str, T.DataType], ...] = (
    ("summons_number", T.LongType()),
    (YEAR_COL, T.IntegerType()),
    ("issue_date", T.StringType()),
    ("violation_time", T.StringType()),
    ("violation_code", T.IntegerType()),
    ("violation_precinct", T.IntegerType()),
    ("issuer_precinct", T.IntegerType()),
    ("registration_state", T.StringType()),
    ("vehicle_body_type", T.StringType()),
    ("vehicle_make", T.StringType()),
    ("house_number", T.StringType()),
    ("street_name", T.StringType()),
)

TICKET_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in TICKET_FIELDS])
TICKET_COLUMNS: tuple[str, ...] = tuple(n for n, _ in TICKET_FIELDS)


def build_name(source_name: str) -> str:
    """Snake_case build name for any source column ("Plate ID" -> "plate_id")."""
    if source_name in USED_COLUMNS:
        return USED_COLUMNS[source_name][0]
    return re.sub(r"[^0-9a-z]+", "_", source_name.strip().lower()).strip("_")
