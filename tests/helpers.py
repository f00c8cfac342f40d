"""Small helpers for building literal citation frames in tests."""

from __future__ import annotations

from ticketlens.schema import TICKET_COLUMNS, TICKET_SCHEMA


def tickets_df(spark, rows):
    """Citation frame from dicts; missing columns are NULL."""
    data = [tuple(r.get(c) for c in TICKET_COLUMNS) for r in rows]
    return spark.createDataFrame(data, TICKET_SCHEMA)


def ticket(**kw):
    base = {
        "summons_number": 1,
        "file_year": 2015,
        "issue_date": "01/05/2015",
        "violation_time": "0143A",
        "violation_code": 21,
        "violation_precinct": 19,
        "issuer_precinct": 19,
        "registration_state": "NY",
        "vehicle_body_type": "SUBN",
        "vehicle_make": "FORD",
        "house_number": "12",
        "street_name": "MAIN",
    }
    base.update(kw)
    return base


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))
