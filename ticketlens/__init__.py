"""ticketlens: parking-citation analytics as lazy Spark DataFrames."""

from .functions.exprs import invalid_state, issue_year, season, time_bin
from .operators.agg import counts_by, histogram, ranked_within, top_k_per
from .operators.clean import (
    invalid_states,
    issue_years,
    keep_issue_year,
    missing_address,
    null_profile,
)
from .operators.joins import attach_fines, fine_table, semi_join_keys
from .plans.oracle import oracle_sql
from .plans.registry import queries

__all__ = [
    "attach_fines",
    "counts_by",
    "fine_table",
    "histogram",
    "invalid_state",
    "invalid_states",
    "issue_year",
    "issue_years",
    "keep_issue_year",
    "missing_address",
    "null_profile",
    "oracle_sql",
    "queries",
    "ranked_within",
    "season",
    "semi_join_keys",
    "time_bin",
    "top_k_per",
]
