"""A count cube: the questions' grouped counts, taken from the rows once.

``build`` counts the clean rows by several grouping sets in one scan, each a *cuboid*
of the year and one or two more keys. A question names the keys it groups by; ``counts``
serves it from the rows themselves or, if it is given a cube, from the smallest cuboid that
has all of the keys, rolled up. A count of a column is a sum of counts, so the answers
are the same.

Each task combines its rows before the shuffle: what leaves it is one partial row per key
combination and cuboid, however many rows a code or precinct has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import season, time_bin
from ..schema import YEAR_COL

CUBOID_COL = "cuboid"
#: Keys that are worked out from a row.
DERIVED = {"time_bin": lambda: time_bin("violation_time"), "season": lambda: season("issue_date")}
#: The grouping sets beside the year.
CUBOIDS: dict[str, tuple[str, ...]] = {
    "code_precinct": ("violation_code", "issuer_precinct"),
    "code_bin": ("violation_code", "time_bin"),
    "code_season": ("violation_code", "season"),
    "violation_precinct": ("violation_precinct",),
    "state": ("registration_state",),
    "body_type": ("vehicle_body_type",),
    "make": ("vehicle_make",),
}
#: Columns that are counted though no cuboid has them as a key.
COUNTED = ("summons_number", "issue_date")


@dataclass(frozen=True)
class Cube:
    """The cuboids as one table, ``CUBOID_COL`` a partition column."""

    rows: DataFrame

    def cuboid(self, keys: Sequence[str]) -> DataFrame:
        """The first cuboid with these keys, smaller sets before larger."""
        need = set(keys) - {YEAR_COL}
        for name, has in sorted(CUBOIDS.items(), key=lambda c: len(c[1])):
            if need <= set(has):
                return self.rows.where(F.col(CUBOID_COL) == name)
        raise KeyError(f"no cuboid has the keys {sorted(need)}")


def build(clean: DataFrame) -> DataFrame:
    """All cuboids of the clean rows: ``cuboid``, the keys (NULL where a cuboid lacks them), ``n`` and ``n_<column>``."""
    keys = list(dict.fromkeys(k for has in CUBOIDS.values() for k in has))
    rows = clean.select(
        YEAR_COL,
        *(DERIVED[k]().alias(k) if k in DERIVED else F.col(k) for k in keys),
        *(F.col(c).isNotNull().cast("long").alias(f"_has_{c}") for c in COUNTED),
    )
    sets = [[YEAR_COL, *has] for has in CUBOIDS.values()]
    # A set's number among those of grouping_id: a bit is 1 where the key is not in the set.
    place = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in has) for name, has in CUBOIDS.items()}
    name = reduce(lambda chain, one: chain.when(F.col("_set") == one[1], F.lit(one[0])), place.items(), F)
    return (
        rows.groupingSets(sets, YEAR_COL, *keys)
        .agg(
            F.grouping_id().alias("_set"),
            F.count(F.lit(1)).alias("n"),
            *(F.sum(f"_has_{c}").alias(f"n_{c}") for c in COUNTED),
        )
        .select(name.alias(CUBOID_COL), YEAR_COL, *keys, "n", *(f"n_{c}" for c in COUNTED))
    )


def counts(source: DataFrame | Cube, keys: Sequence[str], **what: str | None) -> DataFrame:
    """``keys`` and, for each ``name=column``, the rows where the column is not NULL (``None``: all rows).

    ``source`` are clean rows or a cube. Derived keys may be named like columns.
    """
    if isinstance(source, Cube):
        rows = source.cuboid(keys)

        def amount(column: str | None) -> Column:
            if column is None:
                return F.sum("n")
            if column in COUNTED:
                return F.sum(f"n_{column}")
            if column in keys:
                return F.sum(F.when(F.col(column).isNotNull(), F.col("n")).otherwise(F.lit(0).cast("long")))
            raise KeyError(f"{column} is neither a key nor counted in the cube")

    else:
        needed = dict.fromkeys([*keys, *(c for c in what.values() if c is not None)])
        rows = source.select(*(DERIVED[k]().alias(k) if k in DERIVED and k not in source.columns else F.col(k) for k in needed))

        def amount(column: str | None) -> Column:
            return F.count(F.lit(1) if column is None else F.col(column))

    return rows.groupBy(*keys).agg(*(amount(c).cast("bigint").alias(name) for name, c in what.items()))
