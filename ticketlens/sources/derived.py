"""What is made of a yearly table, brought up to date with it: its count cube and its states.

A year's part of the cube is counted from the year's load and lies in a folder of the load's name,
so it is right as long as the manifest names that load. ``follow`` counts the loads that have no part
yet, which after an added year is that year alone, and lists them in ``done`` when they are written; a part that
a killed job left behind is not listed and is counted again. The distinct states are
bitmaps that the new parts are put into (``operators.distinct``); no older year is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cube import Cube, build
from ..operators.distinct import add_years
from ..schema import YEAR_COL
from .store import IN_YEAR_COL
from .yearly import BROKEN, Entry, at_once, entries_of, scan_of

_DONE = "load string"


def _done(spark: SparkSession, path: str) -> set[str]:
    # An empty list first: a new folder is then read like any other.
    spark.createDataFrame([], _DONE).write.mode("ignore").json(f"{path}/done/call=start")
    return {r["load"] for r in spark.read.schema(_DONE).json(f"{path}/done").collect()}


def _part(path: str, entry: Entry) -> str:
    return f"{path}/cube/load={entry.load}/{YEAR_COL}={entry.file_year}"


def _clean(spark: SparkSession, target: str, entry: Entry, broken: str) -> DataFrame:
    rows = scan_of(spark, target, [entry]).where(F.col(IN_YEAR_COL))
    return rows if broken == "keep" else rows.where(~F.col(BROKEN))


def _cube(spark: SparkSession, path: str, entries: Mapping[int, Entry], schema: T.StructType) -> Cube:
    folders = T.StructType([*schema, T.StructField("load", T.StringType()), T.StructField(YEAR_COL, T.IntegerType())])
    rows = spark.read.schema(folders).option("basePath", f"{path}/cube").parquet(*(_part(path, e) for e in entries.values()))
    return Cube(rows.drop("load"))


def follow(spark: SparkSession, target: str, path: str, broken: str = "keep", excluded_state: str = "99") -> tuple[Cube, str]:
    """The cube of the clean rows of all years of the table at ``target``, kept at ``path``, and the folder of
    the states' bitmaps. Years that were loaded since the last call are counted; ``path`` serves one choice of the other arguments.
    """
    path, entries = path.rstrip("/"), entries_of(spark, target)
    if not entries:
        raise ValueError(f"no committed table at {target}")
    known = _done(spark, path)
    new = {y: e for y, e in entries.items() if e.load not in known}
    some = build(_clean(spark, target, next(iter(entries.values())), broken)).drop(YEAR_COL)

    def count(year: int) -> None:
        # A folder's rows are of one year: the name tells it.
        rows = build(_clean(spark, target, new[year], broken)).drop(YEAR_COL)
        rows.coalesce(1).sortWithinPartitions("cuboid").write.mode("overwrite").parquet(_part(path, new[year]))

    at_once(count, new)
    states = f"{path}/states"
    if new:
        cube = _cube(spark, path, new, some.schema)
        found = cube.cuboid(["registration_state"]).where(F.col("registration_state") != excluded_state)
        years = spark.createDataFrame([(y, None) for y in new], f"{YEAR_COL} int, registration_state string")
        # Every new year is named, so that one without a state replaces what it had.
        add_years(spark, states, found.select(YEAR_COL, "registration_state").unionByName(years), "registration_state")
        done = spark.createDataFrame([(e.load,) for e in new.values()], _DONE)
        done.coalesce(1).write.json(f"{path}/done/call={uuid.uuid4().hex[:12]}")
    return _cube(spark, path, entries, some.schema), states
