"""Top-k of keys with very many values, exact, without shuffling the counts of rare ones.

The plain form counts every value and ranks the counts: a street, plate or summons
number sends nearly as many partial counts as there are rows. Here a first pass keeps ``capacity`` counters per
task and year, by the rule of Misra and Gries: where more are needed, all counters are lowered by the
largest one that has to go, and the sum of what was lowered is the task's error. A value's count lies between the
sum of its counters and that sum plus the year's error, and a value without a counter has at
most the error.

Values that can be among the first ``k`` are then counted exactly in a second pass that
shuffles only these. A year is settled if its ``k``-th exact count is more than
the error. Any other year (many tasks, flat counts, a small capacity) is counted in the plain form,
so the answer is always that of the plain form.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schema import YEAR_COL
from ..sources.store import spooled
from .agg import counts_by, top_k_per

CAPACITY = 1024


def lowered(counters: dict, capacity: int) -> tuple[dict, int]:
    """At most ``capacity`` counters, and by how much all were lowered."""
    if len(counters) <= capacity:
        return counters, 0
    cut = sorted(counters.values(), reverse=True)[capacity]
    return {key: n - cut for key, n in counters.items() if n > cut}, cut


def candidates(rows: DataFrame, key: str, capacity: int = CAPACITY, by: str = YEAR_COL) -> DataFrame:
    """Counters of all tasks: ``by``, ``key``, ``low``; and ``error`` in a row per task and year, which counts no key.

    At most ``capacity + 1`` rows per task and year. NULL keys are not counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict = defaultdict(dict)
        error: dict = defaultdict(int)
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(["by", "key"]).aggregate([([], "count_all")])
            touched = set()
            for year, value, n in zip(*(counted.column(c).to_pylist() for c in ("by", "key", "count_all")), strict=True):
                error[year] += 0
                if value is not None:
                    own = counters[year]
                    own[value] = own.get(value, 0) + n
                    touched.add(year)
            for year in touched:
                counters[year], cut = lowered(counters[year], capacity)
                error[year] += cut
        for year, e in error.items():
            own = counters[year]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([year] * (len(own) + 1), schema.field("by").type),
                    pa.array([None, *own], schema.field("key").type),
                    pa.array([0, *own.values()], pa.int64()),
                    pa.array([e, *[0] * len(own)], pa.int64()),
                ],
                ["by", "key", "low", "error"],
            )

    picked = rows.select(F.col(by).alias("by"), F.col(key).alias("key"))
    schema = to_arrow_schema(picked.schema)
    out = T.StructType([*picked.schema, T.StructField("low", T.LongType()), T.StructField("error", T.LongType())])
    return picked.mapInArrow(run, out)


def top_k_heavy(rows: DataFrame, key: str, k: int, capacity: int = CAPACITY, by: str = YEAR_COL) -> DataFrame:
    """The ``k`` most frequent values of ``key`` per year: ``by, key, n, rk``, as ``top_k_per`` of all counts.

    Runs the first pass and the check at once; what comes to the driver is a row per year.
    """
    if k < 1 or capacity < k:
        raise ValueError("capacity must be at least k, and k at least 1")
    first = spooled(candidates(rows, key, capacity, by), "heavy-candidates")
    known = first.where("key IS NOT NULL").groupBy("by", "key").agg(F.sum("low").alias("low"))
    error = first.groupBy("by").agg(F.sum("error").alias("error"))
    least = top_k_per(known, "by", "low", k, "key").groupBy("by").agg(F.min("low").alias("kth"))
    possible = known.join(error, "by").join(least, "by").where("low + error >= kth").select("by", "key")
    picked = rows.select(F.col(by).alias("by"), F.col(key).alias("key"))
    exact = spooled(picked.join(possible, ["by", "key"], "left_semi").groupBy("by", "key").agg(F.count("key").alias("n")), "heavy-counts")
    kth = top_k_per(exact, "by", "n", k, "key").groupBy("by").agg(F.min("n").alias("kth"), F.count("*").alias("found"))
    years = error.join(kth, "by", "left").collect()
    # Fewer than k values with counters are all that there are if no counter was ever lowered.
    settled = [r["by"] for r in years if r["kth"] is not None and (not r["error"] or (r["found"] == k and r["kth"] > r["error"]))]
    open_years = [r["by"] for r in years if r["by"] not in settled]
    ranked = top_k_per(_with_null(exact, picked, settled, k), "by", "n", k, "key")
    if open_years:
        plain = counts_by(picked.where(F.col("by").isin(*open_years)), ["by", "key"], "key")
        ranked = ranked.unionByName(top_k_per(plain, "by", "n", k, "key"))
    return ranked.select(F.col("by").alias(by), F.col("key").alias(key), "n", "rk")


def _with_null(exact: DataFrame, picked: DataFrame, settled: list, k: int) -> DataFrame:
    """The exact counts of settled years; in a year of fewer than ``k`` values the NULL key has a place, with count 0."""
    counts = exact.where(F.col("by").isin(*settled)) if settled else exact.limit(0)
    few = [r["by"] for r in counts.groupBy("by").count().where(F.col("count") < k).collect()]
    if not few:
        return counts
    null = picked.where(F.col("by").isin(*few) & F.col("key").isNull()).select("by", "key", F.lit(0).cast("bigint").alias("n")).distinct()
    return counts.unionByName(null)
