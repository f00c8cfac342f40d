"""The two joins a Spark user writes where the reference typed values by hand.

* ``semi_join_keys``: keep rows whose key is among computed top-k keys (the
  reference read the keys off one printout and pasted them into the next
  filter).
* ``attach_fines``: left join to a fine schedule (the reference inlined the
  fines in a CASE).

No side is hinted: AQE broadcasts one whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (a top-k key list or a fine schedule as
a rule is) and shuffles both otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINE_SCHEMA = T.StructType(
    [T.StructField("violation_code", T.IntegerType(), False), T.StructField("fine", T.IntegerType(), True)]
)


def semi_join_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``on`` values appear in ``keys`` (LEFT SEMI).

    NULL keys never match. Catalyst pushes a semi join below an aggregate on
    the same keys, which would rescan the raw rows when ``df`` is a grouped
    count; ``agg.within_top_groups`` keeps such a filter above it.
    """
    return df.join(keys.select(*on), list(on), "left_semi")


def fine_table(spark: SparkSession, fines: Mapping[int, int]) -> DataFrame:
    """Fine schedule ``violation_code -> fine`` as a DataFrame."""
    rows = [(int(code), None if fine is None else int(fine)) for code, fine in sorted(fines.items())]
    return spark.createDataFrame(rows, FINE_SCHEMA)


def attach_fines(df: DataFrame, fines: DataFrame) -> DataFrame:
    """Left join the schedule on ``violation_code``; codes without a fine get NULL.

    A code that is listed twice with one fine counts once; with two fines the
    query fails, as neither is right.
    """
    several = F.raise_error(F.concat(F.lit("two fines for code "), F.col("violation_code").cast("string"))).cast("int")
    one = fines.groupBy("violation_code").agg(
        F.when(F.count_distinct("fine") > 1, several).otherwise(F.max("fine")).alias("fine")
    )
    return df.join(one, "violation_code", "left")
