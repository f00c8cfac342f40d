"""Counts and ranges from file footers: answers that Parquet's statistics hold, without reading a row.

Spark takes ``count(*)``, ``min`` and ``max`` grouped by partition columns from the footers of a
Parquet table if the table is read through its version-2 source with aggregate
push-down. Both are session settings, so the statistics are asked in a session of
their own that shares the caller's application; the caller's settings stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that takes aggregates from footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_counts(spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
    """Rows of each partition folder: the partition columns ``folders`` (all of the table's) and ``n``."""
    table = footer_session(spark).read.schema(schema).parquet(path)
    return table.groupBy(*folders).agg(F.count(F.lit(1)).alias("n"))


def column_ranges(
    spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[str], column: str
) -> list[tuple[tuple, object, object]]:
    """Least and largest value of an integral ``column`` in each partition folder, as a list.

    One entry per folder comes to the driver, as the file listing does. A file without any value has no
    statistics; then a scan of this one column answers.
    """
    if schema[column].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"footers hold exact ranges of integral columns only, not of {column}")

    def asked(session: SparkSession) -> list[tuple[tuple, object, object]]:
        table = session.read.schema(schema).parquet(path)
        rows = table.groupBy(*folders).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        return [(tuple(r[c] for c in folders), r["lo"], r["hi"]) for r in rows]

    try:
        return asked(footer_session(spark))
    except Exception as e:  # a failed task's error comes as the JVM's
        if "No min/max found" not in str(e):
            raise
        return asked(spark)
