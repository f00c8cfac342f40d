"""Distinct values per year that can be added to: one bitmap a year, exact and mergeable.

Every value has a number in a dictionary that only grows; a year's values are the bits of its
bitmaps. Adding a year numbers its new values and writes that year's bitmaps, without a look at the
other years' rows; a year that is added again replaces its own. A count is the number of set bits, and the distinct values of
several years are the bits of their union, as bitmaps can be merged where counts can't.

Numbers are dealt in ``DEALS`` rows of places by the value's hash, so they are given out by many tasks
and stay dense; a dictionary of very many values needs no single sort. A number given to a value whose
job then failed is not used again, which wastes a bit and harms nothing. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import YEAR_COL
from ..sources.store import persisted

DEALS = 64


_VALUES = "value string, place long, deal int"


def _values(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_VALUES).parquet(f"{path}/values")


def add_years(spark: SparkSession, path: str, rows: DataFrame, column: str, by: str = YEAR_COL) -> None:
    """Put the values of ``column`` in ``rows`` into the table at ``path``; years that ``rows`` has are replaced.

    Each (year, value) pair leaves a task once; NULLs are no values.
    """
    pairs = rows.select(F.col(by).alias("by"), F.col(column).cast("string").alias("value")).distinct()
    with persisted(pairs) as pairs:
        deal = F.pmod(F.xxhash64("value"), F.lit(DEALS)).cast("int")
        # An empty call first: a table that is new is then read like any other.
        spark.createDataFrame([], _VALUES).write.mode("ignore").parquet(f"{path}/values/call=start")
        known = _values(spark, path)
        new = pairs.where("value IS NOT NULL").select("value").distinct().join(known, "value", "left_anti").withColumn("deal", deal)
        taken = known.groupBy("deal").agg(F.max("place").alias("last"))
        place = F.coalesce("last", F.lit(-1)) + F.row_number().over(Window.partitionBy("deal").orderBy("value"))
        # A folder for each call: what is read here is not written to.
        new.join(taken, "deal", "left").select("value", place.alias("place"), "deal").write.parquet(
            f"{path}/values/call={uuid.uuid4().hex[:12]}"
        )
        number = F.col("place") * DEALS + F.col("deal")
        bits = (
            pairs.where("value IS NOT NULL")
            .join(_values(spark, path), "value")
            .select("by", number.alias("number"))
            .groupBy("by", F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        )
        # A year without a value is listed, too, and replaces what it had.
        none = pairs.select("by").distinct().select("by", F.lit(-1).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bits"))
        (
            bits.unionByName(none)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("by")
            .parquet(f"{path}/bitmaps")
        )


def _bitmaps(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(f"bucket long, bits binary, by {kind}").parquet(f"{path}/bitmaps")


def distinct_counts(spark: SparkSession, path: str, name: str, by: str = YEAR_COL, kind: str = "int") -> DataFrame:
    """``by`` and the number of its distinct values; reads bitmaps only."""
    n = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint")
    return _bitmaps(spark, path, kind).groupBy(F.col("by").alias(by)).agg(n.alias(name)).where(F.col(name) > 0)


def distinct_over(spark: SparkSession, path: str, years: list[int] | None = None, kind: str = "int") -> int:
    """Distinct values of several years together (all by default): the bits of the union."""
    rows = _bitmaps(spark, path, kind).where("bits IS NOT NULL")
    if years is not None:
        rows = rows.where(F.col("by").isin(*years))
    union = rows.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return union.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))).first()[0]
