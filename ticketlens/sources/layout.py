"""How the rows of a citation table lie in its files, so that lookups pass over most of them.

Rows are ordered within each file by ``LOOKUP_COLS``. Parquet keeps the least and largest value of every row
group and page, so a filter on a code (or on a code and a precinct) reads the few whose range
holds it. A number that no order serves, like the summons number, gets a Bloom filter for each row group, which
says of nearly all groups that they don't have it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

#: What tickets are looked up by, in this order.
LOOKUP_COLS = ("violation_code", "issuer_precinct")
#: What single tickets are found by.
BLOOM_COLS = ("summons_number",)


def ordered(df: DataFrame, folders: Sequence[str] = (), by: Sequence[str] = LOOKUP_COLS) -> DataFrame:
    """Rows of each task in lookup order. The partition columns come first, as a task writes by them anyway: no second sort."""
    return df.sortWithinPartitions(*folders, *by)


def indexed(writer: DataFrameWriter, bloom: Sequence[str] = BLOOM_COLS, row_group_bytes: int | None = None) -> DataFrameWriter:
    """A Parquet writer that adds Bloom filters, each as large as its row group's values ask for."""
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
    if bloom:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", True)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    return writer
