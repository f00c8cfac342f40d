"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import ensure_shared_dir

#: White space of the word rule: blank and the code points 9 to 13.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


#: Rows and bytes of an Arrow batch of texts, unless the session has settings of its own: texts are long, and a
#: task's memory is that of a few batches on either side.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table of a data folder (any path Spark's readers open)."""
    for key, (usual, own) in BATCHES.items():
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, own)
    # Python workers import this library from where the driver has it, unless it is installed.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the cluster's shared folder."""
    return f"{ensure_shared_dir(spark)}/ticketlens-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read of files that every
    executor can reach, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a whole string column in one array, and the start of each row.

    Nulls count as empty. The offsets have one entry more than the rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(raw: np.ndarray, offsets: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows in turn, as many at once as have about ``limit`` bytes, a long one alone."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield raw[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
        at = upto


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits look random (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x
