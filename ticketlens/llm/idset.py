"""Packed sorted numbers, and a set of ids of fixed size that may hold too many."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

from .base import mixed

#: Bits of the set, whatever the number of ids.
BITS = 1 << 26
SHARD = 20


def packed(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct cells (below 2 to the 34) as differences, seven bits a byte; the lowest bit says hit more than once."""
    values = (np.diff(cells, prepend=0) << 1 | (counts > 1)).astype(np.uint64)
    size = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21) + (values >= 1 << 28)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - size
    for k in range(int(size.max()) if len(size) else 0):
        on = size > k
        more = (size[on] > k + 1).astype(np.uint8) << 7
        out[starts[on] + k] = ((values[on] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The cells of ``packed`` and whether each was hit more than once."""
    raw = np.frombuffer(data, np.uint8)
    last = raw < 128
    starts = np.flatnonzero(np.r_[True, last[:-1]])
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.r_[starts, len(raw)]))
    values = np.add.reduceat((raw & 127).astype(np.uint64) << (place * 7).astype(np.uint64), starts) if len(raw) else raw.astype(np.uint64)
    return np.cumsum((values >> np.uint64(1)).astype(np.int64)), (values & np.uint64(1)).astype(bool)


def _bit(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(np.uint64)) & np.uint64(BITS - 1)).astype(np.int64)


@dataclass
class IdSet:
    """A broadcast set: every id that was put in, and perhaps some more."""

    bits: Broadcast

    def may_have(self, ids: pa.Array) -> np.ndarray:
        """Whether ids may be in the set; null ids are not."""
        at = _bit(ids.fill_null(0).to_numpy(zero_copy_only=False))
        return ((self.bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool) & np.array(ids.is_valid())


def id_set(ids: DataFrame) -> IdSet:
    """The set of a frame's first column. What passes through the driver are its bits, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column(0).to_numpy(zero_copy_only=False)))
            shard = at >> SHARD
            edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(at) else at
            parts = np.split(at, edges[1:]) if len(at) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(p[0] >> SHARD) for p in parts], pa.int32()),
                    pa.array([packed(p & ((1 << SHARD) - 1), np.ones(len(p))) for p in parts], pa.binary()),
                ],
                ["shard", "cells"],
            )

    bits = np.zeros(BITS, bool)
    name = ids.columns[0]
    for row in ids.where(f"{name} IS NOT NULL").mapInArrow(run, "shard int, cells binary").toLocalIterator(True):
        bits[(row["shard"] << SHARD) + unpacked(row["cells"])[0]] = True
    return IdSet(ids.sparkSession.sparkContext.broadcast(np.packbits(bits)))
