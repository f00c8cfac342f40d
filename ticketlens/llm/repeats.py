"""Substring dedup with a count-min prefilter.

A window is 13 consecutive words of one document. A word goes if a window
that covers it also starts in a document with a smaller id.

0. Documents with the same text as one with a smaller id lose all words (if they
   have a window) and take no part in what follows: their windows are the first one's. They are
   found by grouping digests of the texts.
1. Each task makes a count-min sketch of its windows: for each of ``DEPTH`` rows
   the cells that its windows fall in, with a mark for those hit more than
   once, as differences of sorted cell numbers. The sketches are cut into
   shards, shuffled and added up shard by shard. What is kept of a shard is one bit for each cell:
   counted more than once or not.
2. A second pass over the texts drops the windows that some row counts once: a
   sketch never counts too little, so they are in no other document. The windows
   left, those repeated and a few that share their cells, are grouped exactly:
   the smallest document id of each window, combined on the map side first, so
   a window that a third of all documents have is one row for each task.
3. Windows with a smaller id elsewhere mark their words; documents with
   marks, and only those, meet their places again and lose the words.

The sketch has about ``CELLS_PER_WINDOW`` cells per window and row up to ``MOST_BITS`` bits, the
bound of what is broadcast. Beyond that more windows pass the filter, up to all of them,
and the exact grouping does the rest: the result is the same.

Windows are compared by two independent hashes, 96 bits together.

Defined cases: a null text has no words; a document of fewer than 13 words
keeps all; repeats within a document stay; rows with the same id are judged
each on their own and never against each other; rows without an id take no
part in the comparison and keep their words; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import mixed, text_or_empty, written
from .idset import IdSet, id_set, packed, unpacked

WINDOW = 13
DEPTH = 2
CELLS_PER_WINDOW = 4
#: Bits of the merged sketch, at most (two to a power).
MOST_BITS = 1 << 30
LEAST_BITS = 1 << 20
#: Bits of one shard of one row.
SHARD_BITS = 1 << 22
#: Bytes of a word with its blank, about.
WORD_BYTES = 6


def words_of(text: str) -> list[bytes]:
    """Runs of anything but the six white-space characters, in UTF-8."""
    return text.encode().split()


def windows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window, by its first word's place."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    # Hashes of runs of 2, 4 and 8 words, then 8 + 4 + 1.
    two = mixed(h[:-1] * np.uint64(3)) + h[1:]
    four = mixed(two[:-2] * np.uint64(5)) + two[2:]
    eight = mixed(four[:-4] * np.uint64(7)) + four[4:]
    whole = mixed(mixed(eight[:n] * np.uint64(11)) + four[8 : 8 + n]) + h[12 : 12 + n]
    other = mixed(mixed(eight[:n] + np.uint64(13)) * np.uint64(9) + four[8 : 8 + n]) ^ (h[12 : 12 + n] * np.uint64(17))
    return mixed(whole), mixed(other)


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each window in a row of the sketch."""
    return (mixed(hashes + np.uint64(row * 0x9E3779B97F4A7C15 & (2**64 - 1))) & np.uint64(bits - 1)).astype(np.int64)


#: The place that stands for all words of a document.
EVERYWHERE = 2**32 - 1
#: Texts that a worker has in hand at once.
TOGETHER = 1000
#: Windows whose cells are packed at once.
WINDOWS_TOGETHER = 1_500_000


def _pairs(docs: DataFrame) -> DataFrame:
    """Id, text, and 31 bits of the text's hash, which tell rows apart that have the same id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")).withColumn(
        "mark", F.shiftrightunsigned(F.xxhash64("text"), 33)
    )


def copies(pairs: DataFrame) -> DataFrame:
    """``doc_id`` and ``mark`` of documents whose text one with a smaller id has, too."""
    digests = pairs.where("doc_id IS NOT NULL").select(
        "doc_id", "mark", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2")
    )
    first = digests.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = written(first.where("first < last").select("d1", "d2", "first"), "first-texts")
    return digests.join(first, ["d1", "d2"]).where("first < doc_id").select("doc_id", "mark").distinct()


def _judged(pairs: DataFrame, copied: DataFrame, hit: IdSet) -> list[tuple[DataFrame, IdSet | None]]:
    """The documents to compare: those that the set of copies can't have, and those that it has wrongly.

    The first are all documents, to be filtered by the set; the others are few.
    """

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(hit.may_have(batch.column(0))))

    known = pairs.where("doc_id IS NOT NULL")
    wrong = known.mapInArrow(some, "doc_id long, text string, mark long").join(copied, ["doc_id", "mark"], "left_anti")
    return [(known, hit), (written(wrong.select("doc_id", "text", "mark"), "no-copies"), None)]


def _slices(batches: Iterator[pa.RecordBatch], without: IdSet | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), TOGETHER):
            part = batch.slice(at, TOGETHER)
            yield part if without is None else part.filter(pa.array(~without.may_have(part.column(0))))


def sketch_bits(text_bytes: int, most: int = MOST_BITS) -> int:
    """Bits of one row of the sketch."""
    wanted = max(LEAST_BITS, text_bytes // WORD_BYTES * CELLS_PER_WINDOW)
    return 1 << min(int(wanted - 1).bit_length(), (most // DEPTH).bit_length() - 1)


def sketch(judged: list[tuple[DataFrame, IdSet | None]], bits: int) -> bytes:
    """The merged sketch: for each row and cell a bit, whether more than one window fell in."""
    shard_bits = min(bits, SHARD_BITS)

    def counted(docs: DataFrame, without: IdSet | None) -> DataFrame:
        def packed_rows(hashes: np.ndarray) -> pa.RecordBatch:
            shards, data = [], []
            for row in range(DEPTH):
                cells = np.sort(_cells(hashes, row, bits))
                first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
                counts = np.diff(np.r_[first, len(cells)])
                cells = cells[first]
                own = cells // shard_bits
                edges = np.r_[np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), len(cells)]
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    shards.append(row * (bits // shard_bits) + int(own[a]))
                    data.append(packed(cells[a:b] - own[a] * shard_bits, counts[a:b]))
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(data, pa.binary())], ["shard", "cells"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in _slices(batches, without):
                for text in batch.column("text").to_pylist():
                    # Within a document a repeated window counts once.
                    held.append(np.unique(windows_of(words_of(text))[0]))
                    size += len(held[-1])
                    if size >= WINDOWS_TOGETHER:
                        yield packed_rows(np.concatenate(held))
                        held, size = [], 0
            if size:
                yield packed_rows(np.concatenate(held))

        return docs.mapInArrow(run, "shard int, cells binary")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a task come shard by shard; one shard's counts are held at a time.
        at, counts = None, np.zeros(shard_bits, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], ["shard", "bits"]
            )

        for batch in batches:
            for shard, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != at:
                    if at is not None:
                        yield done()
                    at = shard
                    counts[:] = 0
                where, many = unpacked(cells)
                counts[where] = np.minimum(counts[where] + 1 + many, 2)
        if at is not None:
            yield done()

    merged = (
        reduce(DataFrame.unionByName, (counted(*x) for x in judged))
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(add_up, "shard int, bits binary")
    )
    flat = np.zeros(DEPTH * bits // 8, np.uint8)
    for row in written(merged, "sketch").toLocalIterator():
        at = row["shard"] * (shard_bits // 8)
        flat[at : at + shard_bits // 8] = np.frombuffer(row["bits"], np.uint8)
    return flat.tobytes()


def _repeated(hashes: np.ndarray, sketch_bytes: bytes) -> np.ndarray:
    """Whether every row of the sketch counts a window more than once."""
    table = np.frombuffer(sketch_bytes, np.uint8).reshape(DEPTH, -1)
    keep = np.ones(len(hashes), bool)
    bits = table.shape[1] * 8
    for row in range(DEPTH):
        on = np.flatnonzero(keep)
        cells = _cells(hashes[on], row, bits)
        keep[on] = (table[row][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1
    return keep


def candidates(docs: DataFrame, without: IdSet | None, table: Broadcast) -> DataFrame:
    """Windows that the sketch counts more than once: two hashes, document, and
    the text's mark above the window's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, without):
            a, b, ids, places = [], [], [], []
            for doc_id, text, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, two = windows_of(words_of(text))
                at = np.flatnonzero(_repeated(one, table.value))
                a.append(one[at])
                b.append(two[at])
                ids.append(np.full(len(at), doc_id, np.int64))
                places.append(at.astype(np.int64) | mark << 32)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(a).view(np.int64)),
                        pa.array((np.concatenate(b) >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(np.concatenate(ids)),
                        pa.array(np.concatenate(places)),
                    ],
                    ["a", "b", "doc_id", "place"],
                )

    return docs.mapInArrow(run, "a long, b int, doc_id long, place long")


def marks(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id`` and the places (below its text's mark) of windows that start in a document with a smaller id.

    A copy of a whole text has the one place ``EVERYWHERE``.
    """
    spark, pairs = docs.sparkSession, _pairs(docs)
    copied = written(copies(pairs), "copies")
    judged = _judged(pairs, copied, id_set(copied.select("doc_id")))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    table = spark.sparkContext.broadcast(sketch(judged, sketch_bits(size, most_bits)))
    found = reduce(DataFrame.unionByName, (candidates(rows, without, table) for rows, without in judged))
    first = (
        found.groupBy("a", "b")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("a", "b", "first")
    )
    # Read from files, the two sides of the join are shuffled for it alone, so that
    # Spark can split a window that very many documents have.
    first = written(first, "first-windows")
    places = found.join(first, ["a", "b"]).where("first < doc_id").select("doc_id", "place")
    whole = copied.select("doc_id", F.shiftleft("mark", 32).bitwiseOR(F.lit(EVERYWHERE)).alias("place"))
    out = written(places.unionByName(whole).groupBy("doc_id").agg(F.collect_set("place").alias("places")), "marks")
    table.destroy()  # what was written needs the sketch no more
    return out


def kept_words(text: str, places: np.ndarray) -> list[bytes]:
    """The words that no window at these places covers."""
    words = words_of(text)
    if (places == EVERYWHERE).any():
        return words if len(words) < WINDOW else []
    cover = np.zeros(len(words) + 1, np.int32)
    np.add.at(cover, places, 1)
    np.add.at(cover, np.minimum(places + WINDOW, len(words)), -1)
    kept = np.cumsum(cover[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


def deduplicated(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of every document."""
    marked = marks(docs, most_bits)
    hit = id_set(marked.select("doc_id"))
    pairs = _pairs(docs)

    def rows(ids, texts, marks_, places) -> pa.RecordBatch:
        counts, removed, digests = [], [], []
        for text, mark, own in zip(texts, marks_, places, strict=True):
            if own is None:
                words = words_of(text)
                n, left = len(words), words
            else:
                spots = np.array(own, np.int64)
                spots = spots[spots >> 32 == mark] & EVERYWHERE
                n, left = len(words_of(text)), kept_words(text, spots)
            counts.append(n)
            removed.append(n - len(left))
            digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, hit):
            yield rows(*batch.columns[:1], *(c.to_pylist() for c in batch.columns[1:]), [None] * len(batch))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(hit.may_have(batch.column(0))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows(*batch.columns[:1], *(c.to_pylist() for c in batch.columns[1:]))

    untouched = pairs.mapInArrow(whole, schema)
    touched = pairs.mapInArrow(some, "doc_id long, text string, mark long").join(marked, "doc_id", "left")
    touched = touched.select("doc_id", "text", "mark", "places")
    return untouched.unionByName(touched.mapInArrow(cut, schema))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT r, doc_id, i, array_to_string(words[i:i + 12], ' ') AS w FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)),
m AS (SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM g) WHERE first < doc_id),
c AS (SELECT r, list(DISTINCT i + k) AS covered FROM (SELECT r, i, unnest(range(13)) AS k FROM m) GROUP BY r),
k AS (
    SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(covered), 0) AS BIGINT) AS n_removed,
        list_filter(words, lambda x, i: NOT coalesce(list_contains(covered, i), false)) AS kept
    FROM d LEFT JOIN c USING (r)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
