"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector ``x`` by ``K`` projections on normal vectors, shifted and cut into
slots of width ``WIDTH``; the slots' numbers are its bucket. A neighbour at distance
``r`` of a query has a projection that differs by a normal deviate of spread ``r``, so each
slot, and each bucket as a product, has a known chance to hold it. A query visits
buckets in the order of that chance until the chances add up to ``TARGET``; several tables
make up for what one misses. Candidates of all tables are ranked by exact inner products.

For the largest inner product, vectors are scaled by the longest one's length and get one
more component that makes them units; queries are scaled to units. Then
the nearest is the one with the largest inner product.

``r`` is measured: ``PROBES`` queries are compared with all vectors. The number of projections follows the
number of vectors, so buckets keep their size. Where the data has no structure, as random
directions have none, a high recall takes a large share of the buckets; that
share is then what the method needs, and it is not cut: the list of buckets goes on until ``TARGET``
is met. So that it stays bounded, so does the number of projections; more vectors then make larger
buckets. Queries that get too few candidates are compared with all vectors.

Equal vectors are one class with its smallest ids, so a vector that very many rows share is
compared once. Buckets are dealt to units of a bounded number of
vectors, and crowded units are split by id. A vector goes to one unit of each table; a query goes to the units whose
buckets it visits. Both are shuffled by unit and sorted so that a unit's vectors come first: a task holds these,
and the queries stream past them, however many there are.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part, as query or as candidate; ids that are
null take no part; equal scores go to the smaller id; rows repeated with one id count as one; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import mixed, written

TOP = 20
TABLES = 2
WIDTH = 1.0
#: Vectors of a bucket and of a unit, about.
BUCKET, UNIT = 256, 8192
#: Chance that a neighbour is in a visited bucket, of all tables together.
TARGET = 0.985
PROBES = 64
#: Buckets of a lower chance are listed only if the others don't add up to the target; the bound is then lowered by ``LOWER``.
LEAST_CHANCE, LOWER = 1e-6, 8
#: Bits that the number of a neighbour's bucket holds for a query, at most: a list is some times two to this power.
LIST_BITS = 17
#: Queries compared with a unit at once.
AT_ONCE = 256
SEED = 20


def valid(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vec`` (doubles) of the vectors that take part, once for each id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).cast("array<double>").alias("vec")).where(
        "vec_id IS NOT NULL AND size(vec) > 0"
        " AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(vec, x -> x <> 0)"
    )
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    rows = rows.where(F.size("vec") == (sizes["d"] if sizes else 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def classes(rows: DataFrame, top: int = TOP) -> DataFrame:
    """Equal vectors: ``cid`` (the smallest id), ``vec``, ``ids`` (the smallest ones, one more than a result has)."""
    key = ["h1", "h2"]
    hashed = rows.select("*", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    # The limit on the rank is applied before the shuffle, too.
    least = (
        hashed.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("vec_id")))
        .where(F.col("rank") <= top + 1)
    )
    return least.groupBy(*key).agg(
        F.min("vec_id").alias("cid"), F.min("vec").alias("vec"), F.array_sort(F.collect_list("vec_id")).alias("ids")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _unit_vectors(x: np.ndarray, longest: float) -> np.ndarray:
    """Scaled vectors with the component that makes them units."""
    x = x / longest
    return np.c_[x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))]


class Hashing:
    """The projections of all tables; vectors to buckets and queries to chances."""

    def __init__(self, dim: int, n: int, longest: float, radius: float, tables: int = TABLES, target: float = TARGET):
        # A projection on a unit's slots of width 1 tells about two bits.
        bits = max(0.5, 2.05 + math.log2(max(radius, 1e-9)))  # of a slot, for a query
        self.k = max(1, min(round(math.log2(max(2.0, n / BUCKET)) / 2.05), int(LIST_BITS / bits)))
        self.tables, self.longest, self.radius = tables, longest, radius
        self.each = 1 - (1 - target) ** (1 / tables)
        rng = np.random.default_rng(SEED)
        self.normal = rng.standard_normal((tables, self.k, dim + 1))
        self.shift = rng.uniform(0, WIDTH, (tables, self.k))

    def buckets(self, x: np.ndarray, t: int) -> np.ndarray:
        """Bucket numbers of vectors in a table."""
        slots = np.floor((_unit_vectors(x, self.longest) @ self.normal[t].T + self.shift[t]) / WIDTH).astype(np.int64)
        return self.numbers(slots)

    @staticmethod
    def numbers(slots: np.ndarray) -> np.ndarray:
        out = np.zeros(slots.shape[:-1], np.int64)
        for i in range(slots.shape[-1]):
            out = mixed(out.view(np.uint64) + (slots[..., i] + 1000 * (i + 1)).astype(np.uint64)).view(np.int64)
        return out

    def visits(self, q: np.ndarray, t: int) -> np.ndarray:
        """Buckets that one query visits in a table, the likeliest first."""
        unit = np.append(q / np.sqrt(q @ q), 0.0)
        place = (self.normal[t] @ unit + self.shift[t]) / WIDTH
        reach = math.ceil(6 * self.radius / WIDTH)
        own = np.floor(place).astype(np.int64)[:, None] + np.arange(-reach, reach + 2)
        edges = (own - place[:, None]) * WIDTH / max(self.radius, 1e-9)
        shares = np.diff(0.5 * (1 + np.vectorize(math.erf)(edges / math.sqrt(2))), axis=1)
        least = LEAST_CHANCE
        while True:
            slots, chance = np.zeros((1, 0), np.int64), np.ones(1)
            for at, share in zip(own, shares, strict=True):
                i, j = np.nonzero(chance[:, None] * share[None] >= least)
                chance, slots = chance[i] * share[j], np.c_[slots[i], at[j]]
            order = np.argsort(-chance, kind="stable")
            sums = np.cumsum(chance[order])
            if len(sums) and sums[-1] >= self.each:
                n = int(np.searchsorted(sums, self.each)) + 1
                return self.numbers(slots[order[:n]])
            if not least:  # all buckets within reach
                return self.numbers(slots[order])
            least = least / LOWER if least > 1e-15 else 0.0


def _radius(kinds: DataFrame, queries: list[np.ndarray], longest: float, top: int) -> float:
    """Distance, of units, that nine of ten neighbours of the sampled queries are within."""
    q = np.stack([v / np.sqrt(v @ v) for v in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                found = -np.sort(-(q @ x.T), axis=1)[:, : top + 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.arange(len(q), dtype=np.int32), found.shape[1])),
                        pa.array(np.ascontiguousarray(found).ravel()),
                    ],
                    ["q", "product"],
                )

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("product")))
    got = kinds.select("vec").mapInArrow(run, "q int, product double").withColumn("rank", rank).where(F.col("rank") <= top + 1)
    distance = np.array([math.sqrt(max(0.0, 2 - 2 * r["product"] / longest)) for r in got.where("rank > 1").collect()] or [0.0])
    return float(max(np.quantile(distance, 0.9), 1e-3))


class _Unit:
    """The vectors of a unit by bucket."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, buckets: np.ndarray):
        order = np.argsort(buckets, kind="stable")
        self.x, self.ids = x[order], ids[order]
        self.buckets, first = np.unique(buckets[order], return_index=True)
        self.edges = np.append(first, len(order))

    def best(self, q: np.ndarray, own: np.ndarray, lists: list[np.ndarray | None], top: int) -> pa.RecordBatch:
        """For each query its ``top + 1`` best of the vectors in its buckets; None stands for all buckets."""
        out_q, out_c, out_s = [], [], []
        for at in range(0, len(lists), AT_ONCE):
            some = lists[at : at + AT_ONCE]
            visited = np.zeros((len(some), len(self.buckets)), bool)
            for i, visits in enumerate(some):
                if visits is None:
                    visited[i] = True
                    continue
                place = np.minimum(np.searchsorted(self.buckets, visits), len(self.buckets) - 1)
                visited[i, place[self.buckets[place] == visits]] = True
            wanted = np.flatnonzero(np.repeat(visited.any(0), np.diff(self.edges)))
            if not len(wanted):
                continue
            bucket = np.searchsorted(self.edges, wanted, side="right") - 1
            ids = self.ids[wanted]
            scores = np.where(visited[:, bucket], q[at : at + AT_ONCE] @ self.x[wanted].T, -np.inf)
            last = max(0, len(wanted) - top - 1)
            least = np.partition(scores, last, axis=1)[:, last]  # the smallest of the best, all of its equals stay
            for i, s in enumerate(scores):
                near = np.flatnonzero((s >= least[i]) & (s > -np.inf))
                near = near[np.lexsort((ids[near], -s[near]))[: top + 1]]
                out_q.append(np.full(len(near), own[at + i]))
                out_c.append(ids[near])
                out_s.append(s[near])
        arrays = [np.concatenate(a) if a else np.empty(0, k) for a, k in ((out_q, np.int64), (out_c, np.int64), (out_s, float))]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["query", "cid", "score"])


def _streamed(data: DataFrame, asks: DataFrame, top: int) -> DataFrame:
    """``query``, ``cid`` and ``score``: the queries of each (t, unit, split) streamed past its vectors.

    Both sides are shuffled once, each row to its own unit; sorted, a unit's vectors come before its queries.
    """
    key = ["t", "unit", "split"]
    none = F.lit(None)
    rows = data.select(*key, F.lit(0).alias("asks"), "bucket", none.cast("array<long>").alias("buckets"), "cid", "vec").unionByName(
        asks.select(*key, F.lit(1).alias("asks"), none.cast("long").alias("bucket"), "buckets", "cid", "vec")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        unit: _Unit | None = None
        for batch in batches:
            if not len(batch):
                continue
            place = np.stack([batch.column(c).to_numpy() for c in (*key, "asks")], axis=1)
            edges = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(1), True])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                now, own = tuple(place[a, :3].tolist()), batch.slice(a, b - a)
                if now != at:
                    at, held, unit = now, [], None
                x, ids = _matrix(own.column("vec")), own.column("cid").to_numpy()
                if not place[a, 3]:
                    held.append((x, ids, own.column("bucket").to_numpy()))
                    continue
                if not held and unit is None:
                    continue  # no vector in this unit
                if unit is None:
                    unit, held = _Unit(*(np.concatenate([h[k] for h in held]) for k in range(3))), []
                column = own.column("buckets")
                offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
                valid = np.array(column.is_valid())
                lists = [flat[offsets[i] : offsets[i + 1]] if valid[i] else None for i in range(len(own))]
                yield unit.best(x, ids, lists, top)

    return rows.repartition(*key).sortWithinPartitions(*key, "asks").mapInArrow(run, "query long, cid long, score double")


def nearest(vectors: DataFrame, every: int = 20, top: int = TOP, target: float = TARGET) -> DataFrame:
    """For each row whose id is divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    spark = vectors.sparkSession
    rows = written(valid(vectors), "vectors")
    kinds = written(classes(rows, top), "classes")
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")
    )
    asked = written(kinds.join(queries.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("cid", "vec"), "queries")
    n, n_asked = kinds.count(), asked.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n_asked:
        return spark.createDataFrame([], schema)
    longest = kinds.agg(F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    some = [np.array(r["vec"]) for r in asked.orderBy(F.xxhash64("cid")).limit(PROBES).collect()]
    hashing = Hashing(len(some[0]), n, longest, _radius(kinds, some, longest, top), target=target)
    units = -(-n // UNIT)

    def unit_of(buckets: np.ndarray) -> np.ndarray:
        return (mixed(buckets.view(np.uint64)) % np.uint64(units)).astype(np.int32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vec"))
            for t in range(hashing.tables if len(x) else 0):
                buckets = hashing.buckets(x, t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(unit_of(buckets)), pa.array(buckets), *batch.columns],
                    ["t", "unit", "bucket", "cid", "vec"],
                )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, q in enumerate(_matrix(batch.column("vec"))):
                for t in range(hashing.tables):
                    visited = hashing.visits(q, t)
                    unit = unit_of(visited)
                    order = np.argsort(unit, kind="stable")
                    own, first = np.unique(unit[order], return_index=True)
                    lists = np.split(visited[order], first[1:])
                    k = len(own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(k, t, np.int32)),
                            pa.array(own),
                            pa.array([x.tolist() for x in lists], pa.list_(pa.int64())),
                            pa.concat_arrays([batch.column("cid").slice(i, 1)] * k),
                            pa.concat_arrays([batch.column("vec").slice(i, 1)] * k),
                        ],
                        ["t", "unit", "buckets", "cid", "vec"],
                    )

    dealt = written(kinds.select("cid", "vec").mapInArrow(deal, "t int, unit int, bucket long, cid long, vec array<double>"), "dealt")
    splits = dealt.groupBy("t", "unit").agg(F.ceil(F.count("*") / (2 * UNIT)).cast("int").alias("splits"))
    splits = written(splits, "splits")
    left = dealt.join(splits, ["t", "unit"]).withColumn("split", F.pmod(F.xxhash64("cid"), F.col("splits")).cast("int"))
    right = (
        asked.select("cid", "vec").mapInArrow(ask, "t int, unit int, buckets array<long>, cid long, vec array<double>")
        .join(splits, ["t", "unit"])
        .withColumn("split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    )

    def best_of(data: DataFrame, asks: DataFrame) -> DataFrame:
        found = (
            _streamed(data, asks, top)
            .groupBy("query", "cid").agg(F.max("score").alias("score"))
        )
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cid"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= top + 1)
        return written(found.join(kinds.select("cid", "ids"), "cid").select("query", "score", F.explode("ids").alias("vec_id")), "found")

    found = best_of(left, right)
    # Queries with too few candidates are compared with all vectors, in the units of the first table.
    enough = min(top + 1, kinds.agg(F.sum(F.size("ids"))).first()[0])
    served = found.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= enough)
    lacking = written(asked.join(served, asked["cid"] == served["query"], "left_anti").select("cid", "vec"), "lacking")
    if not lacking.isEmpty():
        whole = (
            lacking.withColumns({"t": F.lit(0), "unit": F.explode(F.sequence(F.lit(0), F.lit(units - 1)))})
            .join(splits, ["t", "unit"])
            .withColumns({"split": F.explode(F.sequence(F.lit(0), F.col("splits") - 1)), "buckets": F.lit(None).cast("array<long>")})
        )
        exact = best_of(left.where("t = 0"), whole)
        found = found.join(lacking.select(F.col("cid").alias("query")), "query", "left_anti").unionByName(exact)
    # Of a query's class, what any of its queries can get: one more than a result, as its own id may be among them.
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    found = written(found.withColumn("rank", rank).where(F.col("rank") <= top + 1), "ranked")
    keyed = written(queries.join(kinds.select("h1", "h2", F.col("cid").alias("query")), ["h1", "h2"]).select("query_id", "query"), "asked")
    # Ranks skip the query's own id: those behind it move up by one.
    place = found.select("query", F.col("vec_id").alias("own"), F.col("rank").alias("own_rank"))
    placed = keyed.join(place, (keyed["query"] == place["query"]) & (F.col("query_id") == F.col("own")), "left").select(
        "query_id", keyed["query"], "own_rank"
    )
    return (
        placed.join(found, "query")
        .where("query_id <> vec_id")
        .withColumn("rank", F.when(F.col("own_rank") < F.col("rank"), F.col("rank") - 1).otherwise(F.col("rank")).cast("int"))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
