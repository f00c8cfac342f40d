"""Connected components by local contraction and alternating stars.

Edges are kept in as many tasks as their number asks for. Every round begins with each
task contracting its own edges: those of a component that lies within the task become a star around
its least node, in arrays, without a shuffle. Edges that fit one task are done by
that; more go through rounds of large and small stars (joins and aggregates) between contractions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written

#: Edges that a task contracts at once.
TOGETHER = 400_000


def sized(df: DataFrame, rows: int, each: int = TOGETHER) -> DataFrame:
    """``df`` in as many partitions as so many rows ask for, without a shuffle."""
    return df.coalesce(max(1, -(-rows // each)))


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the least node that each can reach by them."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        # Roots hook onto the least root that an edge leads to, then paths are halved to their ends.
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root = shorter
        if (root == before).all():
            return nodes, nodes[root]


def _contracted(edges: DataFrame) -> DataFrame:
    """Each task's edges as stars around the least nodes of its components."""

    def stars(us: list[np.ndarray], vs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        nodes, roots = least_reachable(np.concatenate(us), np.concatenate(vs))
        return nodes[nodes != roots], roots[nodes != roots]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, held = [], [], 0
        for batch in batches:
            us.append(batch.column(0).to_numpy(zero_copy_only=False))
            vs.append(batch.column(1).to_numpy(zero_copy_only=False))
            held += len(batch)
            if held > 2 * TOGETHER:  # a forest has fewer edges than nodes
                u, v = stars(us, vs)
                us, vs, held = [u], [v], len(u)
                if held > TOGETHER:
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                    us, vs, held = [], [], 0
        if us:
            u, v = stars(us, vs)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def _large(edges: DataFrame) -> DataFrame:
    """Neighbours of each node that are larger than it get the least of its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = written(least, "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours get the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    down = written(down, "down")
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``root``, the least id reachable, of each node of links ``u``, ``v`` that isn't its own root.

    Links may come in any order, repeated or not. Rounds go on until nothing
    moves; each is written to the shared folder. A node that very many links
    share costs a row for each of them, minima are combined on the map side.
    """
    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
    while True:
        rows = edges.count()
        edges = written(_contracted(sized(edges, rows)), "contracted")
        if rows <= TOGETHER:  # one task had them all
            break
        before = _mark(edges)
        edges = written(_small(_large(edges)), "links")
        if _mark(edges) == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def extended(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``roots`` (``id``, ``root``; None for no links so far) after some more links.

    The links are put between the roots of their ends, so only what is new is worked on.
    """
    if roots is None:
        return components(links)
    u, v = (roots.select(F.col("id").alias(c), F.col("root").alias("r" + c)) for c in ("u", "v"))
    between = links.join(u, "u", "left").join(v, "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    new = components(between)
    moved = roots.join(new.select(F.col("id").alias("root"), F.col("root").alias("to")), "root", "left")
    return moved.select("id", F.coalesce("to", "root").alias("root")).unionByName(new)
