"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its runs of ``run`` words (three); documents are linked from a similarity of
``percent`` of a hundred (85). Documents with equal sets are
one class; only classes are compared.

Every class has minwise tokens. A tree of nodes branches by them: the roots' children are
the classes that agree in one of ``BRANCHES`` tokens of the tree, and a node with more than
``SMALL`` classes passes each to ``BRANCHES`` children, by two more tokens each, chosen by the
node's path. Two tokens at once part classes that met by a common passage in half the levels that one would
take. Two documents of similarity ``s`` are lost below a node with a chance ``q`` of at most ``((1 - p) / p) ** 2``, the solution of
``q = (1 - p + p q) ** 2`` for ``p = s ** 2``, however deep it goes, and by a tree with ``(1 - s + s q) ** 2``: 7.6 % at 0.85, so
one in a million with 6 independent trees; 20 % at 0.8, so 9 trees.

Small nodes are compared exhaustively. Sketches of one byte per token sort out the pairs that
agree in so few as linked ones do once in a million times; the others, the likeliest first,
are confirmed on full sets. As links are wanted for their components, pairs that are
connected already are passed over: a node whose classes are all connected is done, and so a
group of copies is done by about as many comparisons as it has members. The first tree's first tokens
are worked on alone for this reason; what they connect need not meet again. The others follow, ``ROOTS_AT_ONCE`` at a time.

A large node of which one component has all but ``OTHERS`` classes is done, too: its parts
are compared each with all of the others. Any other large node is compared in parts of ``SMALL`` classes, each with the same ``SAMPLES`` classes of
the node, which connects a large group of near copies in one level; and it branches on, which
parts classes that met by a common passage. Levels go on until every node is small or connected.

Defined cases: words are compared with A-Z in lower case; a document of fewer words than a run
has these as its one run; a null text, an empty one or one without words
has no set, is linked with nothing and kept; rows with one id share the links
of all of them, and stay together; rows without an id are in no component of ``groups`` and kept there, while
``deduplicated`` has them compared, too, and keeps one of the rows that have one id and the same words; an empty table
gives an empty result; extra columns are kept by ``deduplicated`` and not
read by ``groups``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import mixed, text_or_empty, written
from .components import extended, sized
from .idset import id_set

#: Words of a run, and a link's parts of a hundred in common, at least, unless others are asked for.
RUN = 3
PERCENT = 85
BRANCHES = 2
BYTES = 56
#: A pair at exactly ``percent`` is lost by all trees with this chance at most.
LOST = 1e-6
#: Classes of a node that are compared exhaustively, and those of a large one that go to all its parts.
SMALL, SAMPLES = 1024, 64
#: Classes of a large node outside its largest component that go to all its parts, at most.
OTHERS = 512
#: Documents without an id are numbered from here on: beyond all ids.
_NO_ID = 1 << 62
#: Root tokens worked on together, after the first ones: what some connect need not meet again at others.
ROOTS_AT_ONCE = 10
#: Rows of nodes that a task compares by sketches, and by full sets, about.
EACH, EACH_FULL = 2048, 512
#: Pairs of a node from which on intersections are worked out for all at once.
MANY = 100


@dataclass(frozen=True)
class Measure:
    """Which documents are linked, and what of the join follows from that."""

    run: int = RUN
    percent: int = PERCENT

    def __post_init__(self) -> None:
        # Two branches find nothing for sure where half of the pairs of tokens differ.
        if self.run < 1 or not 71 <= self.percent <= 100:
            raise ValueError("run must be 1 or more, percent from 71 to 100")

    @property
    def first(self) -> int:
        """Tokens of the roots: ``BRANCHES`` for each tree, as many trees as ``LOST`` asks for."""
        s = self.percent / 100
        below = ((1 - s * s) / (s * s)) ** 2
        one = (1 - s + s * below) ** 2
        return BRANCHES * max(1, math.ceil(math.log(LOST) / math.log(one)) if one else 1)

    @property
    def least_equal(self) -> int:
        """Equal sketch bytes below which a pair isn't fetched: five deviations under ``percent``."""
        s = self.percent / 100
        return math.floor(BYTES * s - 5 * math.sqrt(BYTES * s * (1 - s)))


def runs_of(text: str, run: int = RUN) -> np.ndarray:
    """The set of a text's runs of ``run`` words as sorted 64-bit hashes."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < run:
        return mixed(np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64) + np.uint64(len(h)))
    n = len(h) - run + 1
    out = mixed(h[:n])
    for k in range(1, run):
        out = mixed(out + h[k : k + n])
    return np.unique(out)


def tokens_of(runs: np.ndarray, number: int) -> np.ndarray:
    """The first minwise tokens of a set."""
    seeds = mixed(np.arange(1, 2 * number + 1, dtype=np.uint64))
    out = np.empty(number, np.uint64)
    for k in range(number):
        out[k] = ((runs ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))).min()
    return out


def _signed(docs: DataFrame, by: Measure = Measure()) -> DataFrame:
    """Id, size and key of each document's set, and its tokens: whole ones for the roots, bytes for the rest."""
    first = by.first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, roots, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                runs = runs_of(text, by.run)
                sizes.append(len(runs))
                keys.append(xxhash.xxh3_128_digest(runs.tobytes()) if len(runs) else None)
                tokens = tokens_of(runs, first + BYTES) if len(runs) else np.zeros(first + BYTES, np.uint64)
                roots.append(tokens[:first].view(np.int64))
                # Minima are small numbers: only after mixing are their top bytes even.
                sketches.append((mixed(tokens[first:]) >> np.uint64(56)).astype(np.uint8))
            n = len(sizes)
            flat = np.concatenate(roots) if n else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * first), pa.array(flat)),
                    pa.array([s.tobytes() for s in sketches], pa.binary()),
                ],
                ["doc_id", "n_shingles", "key", "roots", "sketch"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, key binary, roots array<long>, sketch binary")


def _together(rows: DataFrame, number: int, each: int, work, schema: str) -> DataFrame:
    """``work`` on Arrow tables that hold whole groups of (node, part), several at once.

    Groups are bounded, so a task holds a batch and what is left of the last one. Of about ``number``
    rows in all, a task gets some ``each``: more tasks than that would be idle ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            edges = _edges(now)
            rest = now.slice(int(edges[-2])) if len(edges) > 1 else now
            if len(edges) > 2:
                yield work(now.slice(0, int(edges[-2])), edges[:-1])
        if rest is not None and len(rest):
            yield work(rest, _edges(rest))

    return sized(rows.repartition("node", "part"), number, each).sortWithinPartitions("node", "part").mapInArrow(run, schema)


def _edges(rows: pa.Table) -> np.ndarray:
    """Where groups begin, and the end."""
    if not len(rows):
        return np.zeros(1, np.int64)
    node, part = (rows.column(c).to_numpy() for c in ("node", "part"))
    return np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (part[1:] != part[:-1]), True])


def _numbers(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, BYTES)
    return rows.column("root").to_numpy(), rows.column("n").to_numpy(), sketch


def _equal(root: np.ndarray, n: np.ndarray, sketch: np.ndarray, by: Measure) -> np.ndarray:
    """Equal sketch bytes of each pair of a group; 0 where they are connected or can't be linked."""
    equal = (sketch[:, None] == sketch[None]).sum(2)
    least, most = np.minimum(n[:, None], n[None]), np.maximum(n[:, None], n[None])
    return np.where((root[:, None] != root[None]) & (100 * least >= by.percent * most) & (equal >= by.least_equal), equal, 0)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as products of their incidence with runs that two sets have."""
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    times = np.diff(np.r_[first, len(flat)])
    number = np.cumsum(times > 1) - 1
    column = np.repeat(np.where(times > 1, number, -1), times)
    of, column = of[column >= 0], column[column >= 0]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[of[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _involved(rows: DataFrame, number: int, by: Measure) -> DataFrame:
    """Rows of groups that have a possible link of their own."""

    def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
        root, n, sketch = _numbers(table)
        keep = np.zeros(len(table), bool)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a > 1 and (root[a:b] != root[a]).any():
                keep[a:b] = _equal(root[a:b], n[a:b], sketch[a:b], by).any(1)
        found = table.filter(pa.array(keep)).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in found.columns], found.column_names)

    return _together(rows, number, EACH, work, "node long, part int, cid long, key binary, root long, n long, sketch binary")


def _confirmed(rows: DataFrame, number: int, by: Measure) -> DataFrame:
    """Links ``u``, ``v`` that connect what full sets link in each group."""

    def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
        root, n, sketch = _numbers(table)
        cid, runs = table.column("cid").to_pylist(), table.column("runs")
        us, vs = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            equal = np.triu(_equal(root[a:b], n[a:b], sketch[a:b], by))
            i, j = np.nonzero(equal)
            sets = [np.frombuffer(r, np.uint64) for r in runs.slice(a, b - a).to_pylist()]
            parent = {r: r for r in root[a:b].tolist()}

            def find(x: int, parent: dict[int, int] = parent) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            if len(i) > MANY:  # all at once: only pairs that are links are looked at one by one
                both, sizes = _common(sets)[i, j], n[a:b]
                linked = 100 * both >= by.percent * (sizes[i] + sizes[j] - both)
                i, j = i[linked], j[linked]
            else:
                linked = None
            for k in np.argsort(-equal[i, j], kind="stable").tolist():
                x, y = int(i[k]), int(j[k])
                one, two = find(int(root[a + x])), find(int(root[a + y]))
                if one == two:
                    continue
                both = 0 if linked is not None else len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if linked is not None or 100 * both >= by.percent * (len(sets[x]) + len(sets[y]) - both):
                    parent[max(one, two)] = min(one, two)
                    us.append(cid[a + x])
                    vs.append(cid[a + y])
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return _together(rows, number, EACH_FULL, work, "u long, v long")


def _sets(docs: DataFrame, ids: DataFrame, by: Measure) -> DataFrame:
    """``cid``, ``key`` and the full set of the documents with these ids, and perhaps of some more."""
    wanted = id_set(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted.may_have(batch.column(0))))
            runs = [runs_of(t, by.run) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([xxhash.xxh3_128_digest(r.tobytes()) for r in runs], pa.binary()),
                    pa.array([r.tobytes() for r in runs], pa.binary()),
                ],
                ["cid", "key", "runs"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("cid"), text_or_empty("text").alias("text"))
    # Of rows with one id and one text, one is enough.
    return rows.mapInArrow(run, "cid long, key binary, runs binary").groupBy("cid", "key").agg(F.first("runs").alias("runs"))


def _children(rows: DataFrame) -> DataFrame:
    """Classes of nodes passed on to ``BRANCHES`` children, each by two more tokens."""

    def byte(k: int, which: int) -> Column:
        place = F.pmod(F.xxhash64("node", F.lit(k), F.lit(which)), F.lit(BYTES)).cast("int")
        return F.substring("sketch", place + 1, F.lit(1))

    return rows.select(
        F.explode(F.array(*(F.xxhash64("node", F.lit(k), byte(k, 0), byte(k, 1)) for k in range(BRANCHES)))).alias("node"),
        "cid", "key", "n", "sketch",
    )


def _parted(rows: DataFrame) -> DataFrame:
    """Rows of large nodes dealt to parts, and the node's samples to each of them."""
    order = Window.partitionBy("node").orderBy(F.xxhash64("cid", "node"), "cid")
    parts = F.ceil(F.col("size") / (SMALL - SAMPLES)).cast("int")
    samples = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLES).drop("place")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("node", "cid", F.lit(1)), parts).cast("int"))
    spread = samples.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.unionByName(spread).distinct()


def _around(rows: DataFrame) -> DataFrame:
    """Rows of nodes with one large component: it is dealt to parts, and all others go to each of them."""
    parts = F.ceil(F.col("size") / (SMALL - OTHERS)).cast("int")
    inside = F.col("root") == F.col("top")
    dealt = rows.where(inside).withColumn("part", F.pmod(F.xxhash64("node", "cid", F.lit(1)), parts).cast("int"))
    return dealt.unionByName(rows.where(~inside).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))))


def linked_roots(classes: DataFrame, docs: DataFrame, by: Measure = Measure()) -> DataFrame:
    """``id`` and ``root`` of the classes that similarity connects to a smaller one.

    A level's links extend the roots of the levels before it, and the full set of a class
    is worked out once, when it first has a possible link. ``classes`` has ``cid`` (an id of the class), ``n``, ``key``, ``roots``, ``sketch``.
    """
    spark = classes.sparkSession
    found: DataFrame | None = None  # ``id`` and ``root`` of what is linked
    sets: list[DataFrame] = []
    linked = 0
    carried = ["cid", "key", "n", "sketch"]
    edges = [0, *range(BRANCHES, by.first, ROOTS_AT_ONCE), by.first]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        rows = (
            classes.select(*carried, F.posexplode("roots"))
            .where(F.col("pos").between(low, high - 1))
            .select(F.xxhash64("pos", "col").alias("node"), *carried)
        )
        while True:
            roots = spark.createDataFrame([], "cid long, root long") if found is None else found.withColumnRenamed("id", "cid")
            rows = rows.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
            nodes = written(
                rows.groupBy("node", "root")
                .agg(F.count("*").alias("classes"))
                .groupBy("node")
                .agg(F.sum("classes").alias("size"), F.max(F.struct("classes", "root")).alias("most"), F.count("*").alias("roots"))
                .where("roots > 1")
                .select("node", "size", F.col("most.root").alias("top"), (F.col("size") - F.col("most.classes")).alias("others")),
                "nodes",
            )
            members = written(rows.join(nodes, "node").select("node", *carried, "root", "size", "top", "others"), "members")
            small = members.where(F.col("size") <= SMALL).withColumn("part", F.lit(0))
            crowd = members.where((F.col("size") > SMALL) & (F.col("others") <= OTHERS))
            large = members.where((F.col("size") > SMALL) & (F.col("others") > OTHERS))
            parts = reduce(
                DataFrame.unionByName,
                (x.select("node", "part", "cid", "key", "root", "n", "sketch") for x in (small, _around(crowd), _parted(large))),
            )
            # What parts share adds a fraction; the number only sets how many tasks there are.
            involved = written(_involved(parts, 2 * members.count(), by), "involved")
            new = involved.select("cid", "key").distinct()
            if sets:
                new = new.join(reduce(DataFrame.unionByName, sets).select("cid", "key"), ["cid", "key"], "left_anti")
            new = written(new, "new")
            if n := new.count():
                sets.append(written(_sets(docs, sized(new.select("cid"), n), by).join(new, ["cid", "key"], "left_semi"), "sets"))
            if sets:
                full = involved.join(reduce(DataFrame.unionByName, sets), ["cid", "key"])
                links = written(_confirmed(full, involved.count(), by), "links")
                if n := links.count():
                    linked += n
                    found = written(sized(extended(found, links), linked), "roots")
            if large.isEmpty():
                break
            # Two readers follow: written, a class is passed on once.
            rows = written(_children(large), "children")
    return spark.createDataFrame([], "id long, root long") if found is None else found


def groups(docs: DataFrame, run: int = RUN, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every document."""
    by = Measure(run, percent)
    signed = written(_signed(docs, by), "signed")
    classes = written(
        signed.where("key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("least"),
            F.first("n_shingles").alias("n"),
            F.first("roots").alias("roots"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    # One text stands for a class; classes are told apart by id and key.
    named = classes.select(F.col("least").alias("cid"), "n", "key", "roots", "sketch")
    roots = linked_roots(named, docs, by)
    of_class = classes.join(roots.withColumnRenamed("id", "least"), "least", "left").select(
        "key", F.coalesce("root", "least").alias("component_id")
    )
    of_class = written(of_class, "roots")
    out = signed.select("doc_id", "n_shingles", "key").join(of_class, "key", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).cast("long").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, run: int = RUN, percent: int = PERCENT) -> DataFrame:
    """The documents of which each group keeps one, with their columns.

    Documents without an id take part under a number of their text's, beyond all ids, so
    they lose to copies that have one. Of rows with one id and the same words one is kept.
    """
    own = F.lit(_NO_ID) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    rows = docs.withColumn("_own", F.coalesce(F.col("doc_id").cast("long"), own))
    found = groups(rows.select(F.col("_own").alias("doc_id"), "text"), run, percent)
    dropped = found.where("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    kept = rows.join(dropped, F.col("_own") == F.col("_dropped"), "left_anti")
    # Ids of several rows are few; only their rows are compared, all others pass.
    several = kept.groupBy("_own").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_own")
    words = F.array_join(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")), " ")
    same = F.md5(F.translate(words, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    repeated = kept.join(several, "_own", "left_semi")
    one_each = repeated.where(~wordless).withColumn("_same", same).dropDuplicates(["_own", "_same"])
    return (
        kept.join(several, "_own", "left_anti").select(*docs.columns)
        .unionByName(repeated.where(wordless).select(*docs.columns))
        .unionByName(one_each.select(*docs.columns))
    )
