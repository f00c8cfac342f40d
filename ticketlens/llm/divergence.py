"""Source divergence audit: how the words of one source differ from another's and from its language's.

Terms are runs of letters and of characters outside ASCII, A-Z in lower case; a
language keeps the terms of at least ``LEAST`` of its documents, ``V`` of them. A
source with ``count`` occurrences of a term, and ``N`` of all kept terms, gives it the smoothed
share ``p = 1 + floor(SCALE (count + 1) / (N + V))``; two shares diverge by
``floor((p - q)^2 / q)``. Part ``pair`` adds that up over all kept terms for
every ordered pair of sources of a language; part ``term`` lists each source's
terms with the largest divergence from the language's share.

Pairs by a frequent-pattern tree. A term's row is its nonzero counts in the
order of sources. With ``z`` for the share of a count of zero, a pair's sum is

    V f(z_s, z_t)  +  sum over s's nonzero terms of f(p, z_t) - f(z_s, z_t)
                   +  sum over t's nonzero terms of f(z_s, q) - f(z_s, z_t)
                   +  sum over terms nonzero in both of f(p, q) - f(p, z_t) - f(z_s, q) + f(z_s, z_t).

The first three need counts of counts only. The last is taken from the tree: rows
are inserted with their multiplicities, so terms whose rows begin alike share a path, and each
node meets each of its ancestors once, weighed with the terms that pass through the node.
Distinct rows are dealt to tasks by ranges of their order, so rows with one
beginning meet, while no path, however common, holds a task up; a tree
that is cut by a border between tasks, or between chunks of ``ENTRIES`` entries, adds up to the same sums.

What grows: a term's row has at most as many entries as its language has sources, and the result has
a row for every pair of these, as asked for; a node-ancestor combination is worked on in blocks of
``COMBINATIONS``. All arithmetic is in integers: sums leave the tasks in two halves and are added as decimals.

Defined cases: null text, language and source count as ''; a row is a document, repeated ones too; a group
without a kept term has counts of zero; a language without kept terms has divergence 0 between all sources
and no terms; a language of one source has no pair; equal values are ranked by the item's bytes; an empty table gives an
empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import text_or_empty, written

#: Documents that have a kept term, at least; terms listed for a source; the scale of shares.
LEAST, TERMS, SCALE = 3, 200, 1_000_000_000
#: Entries that a task's counts, or a chunk of a tree, hold at once.
ENTRIES = 300_000
#: Node-ancestor combinations worked on at once.
COMBINATIONS = 1 << 19
#: Parts among which a language's counts of counts are dealt to meet its sources.
PARTS = 64

_TERM = re.compile(rb"[a-z\x80-\xff]+")


def counted(docs: DataFrame) -> DataFrame:
    """Counts of tasks, to be added up: ``lang``, ``source``, ``term``, occurrences ``n`` and documents ``docs``
    (the language's, in the row of one of its sources); a null term for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of: dict[tuple[str, str], Counter] = {}
        docs_of: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (group := terms_of.get((lang, source))) is None:
                    group = terms_of[lang, source] = Counter()
                    docs_of.setdefault(lang, Counter())
                terms = _TERM.findall(text.encode().lower())
                held -= len(group)
                group.update(terms)
                docs_of[lang].update(set(terms))
                held += len(group)
                if held > ENTRIES:
                    yield from flushed(terms_of, docs_of)
                    terms_of, docs_of, held = {}, {}, 0
        yield from flushed(terms_of, docs_of)

    def flushed(terms_of: dict[tuple[str, str], Counter], docs_of: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, source), group in terms_of.items():
            size = len(group) + 1
            # Documents are told once, by the first source that has the term.
            told = docs_of[lang]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array([None, *group], pa.binary()).cast(pa.string()),
                    pa.array([0, *group.values()], pa.int64()),
                    pa.array([0, *(told.pop(t, 0) for t in group)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    rows = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE (count + 1) / (total + kept))``; null without a kept term."""
    return F.lit(1) + F.call_function(
        "div", F.lit(SCALE).cast("decimal(12,0)") * (count + 1).cast("decimal(20,0)"), F.nullif((total + kept).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    )


def apart(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``: both are below 2 to the 30, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Tree:
    """A frequent-pattern tree of one language's rows: a node is a source with a share, below those before it."""

    def __init__(self) -> None:
        self._children: dict[tuple[int, int, int], int] = {}
        self._parent: list[int] = []
        self._entry: list[tuple[int, int, int]] = []
        self._times: list[int] = []

    def insert(self, row: list[tuple[int, int, int]], times: int) -> None:
        """``times`` terms whose entries (source, share, share of zero) are ``row``."""
        at = -1
        for entry in row:
            key = (at, entry[0], entry[1])
            if (node := self._children.get(key)) is None:
                node = self._children[key] = len(self._parent)
                self._parent.append(at)
                self._entry.append(entry)
                self._times.append(0)
            self._times[node] += times
            at = node

    def corrections(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Sources ``s``, ``t`` and the sum over their terms, in two halves, of what both counts together add to ``f``."""
        if not self._parent:
            return
        parent, times = np.array(self._parent), np.array(self._times, np.int64)
        source, p, z = np.array(self._entry, np.int64).T
        width = int(source.max()) + 1
        for at in range(0, len(parent), COMBINATIONS):
            node = np.arange(at, min(at + COMBINATIONS, len(parent)))
            above = parent[node]
            while True:
                node, above = node[above >= 0], above[above >= 0]
                if not len(node):
                    break
                for a, b in ((node, above), (above, node)):
                    value = _apart(p[a], p[b]) - _apart(p[a], z[b]) - _apart(z[a], p[b]) + _apart(z[a], z[b])
                    pair, place = np.unique(source[a] * width + source[b], return_inverse=True)
                    order = np.argsort(place, kind="stable")
                    first = np.searchsorted(place[order], np.arange(len(pair)))
                    high = np.add.reduceat(((value >> 32) * times[node])[order], first)
                    low = np.add.reduceat(((value & 0xFFFFFFFF) * times[node])[order], first)
                    yield pair // width, pair % width, high, low
                above = parent[above]


def _interactions(rows: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and the sum ``value`` over terms that both have, from distinct ``rows`` with ``times``."""

    def sums(lang: str, tree: Tree, names: list[str]) -> pa.RecordBatch:
        total: dict[tuple[int, int], tuple[int, int]] = {}
        for s, t, high, low in tree.corrections():
            for key, h, w in zip(zip(s.tolist(), t.tolist(), strict=True), high.tolist(), low.tolist(), strict=True):
                one, two = total.get(key, (0, 0))
                total[key] = (one + h, two + w)
        arrays = [
            pa.array([lang] * len(total), pa.string()),
            pa.array([names[s] for s, _ in total], pa.string()),
            pa.array([names[t] for _, t in total], pa.string()),
            pa.array([h for h, _ in total.values()], pa.int64()),
            pa.array([w for _, w in total.values()], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "item", "high", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, tree, held = None, Tree(), 0
        number: dict[str, int] = {}
        for batch in batches:
            entries = batch.column("row")
            flat = entries.flatten()
            names, p, z = (flat.field(k).to_pylist() for k in ("source", "p", "z"))
            edges = entries.offsets.to_numpy() - entries.offsets[0].as_py()
            for i, (own, times) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("times").to_pylist(), strict=True)):
                if held and (own != lang or held > ENTRIES):
                    yield sums(lang, tree, list(number))
                    tree, held, number = Tree(), 0, {}
                lang = own
                a, b = int(edges[i]), int(edges[i + 1])
                tree.insert([(number.setdefault(names[k], len(number)), p[k], z[k]) for k in range(a, b)], times)
                held += b - a
        if held:
            yield sums(lang, tree, list(number))

    found = (
        rows.repartitionByRange("lang", "row")
        .sortWithinPartitions("lang", "row")
        .mapInArrow(run, "lang string, source string, item string, high long, low long")
    )
    wide = "decimal(38,0)"
    return found.select(
        "lang", "source", "item", (F.col("high").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(12,0)") + F.col("low")).cast(wide).alias("value")
    )


def audited(docs: DataFrame, least: int = LEAST, terms: int = TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of all pairs, and of each source's ``terms`` first terms."""
    # One shuffle, by term: a source's counts and a term's row are added up where it brings them. Tasks have
    # combined their rows already, so what a common term has is a row for each task and source.
    by_source = counted(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    known = written(
        by_source.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("row"))
        .where((F.col("docs") >= least) | F.col("term").isNull())
        .drop("docs"),
        "divergence-terms",
    )
    kept = known.where("term IS NOT NULL")
    # A row for each language, and for each group: small tables, joined by AQE as their size asks.
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    of_group = kept.select("lang", F.inline("row")).groupBy("lang", "source").agg(F.sum("n").alias("own"))
    zero = F.lit(0).cast("long")
    groups = written(
        known.where("term IS NULL").select("lang", F.inline("row")).select("lang", "source")
        .join(of_group, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select(
            "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("own", "kept", "lang_total")),
            share(zero, F.coalesce("own", zero), F.coalesce("kept", zero)).alias("z"),
        ),
        "divergence-groups",
    )
    entries = written(
        kept.select("lang", "term", "total", F.inline("row"))
        .join(groups, ["lang", "source"])
        .select(
            "lang", "source", "term", "z",
            share(F.col("n"), F.col("own"), F.col("kept")).alias("p"),
            share(F.col("total"), F.col("lang_total"), F.col("kept")).alias("q"),
        ),
        "divergence-entries",
    )
    return _pairs(entries, groups).unionByName(_terms(entries, terms))


def _ranked(rows: DataFrame, part: str, most: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")


def _terms(entries: DataFrame, most: int) -> DataFrame:
    over = entries.where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    return _ranked(over, "term", most)


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    wide, zero = "decimal(38,0)", F.lit(0).cast("long")
    # Counts of shares, with all that are zero beside them, meet the other sources of their language. The
    # language is dealt to parts, so that no task has all of it.
    of_share = entries.groupBy("lang", "source", "z", "p").agg(F.count("*").alias("times"))
    base = groups.select("lang", "source", "z", F.col("z").alias("p"), F.col("kept").alias("times")).withColumn("all", F.lit(True))
    left = of_share.withColumn("all", F.lit(False)).unionByName(base).withColumn("deal", F.pmod(F.xxhash64("source", "p", "all"), F.lit(PARTS)))
    others = groups.select(
        "lang", F.col("source").alias("item"), F.col("z").alias("y"), F.explode(F.sequence(zero, F.lit(PARTS - 1).cast("long"))).alias("deal")
    )
    met = left.join(others, ["lang", "deal"]).where("source <> item")
    p, z, y = F.col("p"), F.col("z"), F.col("y")
    none = F.when(F.col("all"), zero)
    times = F.col("times").cast("decimal(19,0)")
    forth = F.coalesce(none, apart(p, y) - apart(z, y)).cast("decimal(19,0)") * times
    back = F.coalesce(none, apart(y, p) - apart(y, z)).cast("decimal(19,0)") * times
    whole = F.when(F.col("all"), F.coalesce(apart(z, y), zero).cast("decimal(19,0)") * times).otherwise(F.lit(0))
    summed = met.groupBy("lang", "source", "item").agg(F.sum((forth + whole).cast(wide)).alias("forth"), F.sum(back.cast(wide)).alias("back"))
    single = summed.select(
        "lang",
        F.inline(
            F.array(
                F.struct(F.col("source"), F.col("item"), F.col("forth").alias("value")),
                F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")),
            )
        ),
    )
    # Rows without a second entry have no pair.
    rows = (
        entries.groupBy("lang", "term")
        .agg(F.sort_array(F.collect_list(F.struct("source", "p", "z"))).alias("row"))
        .where(F.size("row") > 1)
        .groupBy("lang", "row")
        .agg(F.count("*").alias("times"))
    )
    both = _interactions(rows)
    total = single.unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(total, "pair", None)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (
    SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM d
),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        CAST(1 + 1000000000 * (coalesce(c.n, 0) + 1) // (coalesce(s.n, 0) + l.v) AS BIGINT) AS p,
        CAST(1 + 1000000000 * (k.total + 1) // (l.n + l.v) AS BIGINT) AS q
    FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
every AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
parts AS (
    SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM every LEFT JOIN pairs USING (lang, source, item)
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (
    SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 200
"""
