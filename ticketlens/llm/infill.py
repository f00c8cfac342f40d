"""Fill-in-middle transformation: texts cut at two ranks, found in an indexable skip list.

A text's units are its words, each with the white space before it; white
space at the end is a unit of its own. Two ranks from 0 to ``n``, drawn from a
digest of the document's id, part the units into prefix, middle and suffix.

The cuts are found by rank. Every unit is a node of the lowest lane; a node
rises to the next lane by a digest of its place, one in ``RISE``, and a
text's head is in all lanes. A lane's link carries two widths: the units and
the code points that it passes over. A search starts at the head of the highest
lane, follows links while the units passed stay within the rank, and goes down a
lane where the next link would pass it; on the lowest lane it ends at the
rank itself, and the code points added up on the way are the place of the cut.
The lists of many texts are built side by side, one array for each lane, and all
searches of a batch go down together; a text longer than ``TOGETHER`` bytes
has a batch of its own.

Forms: ``plain`` is the text itself; ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>``
middle; ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. A text that holds a
mark stays plain, so the marks of an output are its own: no piece ends in a way that makes a mark
with what follows, as a mark has ``<`` at its start only. ``restored`` therefore takes
the first marks that it finds.

Defined cases: a null text counts as empty; an empty text is plain, with no
unit; a text of white space alone is one unit; a null id is digested as the empty
string, so such rows are cut alike; equal ids are cut by equal digests, repeated rows give
equal rows; equal ranks give an empty middle; an empty table gives an empty
result. Extra columns are kept by ``transformed`` unless they have the name of
a result, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import mixed, slices, text_or_empty, utf8_parts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of a hundred documents, those that are transformed, and of those the ones with the suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
#: One node in so many rises a lane.
RISE = 4
#: Bytes of the texts whose lists are built at once.
TOGETHER = 1 << 21

ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass
class Lane:
    """Nodes of a lane, text after text, each text's head first.

    ``units`` and ``points`` are the widths of the link from a node to the next;
    ``down`` is the node's place in the lane below.
    """

    units: np.ndarray
    points: np.ndarray
    down: np.ndarray


@dataclass
class SkipLists:
    """The lists of several texts: ``heads`` in the highest lane, ``n`` units of each text."""

    lanes: list[Lane]
    heads: np.ndarray
    n: np.ndarray

    def cut(self, ranks: np.ndarray) -> np.ndarray:
        """Code points before the given rank of each text."""
        at = self.heads.copy()
        units, points = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for lane in reversed(self.lanes):
            going = np.arange(len(at))
            while len(going):
                # The last link of a text leads to its end: rank n may take it, a smaller one can't.
                step = units[going] + lane.units[at[going]]
                going = going[(step <= ranks[going]) & (lane.units[at[going]] > 0)]
                units[going] += lane.units[at[going]]
                points[going] += lane.points[at[going]]
                at[going] += 1
            at = lane.down[at]
        return points


def unit_ends(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the units of several texts as byte places, and the number of units of each text."""
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    # A unit ends with the last byte of a word, or of the text.
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    ends = np.flatnonzero(last) + 1
    return ends, np.diff(np.searchsorted(ends, offsets, side="right"))


def skip_lists(raw: np.ndarray, offsets: np.ndarray) -> SkipLists:
    """The skip lists of several texts, given as bytes in a row and the starts of the texts."""
    ends, n = unit_ends(raw, offsets)
    texts = len(n)
    starts_point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    # The lowest lane: each text's units, then its end, a node without a link.
    first = np.cumsum(n + 1) - (n + 1)
    of = np.repeat(np.arange(texts), n + 1)
    place = np.arange(len(of)) - first[of]
    at_byte = np.empty(len(of), np.int64)
    at_byte[first] = offsets[:-1]
    at_byte[place > 0] = ends
    position = starts_point[at_byte]
    link = place < n[of]
    rank = place
    digest = mixed(place.astype(np.uint64) + np.uint64(1))
    lanes: list[Lane] = []
    below = np.arange(len(of))
    while True:
        units, points = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        units[:-1] = np.where(link[:-1], rank[1:] - rank[:-1], 0)
        points[:-1] = np.where(link[:-1], position[1:] - position[:-1], 0)
        lanes.append(Lane(units, points, below))
        rises = digest % np.uint64(RISE) == 0
        if not (rises & link & (rank > 0)).any():
            break
        # The head and the end of a text are in every lane.
        keep = np.flatnonzero(rises | (rank == 0) | ~link)
        rank, position, link, digest, below = rank[keep], position[keep], link[keep], digest[keep] // np.uint64(RISE), keep
    return SkipLists(lanes, np.flatnonzero(rank == 0), n)


def forms(text: Column, h3: Column, h4: Column, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> Column:
    """``plain``, ``spm`` or ``psm``."""
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    return (
        F.when((text == "") | marked | (h3 % 100 >= fim_percent), F.lit("plain"))
        .when(h4 % 100 < spm_percent, F.lit("spm"))
        .otherwise(F.lit("psm"))
    )


def transformed(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with ``n`` units, ``form``, ``prefix_chars`` and ``middle_chars`` (null if plain) and the ``output``.

    ``keep`` names the columns of ``docs`` that are kept, all by default.
    """
    names = [c for c in docs.columns if c not in ADDED and (keep is None or c in keep)]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    text = text_or_empty("text")
    rows = docs.select(
        F.struct(*names).alias("row"), text.alias("text"), h[0].alias("h1"), h[1].alias("h2"), forms(text, h[2], h[3], fim_percent, spm_percent).alias("form")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_parts(batch.column("text"))
            at = 0
            for part, starts in slices(raw, offsets, TOGETHER):
                now = batch.slice(at, len(starts) - 1)
                at += len(now)
                lists = skip_lists(part, starts)
                h1, h2 = (now.column(c).to_numpy() % (lists.n + 1) for c in ("h1", "h2"))
                low, high = lists.cut(np.minimum(h1, h2)), lists.cut(np.maximum(h1, h2))
                form = now.column("form").to_pylist()
                outputs = []
                for text, f, a, b in zip(now.column("text").to_pylist(), form, low.tolist(), high.tolist(), strict=True):
                    if f == "psm":
                        outputs.append("".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b])))
                    elif f == "spm":
                        outputs.append("".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b])))
                    else:
                        outputs.append(text)
                plain = np.array([f == "plain" for f in form], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        now.column("row"),
                        pa.array(lists.n, pa.int64()),
                        now.column("form"),
                        pa.array(low, pa.int64(), mask=plain),
                        pa.array(high - low, pa.int64(), mask=plain),
                        pa.array(outputs, pa.string()),
                    ],
                    ["row", *ADDED],
                )

    schema = T.StructType([T.StructField("row", T.StructType([f for f in docs.schema if f.name in names]))])
    for name, kind in zip(ADDED, (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()), strict=True):
        schema.add(name, kind)
    return rows.mapInArrow(run, schema).select(*(F.col("row")[c].alias(c) for c in names), *ADDED)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""

    def piece(after: str, before: str) -> Column:
        begin = F.instr(output, after) + len(after)
        return F.substring(output, begin, F.instr(output, before) - begin)

    middle = F.substring(output, F.instr(output, MIDDLE) + len(MIDDLE), F.length(output))
    return (
        F.when(form == "psm", F.concat(piece(PREFIX, SUFFIX), middle, piece(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(piece(PREFIX, MIDDLE), middle, piece(SUFFIX, PREFIX)))
        .otherwise(output)
    )


def digests(docs: DataFrame) -> DataFrame:
    """Every document's cut: counts, form, and digests of the output and of the text rebuilt from it."""
    rows = transformed(docs, keep=["doc_id"])
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
),
d AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM t
),
c AS (
    SELECT doc_id, text, n,
        array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
        array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
        array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
            WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM d
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM c
"""
