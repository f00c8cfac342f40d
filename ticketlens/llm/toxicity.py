"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

The kernel compares two strings by the subsequences of three characters that
they share; each occurrence counts ``DECAY`` to the number of characters that
it spans, and a step may skip up to ``REACH - 1`` characters. Characters put
into a word therefore weaken a match and don't end it. Strings are words in lower case with a
mark before the first letter and one after the last; signs and digits inside a word take a place but
match nothing; letters that stand alone one after another are read as one word.

Training: labelled documents of the training folds, a bounded sample of
``SAMPLE`` rows, near copies left out. Two kinds of strings are labelled. Passages of ``PASSAGE`` words
(sentences, as texts don't always mark their ends) have the label of their document, but for those of toxic documents
without any suspect word, which say nothing; the kernel of two passages is the sum of their words' kernels over the root of their
lengths. Suspect words are those found in toxic documents beyond chance; they are positive strings, too,
and words of clean documents negative ones, and some of both the landmarks. One linear SVM
(squared hinge) on the Nyström features, with a bias for words and one for passages, is trained on
both, again and again with the clean words and clean passages that it rates highest. A logistic curve over the highest margins of a
document's words and passages, fitted on the sample, makes the score.

Scoring: as the kernel has explicit features, landmarks and weights fold into
one weight for each triple of characters, so a word's margin is a sum over its own
triples, and a passage's is a sum over its words. A worker remembers the margins of words; a document's score depends
on nothing but its text: the three highest margins among its words (each
occurrence counts, so an insult that comes again weighs more than one
likeness), and the highest among its passages.

Defined cases: a null or empty text has no words and gets the score of
the lowest margins; without labels of both kinds every score is 0; labels that are
null count as absent, repeated labels as the larger; repeated rows get equal
scores; an empty table gives an empty result. Extra columns are not read by
``scores`` and are kept by ``filtered``.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import mixed, text_or_empty, written

DECAY = 0.7
REACH = 3
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 16_000
#: Landmarks, positive and negative strings of a fit, at most.
LANDMARKS = 192
POSITIVES, NEGATIVES = 2_000, 9_000
ROUNDS = 3
#: Words of a passage and of the step to the next one; passages of a fit at most, of toxic and of clean documents.
PASSAGE, PASSAGE_STEP = 12, 6
PASSAGES, CLEAN_PASSAGES = 1_500, 4_500
#: Share of the passages in the weight of all training strings.
PASSAGE_SHARE = 0.1
#: Words whose Nyström features are worked out at once.
MAPPED_AT_ONCE = 100
#: A word is positive if toxic documents have it so many deviations beyond chance.
BEYOND_CHANCE = 5.5
COST = 4.0
#: Texts whose unknown words are worked on at once.
TOGETHER = 500
#: A spaced-out word has so many different letters at least, each alone.
SINGLES = 3
SPACED, SPACED_STEP = 8, 2
#: Words of which a worker remembers margins, and pieces of words whose triples it works out at once.
REMEMBERED, PIECES_AT_ONCE = 300_000, 10_000
THRESHOLD = 0.3
LEAST = -3.0
#: How a margin counts as evidence: the middle and the steepness of its logistic curve.
MIDDLE, STEEP = 0.35, 6.0
#: Characters of a word that the kernel sees at once; longer ones go in overlapping pieces.
PIECE, STEP = 24, 12

#: Classes: none, the marks, a to z, and other letters in shares by code point.
_START, _END = 1, 2
_CLASSES = 37
_CODE = np.zeros(0x250, np.int32)
for _c in range(0x250):
    if chr(_c).isalpha():
        _CODE[_c] = _c - 94 if 97 <= _c <= 122 else 29 + _c % 8
_SINGLE = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[^\w\n]+[^\W\d_](?![^\W\d_])){2,}")


def words_of(text: str, tokens: list[str] | None = None) -> set[str]:
    """The distinct words of a text in lower case, and its runs of single letters as words."""
    words = set(text.split() if tokens is None else tokens)
    if sum(len(w) == 1 for w in words) >= SINGLES:
        for run in _SINGLE.findall(text):
            word = "".join(c for c in run if c.isalpha())
            # A long run may be several words: it is read in parts, too.
            words.add(word)
            words.update(word[i : i + SPACED] for i in range(0, len(word) - SPACED + 1, SPACED_STEP))
    return words


#: Signs around a word, which are no part of it.
_AROUND = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"


def _pieces(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words cut to pieces of bounded length, and the word of each piece."""
    out, of = [], []
    for i, w in enumerate(words):
        w = w.strip(_AROUND)
        if len(w) <= PIECE:
            out.append(w)
            of.append(i)
        else:
            for at in range(0, len(w) - STEP, STEP):
                out.append(w[at : at + PIECE])
                of.append(i)
    return out, np.array(of, np.int64)


def _triples(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the triples of each piece, -1 for none, with their weights.

    All pieces in one call have the width of the longest.
    """
    longest = max(map(len, pieces))
    width = longest + 2
    flat = np.frombuffer("".join(p.ljust(longest, "\0") for p in pieces).encode("utf-32-le"), np.uint32)
    classes = np.where(flat < 0x250, _CODE[np.minimum(flat, 0x24F)], 29 + (flat % 8).astype(np.int32))
    grid = np.zeros((len(pieces), width + 2 * REACH), np.int32)
    grid[:, 0] = _START
    grid[:, 1 : width - 1] = classes.reshape(len(pieces), longest)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    grid[np.arange(len(pieces)), sizes + 1] = _END
    codes, weights = [], []
    for a in range(1, REACH + 1):
        for b in range(1, REACH + 1):
            n = width - a - b
            if n <= 0:
                continue
            x, y, z = grid[:, :n], grid[:, a : a + n], grid[:, a + b : a + b + n]
            codes.append(np.where((x > 0) & (y > 0) & (z > 0), (x * _CLASSES + y) * _CLASSES + z, -1))
            weights.append(np.full(n, DECAY ** (a + b + 1), np.float32))
    if not codes:
        return np.full((len(pieces), 1), -1, np.int32), np.zeros(1, np.float32)
    return np.concatenate(codes, axis=1), np.concatenate(weights)


def _features(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse feature vectors of length one: row, code and value of each entry."""
    codes, weights = _triples(pieces)
    row, col = np.nonzero(codes >= 0)
    key = row * np.int64(_CLASSES**3) + codes[row, col]
    order = np.argsort(key, kind="stable")
    key, value = key[order], weights[col][order].astype(np.float64)
    if not len(key):
        return key, key, value
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    value = np.add.reduceat(value, first)
    row, code = key[first] // _CLASSES**3, key[first] % _CLASSES**3
    norm = np.sqrt(np.bincount(row, value**2, len(pieces)))
    return row, code, value / norm[row]


def _by_length(pieces: list[str]) -> Iterator[np.ndarray]:
    """Indexes of pieces of like length, so that short ones stay narrow."""
    sizes = np.array([len(p) for p in pieces])
    for low, high in ((0, 6), (6, 9), (9, 13), (13, PIECE)):
        at = np.flatnonzero((sizes > low) & (sizes <= high) if low else sizes <= high)
        for i in range(0, len(at), PIECES_AT_ONCE):
            yield at[i : i + PIECES_AT_ONCE]


@dataclass(frozen=True)
class _Marks:
    """Landmarks as dense vectors over the triples that they have: ``column`` numbers these, -1 for all others."""

    column: np.ndarray
    vectors: np.ndarray


def _marks_of(words: list[str]) -> _Marks:
    """Feature vectors of a few words, one row each; words without a triple have none."""
    row, code, value = _features([w.strip(_AROUND) for w in words])
    used, at = np.unique(code, return_inverse=True)
    column = np.full(_CLASSES**3, -1, np.int32)
    column[used] = np.arange(len(used))
    out = np.zeros((len(words), len(used)), np.float32)
    out[row, at] = value
    return _Marks(column, out[np.abs(out).sum(1) > 0])


def _mapped(words: list[str], marks: _Marks, table: np.ndarray) -> np.ndarray:
    """Feature vectors times a table of a row per triple of the landmarks, without making them dense.

    Other triples have no part in the product, only in a vector's length.
    """
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for i in range(0, len(words), MAPPED_AT_ONCE):
        row, code, value = _features([w.strip(_AROUND) for w in words[i : i + MAPPED_AT_ONCE]])
        at = marks.column[code]
        row, at, value = row[at >= 0], at[at >= 0], value[at >= 0].astype(np.float32)
        if len(row):
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            out[i + row[first]] = np.add.reduceat(table[at] * value[:, None], first)
    return out


def passages_of(n: int) -> list[tuple[int, int]]:
    """Where the passages of ``n`` words begin and end: all words are in one, the last ends with the text."""
    if n <= PASSAGE:
        return [(0, n)] if n else []
    return [(a, a + PASSAGE) for a in range(0, n - PASSAGE, PASSAGE_STEP)] + [(n - PASSAGE, n)]


def _mapped_passages(passages: list[list[str]], marks: _Marks, table: np.ndarray) -> np.ndarray:
    """Nyström features of passages: the sum of their words' over the root of their number."""
    out = np.zeros((len(passages), table.shape[1]), np.float32)
    for i in range(0, len(passages), 50):
        some = passages[i : i + 50]
        sizes = np.array([len(p) for p in some])
        x = _mapped([w for p in some for w in p], marks, table)
        first = np.cumsum(sizes) - sizes
        out[i : i + len(some)] = np.add.reduceat(x, first) / np.sqrt(sizes)[:, None]
    return out


def _squashed(margin: float) -> float:
    """Evidence of a margin, from 0 to 1."""
    return 1 / (1 + math.exp(-STEEP * (margin - MIDDLE)))


@dataclass
class Model:
    """Triple weights, the biases, and the curve from margins to scores."""

    weights: np.ndarray | None = None
    bias: float = LEAST
    passage_bias: float = LEAST
    curve: np.ndarray | None = None
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def margins(self, words: list[str]) -> np.ndarray:
        """The margin of each word; of a long one the highest of its pieces."""
        out = np.full(len(words), LEAST)
        if self.weights is None or not words:
            return out
        pieces, of = _pieces(words)
        for at in _by_length(pieces):
            if len(at):
                row, code, value = _features([pieces[i] for i in at])
                got = np.bincount(row, self.weights[code] * value, len(at)) + self.bias
                np.maximum.at(out, of[at], got)
        return out

    def passage_margins(self, words: list[str]) -> np.ndarray:
        """The margin of each passage of a text's words, whose own margins are known; of no words the bias."""
        n = len(words)
        sums = np.zeros(n + 1)
        np.cumsum(np.fromiter(map(self.known.__getitem__, words), float, n), out=sums[1:])
        if n <= PASSAGE:
            return np.array([(sums[n] - n * self.bias) / math.sqrt(max(1, n)) + self.passage_bias])
        # Where passages_of begins them.
        begin = np.append(np.arange(0, n - PASSAGE, PASSAGE_STEP), n - PASSAGE)
        return (sums[begin + PASSAGE] - sums[begin] - PASSAGE * self.bias) / math.sqrt(PASSAGE) + self.passage_bias

    def learn(self, words: Iterable[str]) -> None:
        """Remember the margins of words."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set(words).difference(self.known))
        self.known.update(zip(new, self.margins(new).tolist(), strict=True))

    def evidence(self, texts: list[str | None]) -> list[tuple[float, float]]:
        """For each text the three highest margins among its words, each occurrence counted, as a sum of 0 to 3, and
        the highest among its passages, from 0 to 1.

        Margins of words not yet known are worked out for ``TOGETHER`` texts at once.
        """
        out = []
        for at in range(0, len(texts), TOGETHER):
            some = [(t or "").lower() for t in texts[at : at + TOGETHER]]
            tokens = [t.split() for t in some]
            words = [words_of(t, x) for t, x in zip(some, tokens, strict=True)]
            self.learn(set().union(*words))
            for text, all_of, own in zip(some, tokens, words, strict=True):
                best = heapq.nlargest(3, zip(map(self.known.__getitem__, own), own, strict=True))
                top = [m for m, w in best for _ in range(max(1, min(3, text.count(w))) if m > 0 else 1)]
                passage = float(self.passage_margins(all_of).max())
                out.append((sum(map(_squashed, top[:3])), _squashed(max(LEAST, min(-LEAST, passage)))))
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(evidence))
        x = np.asarray(evidence, float).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ self.curve, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, free: int) -> np.ndarray:
    """Primal Newton steps for a linear SVM; the last ``free`` columns are biases."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-free:] = 1e-3
    for turn in range(30):
        inside = y * (x @ w) < 1
        z, c = x[inside], COST * weight[inside]
        new = np.linalg.solve(np.diag(ridge) + z.T @ (z * c[:, None]), z.T @ (c * y[inside]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = 0.5 * (w + new) if turn > 10 else new
    return w


def _halves(y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weights of both labels alike, one in all."""
    out = share.astype(float)
    for side in (y > 0, y < 0):
        out[side] *= 0.5 / max(out[side].sum(), 1e-12)
    return out


def _fit(positive: list[tuple[str, float]], negative: list[tuple[str, float]], passages: list[tuple[list[str], int]] = ()) -> Model:
    """An SVM on Nyström features of words and passages, folded into weights of triples."""
    half = LANDMARKS * 2 // 3
    chosen = [w for w, _ in positive[:half]]
    chosen += [w for w, _ in negative[: LANDMARKS - len(chosen)]]
    marks = _marks_of(chosen)
    values, vectors = np.linalg.eigh((marks.vectors @ marks.vectors.T).astype(float))
    good = values > 1e-5 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # landmarks' kernel matrix to the power -1/2
    map_of = marks.vectors.T @ root.astype(np.float32)
    n, m = len(positive) + len(negative), len(passages)
    x = np.zeros((n + m, map_of.shape[1] + 2), np.float32)
    x[:n, :-2] = _mapped([w for w, _ in positive] + [w for w, _ in negative], marks, map_of)
    x[n:, :-2] = _mapped_passages([p for p, _ in passages], marks, map_of)
    x[:n, -2], x[n:, -1] = 1, 1
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative)), [label * 2 - 1 for _, label in passages]]
    share = _halves(y[:n], np.sqrt([n for _, n in (*positive, *negative)]))
    if m:
        share = np.r_[(1 - PASSAGE_SHARE) * share, PASSAGE_SHARE * _halves(y[n:], np.ones(m))]
    w = _squared_hinge(x, y, share * n, 2)
    weights = np.zeros(_CLASSES**3)
    weights[marks.column >= 0] = map_of @ w[:-2]
    return Model(weights=weights, bias=float(w[-2]), passage_bias=float(w[-1]) if m else LEAST)


def _passages(picked: DataFrame, suspect: set[str], model: Model | None) -> list[tuple[list[str], int]]:
    """Labelled passages of the sample: of toxic documents those with a suspect word, of clean ones the
    first that a model rates highest, or any without one. A bounded number comes to the driver."""
    shared = picked.sparkSession.sparkContext.broadcast((suspect, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspect, model = shared.value
        for batch in batches:
            words, labels, margins = [], [], []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                own = text.lower().split()
                spans = passages_of(len(own))
                if not spans:
                    continue
                if toxic:
                    bad = [not suspect.isdisjoint(_pieces(own[a:b])[0]) for a, b in spans]
                    some = [(span, 0.0) for span, b in zip(spans, bad, strict=True) if b]
                elif model is None:
                    some = [(spans[xxhash.xxh3_64_intdigest(text) % len(spans)], 0.0)]
                else:
                    model.learn(own)
                    m = model.passage_margins(own)
                    some = [(spans[int(m.argmax())], float(m.max()))]
                for (a, b), margin in some:
                    words.append(own[a:b])
                    labels.append(toxic)
                    margins.append(margin)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.string())), pa.array(labels, pa.int32()), pa.array(margins, pa.float64())], ["words", "toxic", "margin"]
            )
        if model is not None:
            model.known = {}  # a round's model is not asked again

    found = written(picked.mapInArrow(run, "words array<string>, toxic int, margin double"), "toxicity-passages").distinct()
    shared.destroy()
    out = []
    for toxic, most in ((1, PASSAGES), (0, CLEAN_PASSAGES // (ROUNDS + 1))):
        rows = found.where(F.col("toxic") == toxic).orderBy(F.desc("margin"), F.xxhash64("words")).limit(most).collect()
        out += [(r["words"], toxic) for r in rows]
    return out


def _curve(evidence: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic curve by Newton steps with smoothed labels."""
    n1, n0 = label.sum(), (1 - label).sum()
    t = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.c_[evidence, np.ones(len(evidence))]
    w = np.zeros(x.shape[1])
    w[-1] = math.log((n1 + 1) / (n0 + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - t) + 1e-2 * w
        h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """Text and label of at most about ``rows`` labelled rows of the training folds.

    The rows with the smallest digests of their ids: ids and labels alone are
    gathered, then met with the texts.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("_id"))
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), text_or_empty("text").alias("text"))
    return texts.join(F.broadcast(known), "_id").select("_id", "text", "toxic")


def _marks(text: str) -> list[int]:
    """Eight minwise hashes of a text's runs of three words."""
    words = text.lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(hashes) > 2:
        hashes = mixed(mixed(mixed(hashes[:-2]) + hashes[1:-1]) + hashes[2:])
    return [int(mixed(hashes ^ np.uint64(k + 1)).min() >> np.uint64(1)) for k in range(8)] if len(hashes) else [0] * 8


def _without_copies(picked: DataFrame) -> DataFrame:
    """The sample without near copies: words that copies share would pass for common ones.

    A document that has two minwise hashes of an earlier one goes. Ids and
    hashes of the sample, so a bounded number, are compared on the driver.
    """

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [_marks(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(marks, pa.list_(pa.int64()))], ["_id", "marks"])

    first: dict[tuple[int, int], int] = {}
    kept = []
    for row in sorted(picked.mapInArrow(marked, "_id long, marks array<long>").collect()):
        seen = Counter(first[x] for x in enumerate(row["marks"]) if x in first)
        if not seen or seen.most_common(1)[0][1] < 2:
            kept.append(row["_id"])
            for x in enumerate(row["marks"]):
                first.setdefault(x, row["_id"])
    ids = picked.sparkSession.createDataFrame([(i,) for i in kept], "_id long")
    return picked.join(F.broadcast(ids), "_id", "left_semi")


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """A model fitted on a bounded sample of the labelled rows."""
    picked = written(sample(docs, labels, rows), "toxicity-sample")
    picked = _without_copies(picked).select("text", "toxic")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted(set(_pieces(sorted(words_of(t.lower())))[0])) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string())), batch.column("toxic")], ["words", "toxic"])

    both = picked.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    if not both["toxic"] or both["toxic"] == both["n"]:
        return Model()
    rate = both["toxic"] / both["n"]
    counted = written(
        picked.mapInArrow(words, "words array<string>, toxic int")
        .select(F.explode("words").alias("word"), "toxic")
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")),
        "toxicity-words",
    )
    beyond = (F.col("bad") - rate * F.col("n")) / F.sqrt(rate * (1 - rate) * F.col("n"))
    positive = [
        (r["word"], float(r["n"]))
        for r in counted.where((beyond >= BEYOND_CHANCE) & (F.col("bad") >= 0.8 * F.col("n")))
        .orderBy(beyond.desc(), "word").limit(POSITIVES).collect()
    ]
    chosen = counted.sparkSession.createDataFrame([(w,) for w, _ in positive], "word string")
    clean = counted.where("bad < n").select("word", (F.col("n") - F.col("bad")).alias("n"))
    clean = clean.join(F.broadcast(chosen), "word", "left_anti")  # POSITIVES rows at most
    negative = [
        (r["word"], float(r["n"]))
        for r in clean.orderBy(F.when(F.col("n") > 20, -F.col("n")).otherwise(0), F.xxhash64("word")).limit(NEGATIVES // 2).collect()
    ]
    if not positive or not negative:
        return Model()
    suspect = {w for w, _ in positive}
    passages = _passages(picked, suspect, None)
    model = _fit(positive, negative, passages)
    taken = {w for w, _ in negative}
    for _ in range(ROUNDS):

        def rated(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = model.margins(batch.column("word").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(got)], ["word", "n", "margin"])

        hard = (
            clean.mapInArrow(rated, "word string, n long, margin double")
            .where("margin > -0.7").orderBy(F.desc("margin"), "word").limit(NEGATIVES // (2 * ROUNDS)).collect()
        )
        new = [(r["word"], float(r["n"])) for r in hard if r["word"] not in taken]
        seen = {tuple(p) for p, _ in passages}
        more = [(p, toxic) for p, toxic in _passages(picked, suspect, model) if not toxic and tuple(p) not in seen]
        if not new and not more:
            break
        taken.update(w for w, _ in new)
        negative = [*new, *negative]
        passages += more
        model = _fit(positive, negative, passages)

    def rate_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = model.evidence(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.float64())), batch.column("toxic")], ["evidence", "toxic"])
        model.known = {}

    seen = picked.mapInArrow(rate_documents, "evidence array<double>, toxic int").collect()
    model.curve = _curve(np.array([r["evidence"] for r in seen]), np.array([r["toxic"] for r in seen], float))
    return model


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(np.array(shared.value.evidence(batch.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def filtered(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(np.array(shared.value.evidence(batch.column("text").to_pylist())))
            yield batch.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
