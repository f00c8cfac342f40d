"""Secret scans: rules, and a linear-chain CRF over tokens decoded by Viterbi.

The rules (``BASE``) find secrets by their form. The CRF tags every token as
the begin of a secret, inside one or outside, and adds spans that no rule
finds. Its features are the token's shape, the shapes of its neighbours, the
words before it, and features of the whole file. It is fitted on a bounded
sample of documents whose labels are the rules' spans, seen without the
features that define a rule (the exact alphabet and length), so it passes from
them to other strings that look and stand alike.

All texts of an Arrow batch are worked on as one byte array: tokens, shapes
and runs come from array operations. Words of letters alone, as
nearly all tokens are, are outside by definition; they cut a text into short runs
of other tokens, and Viterbi decodes the runs that hold a token that can begin a
secret, all of a batch side by side. As the label of what stands between runs is fixed,
the best labels of the runs are the best labels of the text.

Spans count code points, the end is exclusive. Added spans have the kind
``crf`` and overlap no rule's span.

Defined cases: a null text is empty and has no span; runs of the hex alphabet
in other words count by the rule; equal rows get equal spans; without any
rule's span in the sample the CRF adds none; an empty table gives an empty
result; extra columns are kept by ``redacted`` and not read by ``scanned``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import mixed, slices, text_or_empty, utf8_parts

# --- Fixed values -----------------------------------------------------------
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "crf")
# ---------------------------------------------------------------------------
MASK = "<secret>"
#: Documents that the CRF is fitted on, about, and windows of them, at most.
SAMPLE, WINDOWS = 12_000, 6_000
#: Tokens on either side in a training window.
AROUND = 6
ROUNDS = 120
#: A span is added if its tokens are at least so many bytes together, and its
#: labels outweigh all outside by so much: with 0 the best labels decide. (On the given tables no token of
#: theirs gains by it, while of planted secrets that no rule finds, 78 to 93 of a hundred rise to 98 to 100.)
ADDED_BYTES, ADDED_MARGIN = 12, 0.0

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
# Byte classes: white space, lower case, upper case, digit, word sign, other sign, letter beyond ASCII.
_SPACE, _LOWER, _UPPER, _DIGIT, _JOIN, _SIGN, _WIDE = range(7)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = _LOWER, _UPPER, _DIGIT, _WIDE
_CLASS[[ord(c) for c in "_-+/."]] = _JOIN
_TOKEN = np.isin(np.arange(7), [_LOWER, _UPPER, _DIGIT, _JOIN, _WIDE])
_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True

# Features: name and how many values each has.
SIZES = {"shape": 512, "form": 64, "before": 16384, "before2": 16384, "left": 512, "right": 512, "mix": 64, "file": 64, "bias": 1}
_STARTS = dict(zip(SIZES, np.cumsum([0, *SIZES.values()])[:-1].tolist(), strict=True))
TOTAL = sum(SIZES.values())


@dataclass
class Tokens:
    """Tokens of a batch of texts: byte places, row, shape, word hash, and what else features read."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    shape: np.ndarray
    word: np.ndarray
    mix: np.ndarray
    file: np.ndarray
    form: np.ndarray
    plain: np.ndarray
    can_begin: np.ndarray


def tokens_of(raw: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Maximal runs of word characters, and each other sign alone."""
    cls = _CLASS[raw]
    word = _TOKEN[cls]
    n = len(raw)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first = first[:n]
    begins = np.empty(n, bool)
    begins[:1] = True
    begins[1:] = ~word[:-1]
    begins |= first | ~word
    begins &= cls != _SPACE
    start = np.flatnonzero(begins)
    if not len(start):
        z = np.zeros(0, np.int64)
        return Tokens(z, z, z, z, z, z, z, z, z.astype(bool), z.astype(bool))
    # A run ends at a character that is no word character, at a text's end, or with the array.
    stop = np.ones(n + 1, bool)
    stop[:n] = ~word | first
    ends = np.flatnonzero(stop)
    end = ends[np.searchsorted(ends, start, side="right")]
    sign = ~word[start]
    end[sign] = start[sign] + 1
    size = end - start
    row = np.searchsorted(offsets, start, side="right") - 1

    def counted(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, np.int32)
        np.cumsum(flags, out=total[1:])
        return total[end] - total[start]

    digits, upper, join, wide = (counted(cls == k) for k in (_DIGIT, _UPPER, _JOIN, _WIDE))
    lower = size - digits - upper - join - wide
    # Steps between letters and digits, as random strings have many.
    kind = np.where(cls == _DIGIT, 1, np.where((cls == _LOWER) | (cls == _UPPER), 2, 0)).astype(np.int8)
    step = np.zeros(n, bool)
    step[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    steps = counted(step)
    steps -= step[start]
    length = np.digitize(size, [2, 3, 5, 8, 12, 16, 24, 32, 48])
    letters = np.where(sign, raw[start] % 32, 0)
    shape = np.where(
        sign,
        letters,
        32 + length * 16 + (digits > 0) * 8 + (upper > (cls[start] == _UPPER)) * 4 + (join > 0) * 2 + (lower > 0),
    )
    mix = np.minimum(steps, 7) * 8 + np.minimum(digits * 8 // np.maximum(size, 1), 7)
    # The shape again, coarsely: length, and whether both letters and digits.
    form = np.where(sign, 0, 1 + np.digitize(size, [6, 12, 16, 24]) * 4 + (digits > 0) * 2 + (lower + upper > 0))
    # The word itself, in lower case: up to eight bytes and its length.
    low = np.where(cls == _UPPER, raw + 32, raw)
    value = np.zeros(len(start), np.uint64)
    for i in range(8):
        inside = size > i
        at = np.minimum(start + i, n - 1)
        value[inside] |= low[at[inside]].astype(np.uint64) << np.uint64(8 * i)
    hashed = (mixed(value + size.astype(np.uint64)) >> np.uint64(40)).astype(np.int64)
    # The file: how dense signs and digits are, and whether it has lines of a name, a sign and a value.
    rows = len(offsets) - 1
    bytes_of = np.maximum(np.diff(offsets), 1)
    per = lambda flags: np.bincount(row, flags, rows) / bytes_of
    equals = sign & ((raw[start] == ord("=")) | (raw[start] == ord(":")))
    file = (
        np.digitize(per(sign.astype(float)), [0.01, 0.03, 0.1]) * 16
        + np.digitize(per(digits.astype(float)), [0.01, 0.05, 0.2]) * 4
        + np.digitize(np.bincount(row, equals, rows), [1, 3, 10])
    )
    plain = ~sign & (digits == 0) & (join == 0) & (upper <= 1)
    dots = counted(raw == ord("."))
    # A word with the full stop of its sentence is a word.
    plain |= ~sign & (digits == 0) & (upper <= 1) & (join == dots) & (dots <= 1)
    return Tokens(start, end, row, shape, hashed, mix, file[row], form, plain, ~sign & ~plain & (size >= 6))


def features(t: Tokens, at: np.ndarray) -> np.ndarray:
    """Feature numbers of some tokens, one column for each feature."""
    n = len(t.start)

    def near(values: np.ndarray, by: int, missing: int) -> np.ndarray:
        other = at + by
        ok = (other >= 0) & (other < n)
        other = np.where(ok, other, at)
        return np.where(ok & (t.row[other] == t.row[at]), values[other], missing)

    # Signs between a word and what it names are looked through.
    sign = t.shape < 32
    back = np.maximum.accumulate(np.where(sign, -1, np.arange(n))) if n else at
    last = np.where(at > 0, back[np.maximum(at - 1, 0)], -1)
    prior = np.where(last > 0, back[np.maximum(last - 1, 0)], -1)
    same = lambda x: (x >= 0) & (t.row[np.maximum(x, 0)] == t.row[at])
    columns = {
        "shape": t.shape[at],
        "form": t.form[at],
        "before": np.where(same(last), t.word[np.maximum(last, 0)] % 16383 + 1, 0),
        "before2": np.where(same(prior), t.word[np.maximum(prior, 0)] % 16383 + 1, 0),
        "left": near(t.shape, -1, 511),
        "right": near(t.shape, 1, 511),
        "mix": t.mix[at],
        "file": t.file[at],
        "bias": np.zeros(len(at), np.int64),
    }
    return np.stack([columns[k].astype(np.int64) + _STARTS[k] for k in SIZES], axis=1)


@dataclass
class CRF:
    """Weights of features for each label, and of label pairs."""

    emit: np.ndarray
    step: np.ndarray

    def viterbi(self, scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best labels of chains (chains x length x 3), and how much they outweigh all outside.

        Before and after each chain stands a token that is outside.
        """
        chains, length, _ = scores.shape
        best = scores[:, 0] + self.step[OUTSIDE]
        back = np.zeros((chains, length, 3), np.int8)
        flat = scores[:, :, OUTSIDE] + self.step[OUTSIDE, OUTSIDE]
        for i in range(1, length):
            ways = best[:, :, None] + self.step[None]
            back[:, i] = ways.argmax(1)
            new = ways.max(1) + scores[:, i]
            best = np.where(mask[:, i, None], new, best)
        final = best + self.step[:, OUTSIDE]
        labels = np.zeros((chains, length), np.int8)
        now = final.argmax(1).astype(np.int8)
        size = mask.sum(1)
        for i in range(length - 1, -1, -1):
            inside = i < size
            labels[:, i] = np.where(inside, now, OUTSIDE)
            now = np.where(inside & (i > 0), back[np.arange(chains), i, now], now)
        outside = np.where(mask, flat, 0).sum(1) + self.step[OUTSIDE, OUTSIDE]
        return labels, final.max(1) - outside


def fit(chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> CRF:
    """Maximum likelihood with a Gaussian prior, by Adam steps over all chains.

    A chain has the feature numbers of its tokens and their labels.
    """
    length = max(len(y) for _, y in chains)
    width = len(SIZES)
    x = np.zeros((len(chains), length, width), np.int64)
    y = np.zeros((len(chains), length), np.int64)
    mask = np.zeros((len(chains), length), bool)
    for i, (f, labels) in enumerate(chains):
        x[i, : len(labels)], y[i, : len(labels)], mask[i, : len(labels)] = f, labels, True
    emit, step = np.zeros((TOTAL, 3)), np.zeros((3, 3))
    step[OUTSIDE, INSIDE] = -4.0
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]
    seen, seen_step = np.zeros_like(emit), np.zeros_like(step)
    rows, cols = np.nonzero(mask)
    for k in range(width):
        np.add.at(seen, (x[rows, cols, k], y[rows, cols]), 1)
    pairs = mask[:, 1:]
    np.add.at(seen_step, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    prior = 0.5
    for turn in range(1, rounds + 1):
        score = emit[x].sum(2)
        forward = np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for i in range(1, length):
            new = score[:, i] + np.logaddexp.reduce(forward[:, i - 1, :, None] + step[None], axis=1)
            forward[:, i] = np.where(mask[:, i, None], new, forward[:, i - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        backward = np.zeros_like(score)
        expected_step = np.zeros_like(step)
        for i in range(length - 2, -1, -1):
            ahead = step[None] + (score[:, i + 1] + backward[:, i + 1])[:, None, :]
            new = np.logaddexp.reduce(ahead, axis=2)
            ok = mask[:, i + 1]
            backward[:, i] = np.where(ok[:, None], new, 0)
            joint = np.exp(forward[:, i, :, None] + ahead - total[:, None, None])
            expected_step += joint[ok].sum(0)
        share = np.exp(forward + backward - total[:, None, None])[rows, cols]
        expected = np.zeros_like(emit)
        for k in range(width):
            for label in range(3):
                expected[:, label] += np.bincount(x[rows, cols, k], share[:, label], TOTAL)
        for w, grad, at in ((emit, expected - seen + prior * emit, 0), (step, expected_step - seen_step + prior * step, 2)):
            moments[at] = 0.9 * moments[at] + 0.1 * grad
            moments[at + 1] = 0.99 * moments[at + 1] + 0.01 * grad**2
            w -= 0.15 * (moments[at] / (1 - 0.9**turn)) / (np.sqrt(moments[at + 1] / (1 - 0.99**turn)) + 1e-6)
    return CRF(emit, step)


def base_spans(raw: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, str, int]]]:
    """Byte spans of the rules by row: start, end, kind and where the secret itself starts."""
    whole = raw.tobytes()
    found: dict[int, list[tuple[int, int, str, int]]] = {}

    def rows_with(words: tuple[bytes, ...], text: bytes) -> np.ndarray:
        places = []
        for w in words:
            at = text.find(w)
            while at >= 0:
                # One hit is enough for a text: go on in the next.
                row = int(np.searchsorted(offsets, at, side="right")) - 1
                places.append(row)
                at = text.find(w, int(offsets[row + 1]))
        return np.unique(np.array(places, np.int64))

    for row in rows_with(KEYWORDS, whole.lower()):
        a, b = int(offsets[row]), int(offsets[row + 1])
        for m in ASSIGN.finditer(whole, a, b):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                found.setdefault(int(row), []).append((m.start(), m.end(), "assign", m.start(2)))
    for row in rows_with((b"AKIA",), whole):
        a, b = int(offsets[row]), int(offsets[row + 1])
        for m in ACCESS.finditer(whole, a, b):
            if m.end() - m.start() >= LEAST["access"]:
                found.setdefault(int(row), []).append((m.start(), m.end(), "access", m.start()))
    n = len(raw)
    hexa = _HEX[raw]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    begins = hexa & np.r_[True, ~hexa[:-1]][:n] | hexa & first[:n]
    stop = np.ones(n + 1, bool)
    stop[:n] = ~hexa | first[:n]
    ends = np.flatnonzero(stop)
    start = np.flatnonzero(begins)
    end = ends[np.searchsorted(ends, start, side="right")] if len(start) else start
    long = end - start >= LEAST["hex"]
    start, end = start[long], end[long]
    for a, b, row in zip(start.tolist(), end.tolist(), (np.searchsorted(offsets, start, side="right") - 1).tolist(), strict=True):
        found.setdefault(row, []).append((a, b, "hex", a))
    return found


def _overlapped(t: Tokens, spans: dict[int, list[tuple[int, int, str, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Whether tokens share a byte with a rule's span, and with the secret in it."""
    any_, core = np.zeros(len(t.start), bool), np.zeros(len(t.start), bool)
    for own in spans.values():
        for a, b, _, secret in own:
            lo = np.searchsorted(t.end, a, side="right")
            hi = np.searchsorted(t.start, b, side="left")
            any_[lo:hi] = True
            core[np.searchsorted(t.end, secret, side="right") : hi] = True
    return any_, core


def training_windows(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around the rules' secrets and around other tokens that could begin one."""
    t = tokens_of(raw, offsets)
    if not len(t.start):
        return []
    _, core = _overlapped(t, base_spans(raw, offsets))
    label = np.where(core & ~t.plain, INSIDE, OUTSIDE)
    label[1:][(label[1:] == INSIDE) & (label[:-1] != INSIDE)] = BEGIN
    label[:1][label[:1] == INSIDE] = BEGIN
    secrets = np.flatnonzero(label == BEGIN)
    others = np.flatnonzero(t.can_begin & (label == OUTSIDE))
    out = []
    for centre in [*secrets.tolist(), *others[:: max(1, len(others) // (2 * len(secrets) + 8))].tolist()]:
        at = np.arange(max(0, centre - AROUND), min(len(label), centre + AROUND + 1))
        at = at[t.row[at] == t.row[centre]]
        out.append((features(t, at), label[at]))
    return out


def fitted(docs: DataFrame, rows: int = SAMPLE, windows: int = WINDOWS) -> CRF | None:
    """A CRF fitted on about ``rows`` documents, chosen by a hash of their ids."""
    share = min(1.0, rows / max(1, docs.count()))
    limit = int(share * 2**32)
    picked = docs.select("doc_id", text_or_empty("text").alias("text")).where(
        F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) < limit
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for part in slices(*utf8_parts(batch.column("text"))) for x in training_windows(*part)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bool((y == BEGIN).any()) for _, y in found], pa.bool_()),
                    pa.array([x.ravel().tolist() for x, _ in found], pa.list_(pa.int32())),
                    pa.array([y.tolist() for _, y in found], pa.list_(pa.int8())),
                ],
                ["secret", "x", "y"],
            )

    rows_ = picked.mapInArrow(run, "secret boolean, x array<int>, y array<tinyint>").withColumn("k", F.xxhash64("x", "y"))
    got = rows_.where("secret").orderBy("k").limit(windows // 2).unionByName(
        rows_.where("NOT secret").orderBy("k").limit(windows // 2)
    ).collect()
    if not any(r["secret"] for r in got):
        return None
    return fit([(np.array(r["x"]).reshape(-1, len(SIZES)), np.array(r["y"])) for r in sorted(got, key=lambda r: r["k"])])


def added_spans(crf: CRF | None, raw: np.ndarray, offsets: np.ndarray, spans: dict) -> dict[int, list[tuple[int, int]]]:
    """Byte spans that the CRF finds and no rule does, by row."""
    out: dict[int, list[tuple[int, int]]] = {}
    t = tokens_of(raw, offsets)
    if crf is None or not t.can_begin.any():
        return out
    free = ~t.plain
    edge = np.r_[True, ~free[:-1] | (t.row[1:] != t.row[:-1])]
    starts = np.flatnonzero(free & edge)
    stop = np.r_[~free | np.r_[False, t.row[1:] != t.row[:-1]], True]
    ends = np.flatnonzero(stop)
    ends = ends[np.searchsorted(ends, starts, side="right")]
    begins = np.r_[0, np.cumsum(t.can_begin)]
    some = begins[ends] > begins[starts]
    starts, ends = starts[some], ends[some]
    taken, _ = _overlapped(t, spans)
    order = np.argsort(ends - starts, kind="stable")
    size = (ends - starts)[order]
    at = 0
    while at < len(order):
        # Chains of about the same length, and no more than fit in little memory.
        upto = at + max(1, min(len(order) - at, 200_000 // int(size[at])))
        upto = at + max(1, int(np.searchsorted(size[at:upto], 2 * size[at] + 4, side="right")))
        own, length = order[at:upto], int(size[upto - 1])
        at = upto
        index = starts[own][:, None] + np.arange(length)[None]
        mask = index < ends[own][:, None]
        index = np.where(mask, index, starts[own][:, None])
        scores = crf.emit[features(t, index.ravel())].sum(1).reshape(len(own), length, 3)
        scores[..., BEGIN] = np.where(t.can_begin[index], scores[..., BEGIN], -1e9)
        labels, margin = crf.viterbi(scores, mask)
        for i in np.flatnonzero((labels == BEGIN).any(1) & (margin >= ADDED_MARGIN)).tolist():
            j, n = 0, int(mask[i].sum())
            while j < n:
                if labels[i, j] != BEGIN:
                    j += 1
                    continue
                k = j + 1
                while k < n and labels[i, k] == INSIDE and t.start[index[i, k]] == t.end[index[i, k - 1]]:
                    k += 1
                a, b = int(t.start[index[i, j]]), int(t.end[index[i, k - 1]])
                if b - a >= ADDED_BYTES and not taken[index[i, j:k]].any():
                    out.setdefault(int(t.row[index[i, j]]), []).append((a, b))
                j = k
    return out


def spans_of(crf: CRF | None, raw: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, str]]]:
    """All spans of each text in code points: start, end and kind, in order."""
    return [own for part in slices(raw, offsets) for own in _spans_of(crf, *part)]


def _spans_of(crf: CRF | None, raw: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, str]]]:
    base = base_spans(raw, offsets)
    added = added_spans(crf, raw, offsets, base)
    out: list[list[tuple[int, int, str]]] = [[] for _ in range(len(offsets) - 1)]
    for row in {*base, *added}:
        a, b = int(offsets[row]), int(offsets[row + 1])
        before = np.r_[0, np.cumsum((raw[a:b] & 0xC0) != 0x80)]
        found = [(s, e, k) for s, e, k, _ in base.get(row, [])] + [(s, e, "crf") for s, e in added.get(row, [])]
        out[row] = sorted(
            ((int(before[s - a]), int(before[e - a]), k) for s, e, k in found), key=lambda x: (x[0], KINDS.index(x[2]), x[1])
        )
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scanned(docs: DataFrame, crf: CRF | None) -> DataFrame:
    """Counts, digest and list of the spans of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of(shared.value, *utf8_parts(batch.column("text")))
            base = [[s for s in own if s[2] != "crf"] for own in found]
            counts = [pa.array([sum(s[2] == k for s in own) for own in base], pa.int64()) for k in KINDS[:3]]
            digest = [hashlib.sha256(_joined(own).encode()).hexdigest() for own in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digest, pa.string()), pa.array(map(_joined, found), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def without(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with the mask in place of what the spans cover."""
    out, at = [], 0
    for a, b, _ in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, crf: CRF | None) -> DataFrame:
    """The documents with their secrets masked; ``n_chars``, if there, follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = spans_of(shared.value, *utf8_parts(texts))
            if any(found):
                new = [without(t, own) if own else t for t, own in zip(texts.to_pylist(), found, strict=True)]
                changed = {"text": pa.array(new, texts.type)}
                if "n_chars" in names:
                    old = batch.column("n_chars")
                    sizes = [len(t) if own else n for t, own, n in zip(new, found, old.to_pylist(), strict=True)]
                    changed["n_chars"] = pa.array(sizes, old.type)
                batch = pa.RecordBatch.from_arrays([changed.get(c, batch.column(c)) for c in names], names)
            yield batch

    return docs.mapInArrow(run, docs.schema)
