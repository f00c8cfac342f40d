"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

A byte-level BPE works on an alphabet of 256 printable characters, one for
each byte. The table between the two (``byte_characters``) is a rule: bytes
that print stay themselves, the others take the next free code points from
256 on. Encoding runs the library over Arrow batches; decoding looks each id
up in a list of byte strings, made once by reversing the table, so a
character whose bytes are split over tokens comes back whole.

Each match of the vocabulary's pattern is encoded on its own, so a match's ids
are the same wherever it stands: a worker sends a match to the library once
and remembers its ids, up to a fixed number of matches. Work is per row: no
shuffle, and nothing that a result depends on is kept between rows.

Defined cases: a null text is encoded as the empty text (no ids, digests of
nothing); repeated rows give equal rows; ids out of range or null in
``decoded`` make an error; extra columns of the input are kept by ``encoded`` and
``decoded`` unless they have the name of a result, which replaces them.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import text_or_empty

#: Matches of the pattern whose ids a worker remembers; then it starts anew.
REMEMBERED = 400_000
#: Matches that go to the library in one call.
SLICE = 20_000
#: Texts of such characters can be split by Python's own, faster expressions:
#: there the classes of the two agree (no number that is not a decimal digit, no
#: separator of the codes 28 to 31).
_OTHER = re.compile(r"[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")
#: The pattern of the vocabulary for such texts. The first alternative begins
#: as no other does, so it may come first.
_SPLIT = re.compile(
    r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)


def default_vocabulary() -> str:
    """Path of the ranks file of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


class ByteBPE:
    """One worker's encoder and decoder for a vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        import base64

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer, models

        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.bytes_of: list[bytes] = [b""] * (max(int(r) for _, r in pairs) + 1)
        for token, rank in pairs:
            self.bytes_of[int(rank)] = base64.b64decode(token)
        chars = byte_characters()
        ranks = {b: r for r, b in enumerate(self.bytes_of) if b}
        vocab = {"".join(chars[x] for x in b): r for b, r in ranks.items()}
        merges = []
        for b in self.bytes_of:
            if len(b) > 1:
                left, right = self._last_pair(b, ranks)
                merges.append(("".join(chars[x] for x in left), "".join(chars[x] for x in right)))
        self.library = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.chars = chars
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.known: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
        """The two parts that merge into ``token`` last: its own encoding by lower ranks."""
        parts = [token[i : i + 1] for i in range(len(token))]
        limit = ranks[token]
        while len(parts) > 2:
            best, at = limit, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], limit)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                raise ValueError(f"{token!r} is not a merge of lower ranks")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def matches(self, text: str) -> list[str]:
        return (self.pattern if _OTHER.search(text) else _SPLIT).findall(text)

    def encode(self, text: str) -> list[int]:
        """Ids of one text, by the library for matches not yet known."""
        parts = self.matches(text)
        try:
            return list(chain.from_iterable(map(self.known.__getitem__, parts)))
        except KeyError:
            pass
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = [x for x in dict.fromkeys(parts) if x not in self.known]
        for at in range(0, len(new), SLICE):
            some = new[at : at + SLICE]
            mapped = ["".join(map(self.chars.__getitem__, x.encode())) for x in some]
            for x, e in zip(some, self.library.encode_batch_fast(mapped, add_special_tokens=False), strict=True):
                self.known[x] = tuple(e.ids)
        return list(chain.from_iterable(map(self.known.__getitem__, parts)))

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one after its last."""
        raw = np.frombuffer(text.encode(), np.uint8)
        # The character that each byte is of: a byte of the form 10xxxxxx goes on with one.
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ids) else ends
        return character[starts].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBPE:
    """The encoder of a vocabulary, built once in each Python worker."""
    return ByteBPE(path)


def encoded(df: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids``, ``starts`` and ``ends`` of its tokens.

    Starts and ends count characters of the text. Tokens that split a
    character each get the place of the whole character.
    """
    source = df.drop("ids", "starts", "ends") if text_col not in ("ids", "starts", "ends") else df
    names = [c for c in source.columns if c not in ("ids", "starts", "ends")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path or default_vocabulary())  # the worker's own, unless one is given
        ints = pa.list_(pa.int32())
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            ids = [bpe.encode(t) for t in texts]
            starts, ends = zip(*(bpe.offsets(t, x) for t, x in zip(texts, ids, strict=True)), strict=True) if texts else ((), ())
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(x, ints) for x in (ids, starts, ends))], [*names, "ids", "starts", "ends"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in names)
    return source.mapInArrow(run, f"{fields}, ids array<int>, starts array<int>, ends array<int>")


def decoded(df: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes of its ids (null ids: no bytes)."""
    names = [c for c in df.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path or default_vocabulary())  # the worker's own, unless one is given
        for batch in batches:
            out = [bpe.decode(x or ()) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(out, pa.binary())], [*names, "decoded"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in names)
    return df.mapInArrow(run, f"{fields}, decoded binary")


def round_trip(
    df: DataFrame, path: str | None = None, text_col: str = "text", id_col: str = "doc_id", keep: Sequence[str] = ()
) -> DataFrame:
    """Encode each text, decode its ids, and return digests of both.

    One row per input row: id, ``n_tokens``, ``ids_sha256`` (decimal ids
    joined by one blank), ``decoded_sha256`` (decoded bytes) and ``lossless``
    (the decoded bytes are the text's), and the columns to ``keep``. The ids stay in the worker, so only digests travel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path or default_vocabulary())  # the worker's own, unless one is given
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, ids_digest, digest, lossless = [], [], [], []
            for text in texts:
                ids = bpe.encode(text)
                raw = bpe.decode(ids)
                counts.append(len(ids))
                ids_digest.append(hashlib.sha256(" ".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                digest.append(hashlib.sha256(raw).hexdigest())
                lossless.append(raw == text.encode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_digest, pa.string()),
                    pa.array(digest, pa.string()),
                    pa.array(lossless, pa.bool_()),
                    *batch.columns[2:],
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "lossless", *keep],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, lossless boolean"
    schema = ", ".join([schema, *(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)])
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), *keep).mapInArrow(run, schema)
