import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken

from ticketlens.llm import bpe as B

TEXTS = [
    None, "", " ", "it's we'll 'rest ''s", "héllo  wörld 😀😀 \n\n  x", "²½ Ⅷ 12٣４ x_y __ a\xa0b \x85 \x1c\x1d", "<|endoftext|>",
    "日本語 текст ŉ ʼn ﬁ", "\x00\x01\x7f", "a" * 30_000, "ab " * 20_000, "é ﷽ 👩‍👩‍👧 ", "same", "same", "'ſ 'S 'Re I'M", "\r\n\t   x",
]


@pytest.fixture(scope="module")
def reference():
    with open(B.default_vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids(spark, make_docs, reference, sf_dir):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(100).collect()]
    rows = {r.doc_id: r for r in B.round_trip(make_docs(list(enumerate(texts)), extra=True)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = reference.encode_ordinary(t or "")
        assert rows[i].n_tokens == len(ids) and rows[i].lossless
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_offsets_and_decoding(make_docs):
    docs = make_docs(list(enumerate(TEXTS)), extra=True)
    rows = B.decoded(B.encoded(docs)).collect()
    assert set(rows[0].asDict()) == {*docs.columns, "starts", "ends", "decoded"}
    for r in rows:
        text = r.text or ""
        assert bytes(r.decoded).decode() == text
        assert len(r.ids) == len(r.starts) == len(r.ends)
        assert all(a < b for a, b in zip(r.starts, r.ends, strict=True))
        assert not text or (r.starts[0] == 0 and r.ends[-1] == len(text))
        # Each token starts where the last one ended, or within the character that they share.
        assert all(a in (b, b - 1) for a, b in zip(r.starts[1:], r.ends, strict=False))


def test_remembering_changes_nothing(monkeypatch):
    texts = [t or "" for t in TEXTS]
    whole = B.ByteBPE(B.default_vocabulary())
    want = [whole.encode(t) for t in texts]
    monkeypatch.setattr(B, "REMEMBERED", 3)
    assert [whole.encode(t) for t in reversed(texts)] == want[::-1]


def test_empty(make_docs):
    assert B.round_trip(make_docs([])).count() == 0
    assert B.decoded(B.encoded(make_docs([]))).count() == 0
