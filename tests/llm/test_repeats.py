import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketlens.llm import repeats as P
from ticketlens.llm.idset import packed, unpacked


def brute(rows):
    first = {}
    for doc_id, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - 12):
            if doc_id is not None and first[tuple(w[i : i + 13])] < doc_id:
                gone.update(range(i, i + 13))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(pool):
    passage = pool(60, 1)
    rows = [(i, " ".join(pool(40, 100 + i) + passage[: 10 + i] + pool(20, 200 + i))) for i in range(30)]
    rows += [(100, " ".join(pool(500, 7))), (101, " ".join(pool(500, 7))), (102, " ".join(pool(499, 7) + ["x"]))]
    rows += [(103, None), (104, ""), (105, " ".join(passage[:13])), (106, " ".join(passage[:12])), (107, "a " * 3000)]
    rows += [(108, "a " * 20), (100, " ".join(pool(500, 7))), (101, "other text"), (None, " ".join(passage)), (5, None)]
    rows += [(109, "日本 語 é\x0bx " * 20), (110, "日本 語 é x " * 20)]
    return rows


@pytest.mark.parametrize("bits", [1 << 10, P.MOST_BITS])
def test_brute_force(make_docs, pool, bits, monkeypatch):
    """Also with a sketch so small that nearly every window passes it."""
    if bits < P.LEAST_BITS:
        monkeypatch.setattr(P, "LEAST_BITS", bits)
    rows = rows_of(pool)
    got = P.deduplicated(make_docs(rows, extra=True), most_bits=bits)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_empty(make_docs):
    assert P.deduplicated(make_docs([])).count() == 0


def test_the_sketch_never_counts_too_little(make_docs, pool):
    rows = [(i, " ".join(pool(100, i % 7))) for i in range(14)]
    table = P.sketch([(P._pairs(make_docs(rows)), None)], 1 << 12)
    for _, text in rows:
        hashes, _ = P.windows_of(P.words_of(text))
        assert P._repeated(hashes, table).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**33), unique=True), st.randoms())
def test_packed_round_trip(values, rnd):
    cells = np.sort(np.array(values, np.int64))
    counts = np.array([rnd.choice([1, 2, 5]) for _ in values], np.int64)
    back, many = unpacked(packed(cells, counts))
    assert back.tolist() == cells.tolist() and many.tolist() == (counts > 1).tolist()
