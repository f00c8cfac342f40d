import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketlens.llm import infill as I
from ticketlens.llm.base import utf8_parts

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [
    None, "", " ", "\n\t ", "a", " a", "a ", "one two  three\n\nfour ", "héllo  wörld 😀😀 \n x\x85y z\x1c", "a <P> b", "x<S>", "<M>", "<P <S", "a<S <",
    "w " * 40_000, "x" * 100_000, "é" * 5000 + " " * 5000, "same text here", "same text here", "\x00 \x01",
]


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_brute_force(spark, make_docs):
    rows = [(i, t) for k in range(12) for i, t in enumerate(TEXTS, k * len(TEXTS))] + [(None, "no id at all"), (3, "tied id"), (3, "tied id")]
    docs = make_docs(rows, extra=True).withColumn("n", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("h1", F.lit("x"))
    out = I.transformed(docs).withColumn("back", I.restored(F.col("output"), F.col("form"))).collect()
    assert set(out[0].asDict()) == {*docs.columns, *I.ADDED, "back"}
    seen = set()
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out), key=repr)
    assert got == sorted(((i, t, *brute(i, t)) for i, t in rows), key=repr)
    for r in out:
        assert r.back == (r.text or "")
        seen.add(r.form)
    assert seen == {"plain", "psm", "spm"}
    digests = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in I.digests(docs).collect()}
    assert digests == {
        (i, hashlib.sha256(brute(i, t)[4].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows
    }


def test_every_rank_is_reached():
    """The skip list against plain counting, at every rank of several texts at once."""
    import pyarrow as pa

    raw, offsets = utf8_parts(pa.array(t or "" for t in TEXTS[:14]))
    lists = I.skip_lists(raw, offsets)
    units = [UNIT.findall(t or "") for t in TEXTS[:14]]
    assert lists.n.tolist() == [len(u) for u in units]
    for rank in range(8):
        ranks = np.minimum(lists.n, rank)
        assert lists.cut(ranks).tolist() == [len("".join(u[:rank])) for u in units]
    raw, offsets = utf8_parts(pa.array([None, "ab é " * 3000, ""]))
    lists = I.skip_lists(raw, offsets)
    assert len(lists.lanes) > 4
    for rank in (0, 1, 2, 2999, 3000, 6000, 6001):
        at = min(rank, int(lists.n[1]))
        assert lists.cut(np.minimum(lists.n, rank)).tolist() == [0, len("".join(UNIT.findall("ab é " * 3000)[:at])), 0]


def test_lanes_carry_widths():
    """Links of each lane add up to the text's units and code points, and each lane has about a fourth of the nodes."""
    import pyarrow as pa

    raw, offsets = utf8_parts(pa.array(["añ b " * 5000]))
    lists = I.skip_lists(raw, offsets)
    for low, high in zip(lists.lanes, lists.lanes[1:], strict=False):
        assert high.units.sum() == 10_001 and high.points.sum() == 25_000
        assert len(high.units) < 0.5 * len(low.units) + 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\x0babé😀<PSM>", max_size=60), max_size=6), st.integers(0, 40))
def test_any_texts(texts, rank):
    import pyarrow as pa

    raw, offsets = utf8_parts(pa.array(texts, pa.string()))
    lists = I.skip_lists(raw, offsets)
    units = [UNIT.findall(t) for t in texts]
    assert lists.n.tolist() == [len(u) for u in units]
    got = lists.cut(np.minimum(lists.n, rank))
    assert got.tolist() == [len("".join(u[:rank])) for u in units]


def test_shares_and_empty(make_docs):
    docs = make_docs([(i, "some words to cut here") for i in range(2000)])
    forms = {r.form: r["count"] for r in I.transformed(docs).groupBy("form").count().collect()}
    assert 900 < forms["plain"] < 1100 and 3 < forms["spm"] / forms["psm"] < 5
    assert {r.form for r in I.transformed(docs, fim_percent=100, spm_percent=0).collect()} == {"psm"}
    assert I.digests(make_docs([])).collect() == []
