import hashlib
from collections import Counter, defaultdict
from math import sqrt

import pytest

from ticketlens.llm import mixing as M


def brute(rows, period, block_rows, exponent=0.5, weights=None):
    """Slots by a plain earliest-deadline-first run over the whole schedule."""
    sizes = Counter(s or "" for _, s in rows)
    names = sorted(sizes)
    w = {s: (weights.get(s, 0.0) if weights else sizes[s] ** exponent) for s in names}
    total = sum(w.values())
    q = max(period, 64 * len(names))
    share = {s: (w[s] / total if total > 0 else 1 / len(names)) * (q - len(names)) for s in names}
    slots = {s: 1 + int(share[s]) for s in names}
    for s in sorted(names, key=lambda s: (-(share[s] - int(share[s])), s))[: q - sum(slots.values())]:
        slots[s] += 1
    assert sum(slots.values()) == q
    taken = {s: 0 for s in names}
    blocks = {s: -(-sizes[s] // block_rows) for s in names}
    slot_of = {}
    t = 0
    while any(taken[s] < blocks[s] for s in names):
        ready = [(-(-(taken[s] + 1) * q // slots[s]), s) for s in names if taken[s] * q // slots[s] <= t]
        _, s = min(ready)
        slot_of[s, taken[s]] = t
        taken[s] += 1
        t += 1
    out = []
    for s in names:
        own = sorted((hashlib.md5(str(d).encode()).hexdigest() if d is not None else hashlib.md5(b"").hexdigest(), d is not None, d or 0) for d, x in rows if (x or "") == s)
        for rank, (_, given, d) in enumerate(own):
            b = rank // block_rows
            out.append((d if given else None, s, b, slot_of[s, b], rank % block_rows, b * q // slots[s], -(-(b + 1) * q // slots[s])))
    out.sort(key=lambda r: (r[3], r[4]))
    return out, slots, q


def rows_of():
    rows = [(i, "big") for i in range(300)] + [(1000 + i, f"s{i % 5}") for i in range(120)] + [(5000 + i, None) for i in range(9)]
    return rows + [(9999, "one"), (None, "big"), (7, "big")]


@pytest.mark.parametrize("weights", [None, {"big": 1.0, "s1": 2.5, "absent": 3.0}])
def test_brute_force(make_docs, monkeypatch, weights):
    monkeypatch.setattr(M, "BUCKET_ROWS", 50)
    monkeypatch.setattr(M, "CHUNK_SLOTS", 16)
    docs = make_docs([(d, "t", s) for d, s in rows_of()], extra=True)
    want, _, _ = brute(rows_of(), 64, 4, weights=weights)
    got = sorted(M.positions(docs, period=64, block_rows=4, weights=weights).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(want)))
    assert [(r.doc_id, r.source or "", r.block, r.slot, r.in_block, r.release, r.deadline) for r in got] == want


def test_deviation_is_below_one_block(make_docs):
    docs = make_docs([(i, "t", f"s{i % 7 if i % 3 else 0}") for i in range(700)])
    rows = M.scheduled(docs, period=256, block_rows=1).collect()
    slots = {r["source"]: r["slots"] for r in M.source_slots(docs, period=256).collect()}
    period = max(256, 64 * len(slots))
    sizes = Counter(r["source"] for r in rows)
    at = defaultdict(list)
    for r in rows:
        assert r.release <= r.slot < r.deadline
        at[r["source"]].append(r.slot)
    for s, own in at.items():
        own.sort()
        assert len(set(own)) == sizes[s]
        for i, t in enumerate(own):  # before and after each of its slots
            assert abs(i - t * slots[s] / period) < 1
            assert abs(i + 1 - (t + 1) * slots[s] / period) < 1
    assert len({r.slot for r in rows}) == len(rows)


def test_default_weights_are_tempered(make_docs):
    docs = make_docs([(i, "t", "a" if i < 900 else "b") for i in range(1000)])
    slots = {r["source"]: r["slots"] for r in M.source_slots(docs).collect()}
    assert sum(slots.values()) == M.PERIOD
    assert abs(slots["a"] / M.PERIOD - sqrt(900) / (sqrt(900) + sqrt(100))) < 0.005


def test_mixed_keeps_rows_and_columns(make_docs):
    docs = make_docs([(i % 50, f"t{i}", f"s{i % 3}") for i in range(200)] + [(None, None, None)], extra=True)
    got = M.mixed(docs)
    assert got.columns == docs.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()))
    order = [r.source for r in M.mixed(docs, block_rows=1).collect()]
    assert set(order[:4]) == {"s0", "s1", "s2"} or len(set(order[:6])) >= 3


def test_empty_and_native(make_docs):
    assert M.positions(make_docs([])).count() == 0
    plan = M.positions(make_docs([(1, "t", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
