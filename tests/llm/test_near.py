import random

import numpy as np
import pytest

from ticketlens.llm import components as C
from ticketlens.llm import near as N


def brute(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(set(zip(w, w[1:], w[2:], strict=False)) if len(w) > 2 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if same or (both and 100 * both >= 85 * len(sets[i] | sets[j])):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        root = min(group) if doc_id is not None else None
        out.append((doc_id, len(sets[i]), root, doc_id is None or root == doc_id))
    return sorted(out, key=repr)


def rows_of(pool):
    rnd = random.Random(11)
    rows = []
    for g in range(12):  # groups of copies with a drift, so that ends of a chain are not alike
        words = pool(200, 300 + g)
        for _ in range(12):
            rows.append((rnd.randrange(10**6) * 100 + len(rows) % 100, " ".join(words)))
            words = list(words)
            for _ in range(rnd.randrange(1, 5)):
                words[rnd.randrange(len(words))] = rnd.choice(pool(50, 5))
    hot = pool(150, 77)
    for k in range(80):  # one large group around one text
        words = list(hot)
        words[k] = f"new{k}"
        rows.append((10**9 + k, " ".join(words)))
    common = pool(40, 88)
    rows += [(2 * 10**9 + k, " ".join(pool(60, 1000 + k) + common)) for k in range(60)]
    rows += [(3 * 10**9 + k, t) for k, t in enumerate([None, "", " \n", "a", "A", "a b", "A B", "a b c", "a b c d", "x " * 5000, "X " * 4000])]
    rows += [rows[0], rows[-1], (rows[3][0], " ".join(pool(100, 9999)))]
    return rows


def test_brute_force(make_docs, pool):
    rows = rows_of(pool)
    got = sorted((tuple(r) for r in N.groups(make_docs(rows, extra=True)).collect()), key=repr)
    assert got == brute(rows)


def test_large_nodes(make_docs, pool, monkeypatch):
    """Nodes compared in parts that branch on, instead of at once."""
    monkeypatch.setattr(N, "SMALL", 24)
    monkeypatch.setattr(N, "MANY", 20)
    monkeypatch.setattr(N, "SAMPLES", 6)
    monkeypatch.setattr(N, "OTHERS", 12)
    rows = rows_of(pool)[100:230]
    got = sorted((tuple(r) for r in N.groups(make_docs(rows)).collect()), key=repr)
    assert got == brute(rows)


def test_classes_are_passed_on_once(spark, make_docs, pool, monkeypatch):
    """A node's children are worked out once, however many steps read them."""
    for name, value in (("SMALL", 24), ("SAMPLES", 6), ("OTHERS", 12)):
        monkeypatch.setattr(N, name, value)
    made, own, want = spark.sparkContext.accumulator(0), N._children, []

    def children(rows):
        out = own(rows)
        want.append(out.count())

        def run(batches):
            for batch in batches:
                made.add(len(batch))
                yield batch

        return out.mapInArrow(run, out.schema)

    monkeypatch.setattr(N, "_children", children)
    N.groups(make_docs(rows_of(pool)[100:230])).count()
    assert made.value == sum(want) > 0


def test_long_texts_branch(make_docs):
    """Unlinked long texts with a common passage part by their tokens, whose bytes are not all 0."""
    rnd = random.Random(3)
    passage = [f"p{k}" for k in range(200)]
    n = N.SMALL + 76
    rows = [(k, " ".join([f"w{rnd.randrange(10**6)}" for _ in range(1800)] + passage)) for k in range(n)]
    docs = make_docs(rows)
    signed = N.written(N._signed(docs), "signed")
    sketches = np.array([list(r.sketch) for r in signed.select("sketch").collect()])
    assert len(np.unique(sketches)) == 256
    # Two of these sets have a twentieth in common.
    assert (sketches[1:] == sketches[:-1]).mean() < 0.1
    got = N.groups(docs)
    assert got.count() == n and got.where("kept AND component_id = doc_id").count() == n


def test_one_of_each_group_stays(make_docs, pool):
    text = " ".join(pool(100, 1))
    docs = make_docs([(5, text), (3, text + " x"), (9, " ".join(pool(100, 2))), (7, None)], extra=True)
    got = N.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [3, 7, 9]


def test_repeated_rows_and_rows_without_an_id(make_docs, pool):
    """One row of each group stays, whatever its rows have for an id."""
    a, b, c = (" ".join(pool(100, k)) for k in (1, 2, 3))
    rows = [(4, a), (4, a), (4, a.upper()), (None, a), (None, a + " x"), (None, b), (None, b), (6, c), (6, b + " y"), (8, ""), (8, ""), (None, None), (None, None)]
    got = sorted(((r.doc_id, r.text) for r in N.deduplicated(make_docs(rows, extra=True)).collect()), key=repr)
    # 6 has two texts and stays with both; b without an id is a copy of its second one.
    assert sorted((i, (t or "").lower()) for i, t in got if i == 4) == [(4, a)]
    rest = sorted([(6, c), (6, b + " y"), (8, ""), (8, ""), (None, None), (None, None)], key=repr)
    assert [x for x in got if x[0] != 4] == rest


def test_empty(make_docs):
    assert N.groups(make_docs([])).count() == 0


@pytest.mark.parametrize(("seed", "together"), [(0, 400_000), (1, 400_000), (2, 400_000), (0, 7), (1, 20), (2, 40)])
def test_components(spark, seed, together, monkeypatch):
    """In one task, and in many that contract their own edges between rounds."""
    monkeypatch.setattr(C, "TOGETHER", together)
    rnd = random.Random(seed)
    n = 60
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(40)] + [(i, i + 1) for i in range(n, n + 40)] + [(500, k) for k in range(501, 530)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(parent) if find(x) != x}
    got = C.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()
    assert {r.id: r.root for r in got} == want and len(got) == len(want)
    # Links that come later extend what is known.
    first, later = (spark.createDataFrame(e, "u long, v long") for e in (edges[:70], edges[70:]))
    got = C.extended(C.extended(None, first), later).collect()
    assert {r.id: r.root for r in got} == want and len(got) == len(want)


def test_least_reachable():
    rnd = np.random.default_rng(4)
    for n in (1, 5, 300):
        u, v = rnd.integers(0, n, 2 * n), rnd.integers(0, n, 2 * n)
        nodes, root = C.least_reachable(u, v)
        of = dict(zip(nodes.tolist(), root.tolist(), strict=True))
        assert all(of[a] == of[b] for a, b in zip(u.tolist(), v.tolist(), strict=True))
        assert all(r <= x and of[r] == r for x, r in of.items())
    chain = np.arange(5000)
    assert (C.least_reachable(chain[1:], chain[:-1])[1] == 0).all()
