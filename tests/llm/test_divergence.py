import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ticketlens.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=3, most=200):
    docs = [(lang or "", source or "", text or "") for lang, source, text in rows]
    found = [
        (lang, source, Counter("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text))) for lang, source, text in docs
    ]
    having, total, own = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in found:
        having[lang].update(set(terms))
        total[lang].update(terms)
        own[lang, source].update(terms)
    out = []
    for (lang, source), counts in own.items():
        kept = [t for t, n in having[lang].items() if n >= least]
        v = len(kept)

        def shares(c, kept=kept, v=v):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        p, q = shares(counts), shares(total[lang])
        pairs = []
        for (other_lang, other), c in own.items():
            if other_lang == lang and other != source:
                y = shares(c)
                pairs.append((-sum((p[t] - y[t]) ** 2 // y[t] for t in kept), other.encode(), other))
        terms = sorted((-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[t] and p[t] > q[t])
        for part, items in (("pair", sorted(pairs)), ("term", terms[:most])):
            out += [(lang, source, part, name, -value, rank) for rank, (value, _, name) in enumerate(items, 1)]
    return sorted(out)


def frame(spark, rows):
    data = [(i, text, lang, source, "clash", "clash", 1) for i, (lang, source, text) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, term string, value string, rank int")


def rows_of(seed, docs=160, sources=6):
    rnd = random.Random(seed)
    words = ["the", "Über", "naïve", "x-ray", "A1b2", "日本", "😀a", "İ", "É", "é", *(f"w{chr(97 + k)}" for k in range(20))]
    rows = []
    for k in range(docs):
        lang = rnd.choice(["en", "en", "en", "de", "fr", None])
        source = f"s{min(rnd.randrange(sources), rnd.randrange(sources))}" if rnd.random() < 0.95 else None
        text = " ".join(rnd.choice(words[: 6 + 4 * (k % 6)]) for _ in range(rnd.randrange(40)))
        rows.append((lang, source, text))
    rows += [("en", "s0", None), ("en", "s0", ""), ("en", "only blanks", " \n"), ("xx", "a", "rare"), ("xx", "b", "words here"), ("one", "alone", "a a a")]
    return rows + rows[:7] + [("en", "long", "the word " * 30_000)] + [("one", "alone", "a b"), ("one", "alone", "a")]


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rows = rows_of(seed)
    got = sorted(tuple(r) for r in D.audited(frame(spark, rows)).collect())
    want = brute(rows)
    assert got == want
    assert any(r[0] == "xx" and r[4] == 0 and r[2] == "pair" for r in got) and not any(r[0] == "one" and r[2] == "pair" for r in got)


def test_other_bounds_and_cut_trees(spark, monkeypatch):
    """The sums don't depend on where trees and counts are cut, nor on the number of partitions."""
    rows = rows_of(3, docs=120, sources=9)
    monkeypatch.setattr(D, "ENTRIES", 5)
    monkeypatch.setattr(D, "COMBINATIONS", 3)
    got = sorted(tuple(r) for r in D.audited(frame(spark, rows).repartition(7), least=2, terms=4).collect())
    assert got == brute(rows, least=2, most=4)


def test_tree_shares_paths():
    """Rows that begin alike share nodes, and a node-ancestor combination is worked out once for all of its terms."""
    tree = D.Tree()
    a, b, c, d = (0, 500, 10), (1, 700, 20), (2, 900, 30), (2, 400, 30)
    tree.insert([a, b, c], 5)
    tree.insert([a, b, d], 2)
    tree.insert([a, b], 1)
    tree.insert([b], 4)
    assert len(tree._parent) == 5 and sorted(tree._times) == [2, 4, 5, 8, 8]
    combos = list(tree.corrections())
    assert sum(len(s) for s, _, _, _ in combos) <= 2 * 5
    total = Counter()
    for s, t, high, low in combos:
        for key, h, w in zip(zip(s.tolist(), t.tolist(), strict=True), high.tolist(), low.tolist(), strict=True):
            total[key] += (h << 32) + w

    def f(p, q):
        return (p - q) ** 2 // q

    want = Counter()
    for row, times in (([a, b, c], 5), ([a, b, d], 2), ([a, b], 1), ([b], 4)):
        for s, p, z in row:
            for t, q, y in row:
                if s != t:
                    want[s, t] += times * (f(p, q) - f(p, y) - f(z, q) + f(z, y))
    assert total == want


def test_large_numbers():
    """Values near the bound, times many terms: the halves add up to the exact sum."""
    tree = D.Tree()
    big, small, times = (0, 10**9 + 1, 5 * 10**8), (1, 1, 3), 1_000_000_007
    tree.insert([big, small], times)
    (total,) = {(h << 32) + w for s, t, high, low in tree.corrections() for k, h, w in zip(s.tolist(), high.tolist(), low.tolist(), strict=True) if k == 0}

    def f(p, q):
        return (p - q) ** 2 // q

    assert total == times * (f(big[1], small[1]) - f(big[1], small[2]) - f(big[2], small[1]) + f(big[2], small[2]))
    assert abs(total) > np.iinfo(np.int64).max


def test_empty(spark):
    assert D.audited(frame(spark, [])).collect() == []
    assert D.audited(frame(spark, [("en", "a", "x")])).collect() == []
