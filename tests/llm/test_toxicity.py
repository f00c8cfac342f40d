import zlib

import numpy as np
import pytest

from ticketlens.llm import toxicity as X

INSULTS = ["blockhead", "nincompoop", "scoundrel", "dimwit"]


@pytest.fixture(scope="module")
def corpus(pool):
    rnd = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(900):
        words = pool(60, 5000 + i)
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words[rnd.integers(60)] = str(rnd.choice(INSULTS))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000 + k, rows[6][1] + f" {k}") for k in range(40)]  # copies of one toxic document
    labels += [(1000 + k, 1) for k in range(40)] + [(2000, None), (None, 1), (0, 0)]
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, make_docs, corpus):
    rows, labels = corpus
    return X.fitted(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(make_docs, model, corpus):
    rows, labels = corpus
    rows = rows + [(3000, None), (3001, ""), (3002, None), (None, "dimwit dimwit")]
    got = X.scores(make_docs(rows, extra=True), model).collect()
    assert len(got) == len(rows)
    toxic = {i: t for i, t in labels if i is not None and t is not None} | {0: 1}
    right = 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in toxic and r.held_out:
            right += r.predicted == toxic[r.doc_id]
    n = sum(r.doc_id in toxic and r.held_out for r in got)
    assert n > 150 and right / n > 0.97
    empty = [r.score for r in got if r.doc_id in (3000, 3001, 3002)]
    assert len(set(empty)) == 1 and empty[0] < 0.3


def test_gaps_and_inserted_characters(model, pool):
    clean = " ".join(pool(50, 77_777))
    score = lambda word: model.score(np.array(model.evidence([f"{clean} {word} {word} {word}"])))[0]
    for word in ("nincompoop", "NINCOMPOOP!", "ninc.ompoop", "nincoXmpoop", "scoundr3el", "d i m w i t", "blockheads"):
        assert score(word) >= 0.3, word
    for word in (*pool(20, 88_888), "blossom", "ninepins", "scout", "dimmer"):
        assert score(word) < 0.3, word


def test_kernel_against_its_definition():
    """The explicit features give the kernel of all subsequences with bounded gaps."""
    from itertools import combinations

    def features(word):
        s = "^" + word + "$"
        out = {}
        for i, j, k in combinations(range(len(s)), 3):
            if j - i <= X.REACH and k - j <= X.REACH and all(c.isalpha() or c in "^$" for c in (s[i], s[j], s[k])):
                key = (s[i], s[j], s[k])
                out[key] = out.get(key, 0) + X.DECAY ** (k - i + 1)
        norm = sum(v * v for v in out.values()) ** 0.5
        return {k: v / norm for k, v in out.items()}

    words = ["banana", "bandana", "a", "nab", "b4nana", "xyzxyz"]
    dense = X._marks_of(words).vectors
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            x, y = features(a), features(b)
            assert abs(dense[i] @ dense[j] - sum(v * y.get(k, 0) for k, v in x.items())) < 1e-6


def test_filtered_keeps_clean_documents(make_docs, model, corpus):
    rows, labels = corpus
    docs = make_docs(rows, extra=True)
    got = X.filtered(docs, model)
    assert got.columns == docs.columns
    kept = {r.doc_id for r in got.collect()}
    toxic = {i for i, t in labels if t and i is not None}
    assert not kept & toxic and len(kept) == len(rows) - len(toxic)


def test_without_labels(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    model = X.fitted(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in X.scores(docs, model).collect()] == [0.0, 0.0]
    assert X.scores(make_docs([]), model).count() == 0


def test_folded_weights_give_the_decision_values(spark, monkeypatch):
    """Margins of words and passages by triple weights are those of the SVM on kernels with the landmarks."""
    kept = {}
    hinge = X._squared_hinge

    def seen(x, y, share, free):
        kept["x"], kept["w"] = x, hinge(x, y, share, free)
        return kept["w"]

    monkeypatch.setattr(X, "_squared_hinge", seen)
    bad = [(w, 3.0) for w in INSULTS]
    good = [(w, 2.0) for w in ("blossom", "ninepins", "scout", "dimmer", "table", "a")]
    passages = [(["you", "utter", "dimwit"], 1), (["a", "table", "for", "two"], 0), (["scout"], 0)]
    model = X._fit(bad, good, passages)
    want = kept["x"] @ kept["w"]
    words = [w for w, _ in bad + good]
    assert np.allclose(model.margins(words), np.maximum(want[: len(words)], X.LEAST), atol=1e-4)
    model.learn(w for p, _ in passages for w in p)
    got = [float(model.passage_margins(p)[0]) for p, _ in passages]
    assert np.allclose(got, want[len(words) :], atol=1e-3)
    # the kernel with the landmarks, worked out the long way
    z = X._marks_of([w for w, _ in (bad + good)]).vectors
    assert np.allclose(kept["x"][: len(words), :-2] @ kept["x"][: len(words), :-2].T, z @ z.T, atol=1e-3)


def test_passages_cover_all_words():
    for n in range(80):
        spans = X.passages_of(n)
        assert {i for a, b in spans for i in range(a, b)} == set(range(n))
        assert all(0 < b - a <= X.PASSAGE for a, b in spans) and len(set(spans)) == len(spans)


def test_very_long_texts(make_docs, model, pool):
    clean = " ".join(pool(30_000, 31))
    rows = [(1, clean), (2, clean + " nincompoop scoundrel nincompoop"), (3, "x" * 300_000), (4, "n i n c o m p o o p " * 5000)]
    got = {r.doc_id: r.predicted for r in X.scores(make_docs(rows), model).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}


def test_what_stands_behind_a_piece_is_learned(spark, make_docs, pool):
    """What is toxic in a long word's second piece is among the training strings."""
    tail = "nincompoopblockheadscoun"
    assert len(tail) == X.PIECE
    rows = [(i, " ".join(pool(30, 900 + i)) + (" " + "".join(pool(12, i))[: X.PIECE] + tail if i % 5 == 0 else "")) for i in range(300)]
    got = X.fitted(make_docs(rows), spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int"))
    assert got.margins([tail])[0] > 0.5 > max(got.margins(pool(20, 4)))


def test_long_words_are_read_whole(model):
    assert model.margins(["x" * 500 + "blockhead" + "y" * 500])[0] > model.margins(["x" * 1000])[0]
