import random

import corpus_pipeline as P
from ticketlens.llm import mixing, near, secrets
from ticketlens.llm.base import table


def test_stages_in_turn(spark, sf_dir):
    docs = before = table(spark, sf_dir, "documents")
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == before.columns, name
        after = P.written(after, name)
        if name == "near_dedup":
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in near.groups(docs, P.NEAR_RUN, P.NEAR_PERCENT).where("kept").collect()}
        if name in ("secrets", "mixing"):
            assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in docs.collect())
        if name == "secrets":
            assert secrets.scanned(after, None).where("n_hex + n_access > 0").count() == 0
        if name == "mixing":
            want = [r.doc_id for r in mixing.scheduled(docs).orderBy("slot", "in_block").collect()]
            assert [r.doc_id for r in mixing.mixed(docs).collect()] == want
        docs = after
    last = P.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(last) == docs.count() and all(r.lossless for r in last)


def test_near_copies_by_five_words_and_four_fifths(spark, sf_dir, make_docs, pool):
    """The stage against all pairs: passages put in or cut, and scattered changes, about a similarity of 0.8."""
    rnd = random.Random(5)
    texts = []
    for g in range(40):
        words = pool(300, 500 + g)
        other = list(words)
        if g % 2:
            at = rnd.randrange(300)
            other[at:at] = pool(45 + g, 700 + g)
        else:
            for at in range(20, 300, 280 // (4 + g // 4)):
                other[at] = f"new{at}"
        texts += [" ".join(words), " ".join(other)]
    sets = [set(zip(*(w[k:] for k in range(5)), strict=False)) for w in (t.split() for t in texts)]
    dropped, near_limit = set(), 0
    for i in range(1, len(texts), 2):
        alike = len(sets[i] & sets[i - 1]) / len(sets[i] | sets[i - 1])
        near_limit += 0.8 <= alike < 0.85
        if alike >= 0.8:
            dropped.add(i)
    assert near_limit >= 5 and 5 <= len(dropped) <= 35
    got = P.near_dedup_stage(spark, make_docs(list(enumerate(texts))), sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(range(len(texts))) - dropped)


def test_the_mix_outlasts_files(spark, sf_dir, make_docs):
    """Positions of the encoded corpus are those of the mix, from files in any order."""
    sizes = {"a": 700, "b": 150, "c": 40, None: 10}
    rows = [(k, f"text {k}", s) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = make_docs(rows + rows[:1] + [(None, None, "a")])
    order = [r.doc_id for r in mixing.mixed(docs).collect()]
    read = P.written(P.mixing_stage(spark, docs, sf_dir).repartition(7), "several")
    assert len(read.inputFiles()) > 1 and [r.doc_id for r in read.collect()] != order
    got = sorted(P.encoding_stage(spark, read, sf_dir).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(order))) and [r.doc_id for r in got] == order
    slots = {(r.doc_id, r.slot, r.in_block) for r in mixing.scheduled(docs).collect()}
    assert {(r.doc_id, r.slot, r.in_block) for r in got} == slots


def test_run(spark, sf_dir):
    assert P.run(spark, sf_dir).where("lossless").count() > 0


def test_awkward_documents(spark, sf_dir, make_docs):
    docs = make_docs([(None, None), (1, None), (1, ""), (2, "a b"), (2, "a b"), (3, "é " * 20_000)], extra=True)
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert "slot" in docs.columns, name
    assert P.STAGES[-1][1](spark, docs, sf_dir).count() >= 5


def test_empty(spark, sf_dir, make_docs):
    docs = make_docs([])
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
