import pytest

from ticketlens.llm import quality as R


def brute(text):
    import re

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    cover = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(cover),
    }


CASES = [
    None, "", " \n\t ", "one", "a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z \n",
    "日本 語 é " * 40, "w" * 100_000, "a b c d " * 6000, "# $ | < > *" * 30, " a b \x0b c\x0cd\r\ne",
]


def test_measurements(make_docs, pool):
    texts = CASES + [" ".join(pool(n, n)) for n in (49, 50, 51, 400)]
    texts += [texts[-1]] + [" ".join(pool(30, 1) * 3)]
    rows = {r.doc_id: r for r in R.judged(R.ledger(make_docs(list(enumerate(texts)), extra=True))).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert {k: rows[i][k] for k in want} == want
        base = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert rows[i].base_failed == base
        assert not (rows[i].kept and base)
        assert base == (rows[i].failed & R.mask(R.POLICIES["base"]) != 0)
    assert rows[len(CASES) + 3].kept


def test_policies_and_ablation(make_docs, pool):
    texts = ["short", " ".join(pool(100, 1)), " ".join(w + "&&&" for w in pool(100, 2)), "x # " * 60, " ".join(pool(100, 3))]
    ledger = R.ledger(make_docs(list(enumerate(texts))))
    rows = ledger.collect()
    for version, rules in R.POLICIES.items():
        whole = R.mask(rules)
        got = {r.rule: (r.n_failed, r.n_only, r.n_first) for r in R.ablation(ledger, version).collect()}
        for name in rules:
            bit = R.mask([name])
            bits = [r.failed & whole for r in rows]
            want = (
                sum(bool(b & bit) for b in bits),
                sum(b == bit for b in bits),
                sum(bool(b) and (b & -b) == bit for b in bits),
            )
            assert got[name] == want


def test_empty(make_docs):
    assert R.judged(R.ledger(make_docs([]))).count() == 0


def test_native(make_docs):
    plan = R.judged(R.ledger(make_docs([(1, "a")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("rule", R.RULES)
def test_mask_is_one_bit(rule):
    assert bin(R.mask([rule])).count("1") == 1
