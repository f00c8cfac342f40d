"""Exact top-k of keys with many values, and what the first pass sends."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketlens.operators.agg import counts_by, top_k_per
from ticketlens.operators.heavy import candidates, lowered, top_k_heavy

SCHEMA = "file_year int, street string"


def plain(df, k):
    rows = top_k_per(counts_by(df, ["file_year", "street"], "street"), "file_year", "n", k, "street")
    return sorted((tuple(r) for r in rows.select("file_year", "street", "n", "rk").collect()), key=repr)


def heavy(df, k, capacity):
    return sorted((tuple(r) for r in top_k_heavy(df, "street", k, capacity).collect()), key=repr)


def skewed(seed, n=4000, years=(2015, 2016)):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        year = rnd.choice(years)
        out.append((year, rnd.choice([None, f"main {rnd.randrange(6)}", f"s{rnd.randrange(3000)}"])))
    return out


@pytest.mark.parametrize(("seed", "capacity"), [(1, 5), (2, 40), (3, 1024)])
def test_equals_the_plain_form(spark, seed, capacity):
    df = spark.createDataFrame(skewed(seed), SCHEMA).repartition(5)
    assert heavy(df, 5, capacity) == plain(df, 5)


def test_flat_counts_fall_back(spark):
    """No value is heavy: the counters say nothing, and the year is counted in full."""
    rows = [(2015, f"s{i % 700}") for i in range(2100)] + [(2016, f"t{i % 3}") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert heavy(df, 5, 5) == plain(df, 5)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([2015, 2016]), st.sampled_from([None, *"abcdefgh"])), max_size=60), st.integers(1, 4), st.integers(0, 5))
def test_any_rows_with_ties(spark, rows, k, more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert heavy(df, k, k + more) == plain(df, k)


@given(st.dictionaries(st.integers(), st.integers(1, 50), max_size=30), st.integers(1, 10))
def test_lowered_counters_bound_the_counts(counts, capacity):
    kept, cut = lowered(dict(counts), capacity)
    assert len(kept) <= capacity
    for key, n in counts.items():
        assert kept.get(key, 0) <= n <= kept.get(key, 0) + cut
    assert cut * (capacity + 1) <= sum(counts.values())


def test_rare_values_are_not_sent(spark):
    """Rows that leave the first pass are bounded by tasks, years and counters, not by the number of values."""
    rnd = random.Random(5)
    rows = [(2015, f"main {rnd.randrange(4)}" if rnd.random() < 0.5 else f"rare {i}") for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    sent = candidates(df, "street", capacity=50)
    assert sent.count() <= 4 * (50 + 1)
    bound = sum(r["error"] for r in sent.collect())
    low, true = Counter(), Counter(s for _, s in rows)
    for r in sent.where("key IS NOT NULL").collect():
        low[r["key"]] += r["low"]
    assert all(low[s] <= n <= low[s] + bound for s, n in true.items())
    got = top_k_heavy(df, "street", 4, 50)
    assert sorted((r["street"], r["n"]) for r in got.collect()) == sorted(true.most_common(4))
    # the exact pass, too, kept only what the counters left open
    files = got.inputFiles()
    assert files and all("heavy-counts" in f for f in files)
    assert spark.read.parquet(*{f.rsplit("/", 1)[0] for f in files}).count() < 50


def test_edges(spark):
    assert heavy(spark.createDataFrame([], SCHEMA), 3, 5) == []
    only_null = spark.createDataFrame([(2015, None), (2015, None)], SCHEMA)
    assert heavy(only_null, 3, 5) == plain(only_null, 3) == [(2015, None, 0, 1)]
    with pytest.raises(ValueError):
        top_k_heavy(only_null, "street", 5, 4)
