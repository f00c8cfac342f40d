import numpy as np
import pytest

from ticketlens.llm import neighbours as N


def brute(rows, every=20, top=20):
    good = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None for x in v) or not np.isfinite(v).all() or not np.any(v) or len(v) != 8:
            continue
        good.setdefault(i, v)
    ids = np.array(sorted(good))
    x = np.array([np.array(good[i], np.float32).astype(np.float64) for i in ids])
    out = {}
    for k in np.flatnonzero(ids % every == 0):
        s = x @ x[k]
        order = [j for j in np.lexsort((ids, -s)) if j != k][:top]
        out[int(ids[k])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got = out.setdefault(r.query_id, [])
        got.append((r.vec_id, r.score))
        assert r.rank == len(got)
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("vec", "cid", "h1", "rank", "bucket"):
        df = df.withColumn(name, df.vec_id)
    return df


def rows_of(n=900):
    rnd = np.random.default_rng(2)
    rows = [(i, (rnd.normal(size=8) * rnd.uniform(0.2, 3)).tolist()) for i in range(n)]
    hot = rnd.normal(size=8).tolist()
    rows += [(n + i, hot) for i in range(n // 3)]  # one vector of a quarter of all rows
    rows += [(10_000, None), (10_020, []), (10_040, [0.0] * 8), (10_060, [1.0, None] + [0.0] * 6), (10_080, [float("nan")] * 8)]
    rows += [(10_100, [float("inf")] * 8), (10_120, [1.0] * 3), (None, [1.0] * 8), rows[0], rows[20]]
    return rows


def test_recall_and_exactness(spark):
    rows = rows_of()
    want, got = brute(rows), found(N.nearest(frame(spark, rows)))
    assert set(got) == set(want)
    hit = total = 0
    for q, own in want.items():
        exact = dict(brute(rows, 1, len(rows)).get(q)) if q in (0, 20) else None
        assert len(got[q]) == len(own)
        assert [(-s, i) for i, s in got[q]] == sorted((-s, i) for i, s in got[q])
        if exact:
            assert all(abs(exact[i] - s) < 1e-9 for i, s in got[q])
        kth = own[-1][1] - 1e-9
        hit += sum(s >= kth for _, s in got[q])
        total += len(own)
    assert hit / total >= 0.9


def test_equal_vectors_give_the_smallest_ids(spark):
    rows = [(i, [1.0] * 8) for i in range(0, 200, 5)]
    got = found(N.nearest(frame(spark, rows)))
    for q, own in got.items():
        assert [i for i, _ in own] == [i for i in range(0, 200, 5) if i != q][:20]


@pytest.mark.parametrize("n", [1, 2, 15])
def test_few_rows(spark, n):
    rows = [(20 * i, np.eye(8)[i % 8].tolist()) for i in range(n)]
    got = found(N.nearest(frame(spark, rows)))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in brute(rows).items() if v}


def test_empty(spark):
    assert N.nearest(frame(spark, [])).count() == 0
    assert N.nearest(frame(spark, [(1, [1.0] * 8)])).count() == 0


def test_visits_come_by_chance():
    h = N.Hashing(8, 5000, 1.0, 0.6)
    q = np.random.default_rng(1).normal(size=8)
    x = q / np.linalg.norm(q)
    visited = h.visits(q, 0)
    assert len(set(visited.tolist())) == len(visited)
    assert h.buckets(x[None], 0)[0] in visited[:3]


@pytest.mark.parametrize("n", [20_000, 50_000_000])
def test_lists_reach_the_target(n):
    """A table's list holds the bucket of a neighbour at the radius as often as asked for, however many vectors there are."""
    h = N.Hashing(64, n, 1.0, 1.1)
    rnd = np.random.default_rng(4)
    hit = []
    for _ in range(8):
        q, u = rnd.normal(size=64), rnd.normal(size=(200, 64))
        q /= np.linalg.norm(q)
        u -= (u @ q)[:, None] * q
        u /= np.linalg.norm(u, axis=1)[:, None]
        cos = 1 - 1.1**2 / 2
        for t in range(h.tables):
            hit.append(np.isin(h.buckets(cos * q + np.sqrt(1 - cos * cos) * u, t), h.visits(q, t)).mean())
    assert np.mean(hit) >= h.each - 0.08


def test_queries_with_few_candidates_are_compared_with_all(spark):
    rnd = np.random.default_rng(3)
    rows = [(5 * i, rnd.normal(size=8).tolist()) for i in range(30)]
    got, want = found(N.nearest(frame(spark, rows), target=0.01)), brute(rows)
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(want, 20)
    assert sum([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want) >= len(want) - 1


def test_recall_on_the_given_vectors(spark):
    """Vectors of 64 components without much structure, all of them against brute force."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in df.collect())
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    got = found(N.nearest(df))
    hit = total = 0
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        kth = np.sort(s)[-20] - 1e-9
        own = got[int(ids[k])]
        assert len(own) == 20
        hit += sum(v >= kth for _, v in own)
        total += 20
    assert hit / total >= 0.95


def rows_shuffled(spark, n):
    """Rows of both sides that reach the units, for ``n`` vectors around centres."""
    import unittest.mock as mock

    rnd = np.random.default_rng(n)
    centres = rnd.normal(size=(40, 8)) * 4
    rows = [(i, (centres[i % 40] + 0.05 * rnd.normal(size=8)).tolist()) for i in range(n)]
    counts = []
    streamed = N._streamed

    def counted(data, asks, top):
        counts.append((data.count(), asks.count()))
        return streamed(data, asks, top)

    with mock.patch.object(N, "_streamed", counted):
        N.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count()
    return counts


def test_vectors_are_shuffled_once_a_table(spark, monkeypatch):
    """However many queries there are, a vector goes to one unit of each table."""
    monkeypatch.setattr(N, "UNIT", 128)
    for n in (500, 1000, 2000):
        for data, _ in rows_shuffled(spark, n)[:1]:
            assert data == N.TABLES * n
