import math
import random

import numpy as np
import pytest

from tarmac.llm import topk


def brute(rows, asked, k, scale=256.0):
    take = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    known = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and take(v)]
    out = []
    for q, v in [(i, [math.floor(scale * x) for x in v]) for i, v in asked if i is not None and take(v)]:
        scores = sorted(((-sum(a * b for a, b in zip(u, v)), i) for i, u in known if i != q))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 200)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 60)
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-1.5, -0.25, 0.0, 0.001, 0.5, 2.0]) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(40)]  # ties
    rows += [(2000, None), (2001, [0.1, None]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, [1.0] * 6), (2004, [3.0]), (2005, []), (7, [9.0] * 6)]
    frame = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(3)
    asked = frame.where("vec_id % 7 = 0 OR vec_id IS NULL OR vec_id >= 1035")
    found = topk.top_k(frame, asked, 5).collect()
    again = [(i, v) for i, v in rows if i is None or i % 7 == 0 or i >= 1035]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute(rows, again, 5)


def test_few_and_no_candidates(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id, r.score) for r in topk.top_k(frame, frame.where("vec_id = 1"), 5).collect()] == [(1, 2, 256 * 128 + 512 * 128)]
    assert topk.top_k(frame.where("vec_id = 1"), frame.where("vec_id = 1"), 5).collect() == []
    assert topk.top_k(frame.limit(0), frame, 5).collect() == []
    assert topk.top_k(frame, frame.limit(0), 5).collect() == []


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(0)
    vectors, queries = rng.integers(-50, 50, (64, 5)), rng.integers(-50, 50, (9, 5))
    exact = vectors @ queries.T
    lists = topk.SortedLists(vectors)
    positive, negative = np.maximum(queries, 0).T.astype(float), np.minimum(queries, 0).T.astype(float)
    for depth in (1, 2, 7, 30, 64):
        lower, upper = lists.bounds(depth, positive, negative)
        assert (lower <= exact).all() and (exact <= upper).all()
    assert (lower == exact).all()


@pytest.mark.parametrize("large", [[1e300, 1.0], [-1e300, 1.0], [2.0**44, 1.0]])
def test_components_beyond_exact_scores_raise(spark, large):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, large), (3, [2.0**44, 2.0**44])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="smaller scale"):
        topk.top_k(frame, frame, 1).collect()


def clustered(rng, n, dim, many):
    """Vectors around a few far corners."""
    corners = rng.choice([-40, 0, 40], (many, dim))
    return corners[rng.integers(0, many, n)] + rng.integers(-2, 3, (n, dim))


def test_clustered_vectors_are_read_in_part(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 400 * 12)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(clustered(rng, 1200, 12, 40))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    asked = frame.where("vec_id % 60 = 0")
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(frame, asked, 3, scale=1.0).collect())
    assert found == brute(rows, [r for r in rows if r[0] % 60 == 0], 3, 1.0)
    read = topk.entries_read(frame, asked, 3, scale=1.0).collect()
    assert len(read) == 20 and all(r.entries == 1200 * 12 for r in read)
    assert sum(r.read for r in read) < 0.85 * sum(r.entries for r in read)


def test_bars_leave_blocks_unread():
    rng = np.random.default_rng(4)
    low, queries = rng.integers(-5, 5, (200, 6)), rng.integers(1, 9, (5, 6))
    ids = np.arange(200)
    exact = low @ queries.T
    bars = exact.max(0) + 1.0
    q, v, score, read = topk.block_top(ids, low, ids[:5] + 900, queries, 3, np.full(5, 1e6))
    assert len(q) == 0 and not read.any()
    q, v, score, read = topk.block_top(ids, low, ids[:5] + 900, queries, 3, bars - 1.0)
    assert {(a, s) for a, s in zip(q.tolist(), score.tolist())} >= {(i, int(m)) for i, m in enumerate(exact.max(0))}


def test_block_pairs_do_not_pass_through_the_driver(spark, monkeypatch):
    """Queries' blocks look small as compressed files; nothing as large as their pairs with blocks may be broadcast."""
    monkeypatch.setattr(topk, "BLOCK", 400)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 200)
    monkeypatch.setattr(topk, "PAIRS", 20)
    monkeypatch.setattr(topk, "HELD", 4000)
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5]) for _ in range(20)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    limit = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "100k")
    try:
        top = topk.top_k(frame, frame.where("vec_id % 3 = 0"), 4)
        found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top.collect())
    finally:
        spark.conf.set(limit, before)
    assert found == brute(rows, [r for r in rows if r[0] % 3 == 0], 4)
    assert "Broadcast" not in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [3, 1 << 9, 1 << 11, 1 << 25, 1 << 28])
def test_scores_of_every_size_are_exact(size):
    """Products that float32 holds, that float64 holds, and larger ones, with bars from elsewhere and without."""
    rng = np.random.default_rng(size)
    vectors, queries = rng.integers(-size, size + 1, (300, 7)), rng.integers(-size, size + 1, (40, 7))
    vectors[100:160] = vectors[99]  # ties
    ids, query_ids = rng.permutation(300), np.arange(0, 80, 2)
    exact = vectors @ queries.T
    for bars in (None, np.sort(exact[:50], axis=0)[-3].astype(np.float64), np.full(40, -np.inf)):
        q, v, score, _ = topk.block_top(ids, vectors, query_ids, queries, 3, bars)
        found = list(zip(q.tolist(), ids[v].tolist(), score.tolist()))
        assert len(set(found)) == len(found) and (np.diff(q) >= 0).all()
        for j in range(40):
            rows = [i for i in range(300) if ids[i] != query_ids[j]]
            best = sorted(rows, key=lambda i: (-int(exact[i, j]), ids[i]))[:3]
            over = [(j, int(ids[i]), int(exact[i, j])) for i in best if bars is None or exact[i, j] >= bars[j]]
            assert [x for x in found if x[0] == j][: len(over)] == over


@pytest.mark.parametrize("times", [1, 12, 24, 200, 5000])
def test_answers_do_not_outgrow_blocks(times):
    """Parts of the blocks times queries are what is shuffled at the end."""
    vectors, queries = 50_000 * times, 1_000 * times
    of_blocks = {"n": 25 * times, "vectors": vectors, "entries": vectors * 64, "bytes": vectors * 64}
    of_asked = {"n": 2 * times, "vectors": queries, "entries": queries * 64, "bytes": queries * 64}
    through, parts = topk._parts(of_blocks, of_asked, 5, 6)
    assert through * queries * 5 * topk.FOUND <= of_blocks["bytes"]
    assert min(6, 25 * times) <= through * parts <= topk.TASKS + through
    assert (of_asked["bytes"] + queries * 8 * 6) / parts <= topk.HELD or parts == 2 * times
