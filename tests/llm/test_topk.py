"""Exact top-k against brute force."""

from __future__ import annotations

import numpy as np

from cardlake.llm import topk as K


def brute(rows, every=20, k=20):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(64 * np.float64(np.float32(x)))) for x in v)
        good[i] = min(good.get(i, q), q)
    out = []
    for i in sorted(good):
        if i % every == 0:
            hits = sorted(((-sum(a * b for a, b in zip(good[i], w)), j) for j, w in good.items() if j != i and len(w) == len(good[i])))[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(hits, 1)]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    return sorted(tuple(r) for r in K.top_k(df, **kw).select("query_id", "rank", "vec_id", "score").collect())


def test_clusters_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(K, "LEAST_SHARDS", 5)
    monkeypatch.setattr(K, "CELL_SHARDS", 2)
    monkeypatch.setattr(K, "CELL_QUERIES", 4)
    monkeypatch.setattr(K, "LEAF", 8)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), (centres[i % 6] + 0.2 * rng.normal(size=8)).tolist()) for i in range(500)]
    rows += [(int(i), [0.5] * 8) for i in range(1000, 1300)]  # a large group of equal vectors
    assert run(spark, rows) == brute(rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, []), (None, [1.0, 1.0]),
            (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.5]), (120, [1.0, 2.0, 3.0]), (-20, [0.1, 0.1])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


def test_large_components_are_exact(spark):
    rows = [(i, [float(2 ** 21 + i), float(-(2 ** 21) + 3 * i)]) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_bounds_hold(monkeypatch):
    monkeypatch.setattr(K, "LEAF", 16)
    rng = np.random.default_rng(2)
    v = rng.integers(-50, 50, (400, 6)).astype(float)
    t = K.KdTree(np.arange(400), v)
    q = rng.integers(-50, 50, (10, 6)).astype(float)
    bounds = t.bounds(q)
    for node, (a, b) in enumerate(t.span):
        assert ((t.vectors[a:b] @ q.T).max(0) <= bounds[:, node]).all()
    assert sorted(t.ids) == list(range(400))
