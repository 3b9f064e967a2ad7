"""Vantage-point trees against brute force."""

from __future__ import annotations

import numpy as np

from stonefly.llm.vptree import Tree, nearest


def brute(rows, k, every=100):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        own = next(v for i, v in usable if i == q)
        near = sorted((float(np.sqrt(((v - own) ** 2).sum())), i) for i, v in usable if i != q and len(v) == len(own))
        out += [(q, r + 1, i) for r, (_, i) in enumerate(near[:k])]
    return out


def test_exact_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(0, 3, 4).astype(float).tolist()) for i in range(400)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(400, 600)]
    rows += [(700, None), (800, [0.0] * 4), (900, [1.0, None, 0.0, 0.0]), (1000, [float("nan"), 1.0, 0.0, 0.0]), (1100, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0] * 4), (1200, [1.0, 2.0]), (1201, [1.0, 2.5]), (1300, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, shard string")
    got = nearest(df, k=7, shard_rows=90, block_rows=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == brute(rows, 7)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(100, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id, r.score) for r in nearest(df).collect()] == [(100, 1, 1.0)]
    assert nearest(df.limit(0)).count() == 0


def test_factor_trades_recall_for_work():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(3000, 6))
    asked = rng.normal(size=(40, 6))
    own = np.full(40, -1)
    exact = Tree(points, np.arange(3000)).search(asked, own, 10, 1.0)[1]
    truth = np.argsort(((asked[:, None] - points[None]) ** 2).sum(-1), axis=1)[:, :10]
    assert (np.sort(exact, axis=1) == np.sort(truth, axis=1)).all()
    loose = Tree(points, np.arange(3000)).search(asked, own, 10, 0.5)[1]
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(loose, truth, strict=True)])
    assert 0.5 < recall <= 1.0
