"""Clustering with a tree over the centroids against all distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from stonefly.llm import tree_kmeans as tk


def plainly(rows, clusters, rounds, size, seed="2:"):
    """Every distance, in Python's integers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [list(v) for _, v in sorted(kept, key=key)[:clusters]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((dist(v, c), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        for k, vs in own.items():
            centres[k] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    last = [(i, near(v)) for i, v in kept]
    total = {}
    for _, (d, k) in last:
        total[k] = total.get(k, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, k, d, total[k], sum(total.values()), sha[k]) for i, (d, k) in last]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize(("size", "levels", "n"), [(2, 3, 300), (4, 40, 500), (8, 2, 400)])
def test_equals_all_distances_with_many_ties(spark, monkeypatch, size, levels, n):
    monkeypatch.setattr(tk, "ROWS", 37)
    rng = np.random.default_rng(size)
    rows = [(i, (rng.integers(-levels, levels, size) / 2).tolist()) for i in range(n)]
    rows += [(7, rows[7][1]), (None, [0.5] * size), (None, [0.25] * size), (None, None), (900, None), (901, [1.0] * (size + 1)), (902, [1.0] * (size - 1) + [None]), (903, [float("nan")] + [0.0] * (size - 1)), (904, [float("-inf")] + [0.0] * (size - 1)), (905, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, v int").repartition(5)
    got = tk.cluster_report(spark, df, clusters=23, rounds=3, size=size).collect()
    assert in_order(got) == in_order(plainly(rows, 23, 3, size))


def test_fewer_vectors_than_clusters_empty_and_too_large(spark):
    df = spark.createDataFrame([(1, [0.1, -0.1]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert in_order(tk.cluster_report(spark, df, size=2).collect()) == in_order(plainly(rows, 40, 5, 2))
    assert tk.cluster_report(spark, df.limit(0), size=2).collect() == []
    with pytest.raises(Exception, match="or more in size"):
        tk.cluster_report(spark, spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>"), size=2).collect()


@pytest.mark.parametrize("largest", [300, 1 << 24, tk.LARGEST - 1])
def test_tree_is_exact_and_prunes(largest):
    rng = np.random.default_rng(1)
    centres = rng.integers(-largest, largest + 1, (60, 3))
    centres[10:20] = centres[:10]  # equal centroids: the smaller number must win
    vectors = np.concatenate([rng.integers(-largest, largest + 1, (2000, 3)), centres, (centres[:30] + centres[30:]) // 2])
    number, d, measured = tk.CentroidTree(centres).nearest(vectors)
    exact = ((vectors[:, None].astype(object) - centres[None].astype(object)) ** 2).sum(-1)
    want = [min((x, k) for k, x in enumerate(r)) for r in exact]
    assert list(zip(d.tolist(), number.tolist(), strict=True)) == want
    assert measured < 0.6 * exact.size
