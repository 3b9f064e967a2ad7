"""Jaccard join and components against brute force."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from stonefly.llm import components
from stonefly.llm.common import run_dir
from stonefly.llm.components import connected, stars
from stonefly.llm.jaccard_tree import SHARED, Entry, similar_documents


def brute(rows):
    sets = {}
    for k, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in sets}


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 6, 20, 40, 150, 300]))] for _ in range(20)]
    rows = []
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(w) // 25))):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, rng.choice([" ", "\n ", "  "]).join(w)))
    return [*rows, (900, None), (901, ""), (902, " \n"), (903, "A"), (904, "a"), (905, "a b c d"), (906, "A b\tc D"), (907, "a b c d e"), (908, "x " * 500)]


@pytest.mark.parametrize("block_nodes", [4096, 4])
def test_components(spark, block_nodes):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(spark, df, block_nodes=block_nodes).collect()}
    assert got == brute(rows)


def near_copies(rng, n, words, changed):
    """A group: each member has some of its words changed, so pairs are about (1 - changed)^10 alike, many below the limit."""
    base = [f"w{k}" for k in range(words)]
    return [" ".join(f"x{rng.randrange(10**6)}" if rng.random() < changed else w for w in base) for _ in range(n)]


def links_by_counts(rows, percent=80):
    """Components by an inverted index and exact counts."""
    from collections import Counter, defaultdict
    sets, where, root = {}, defaultdict(list), {}
    for k, text in rows:
        w = text.split(" ")
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        root[k] = k

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in sorted(sets):
        both = Counter(o for g in sets[k] for o in where[g])
        for o, c in both.items():
            if 100 * c >= percent * (len(sets[k]) + len(sets[o]) - c):
                a, b = find(k), find(o)
                root[max(a, b)] = min(a, b)
        for g in sets[k]:
            where[g].append(k)
    return {k: find(k) for k in sets}


@pytest.mark.parametrize(("changed", "block_nodes"), [(0.012, 4096), (0.03, 4096), (0.03, 300)])
def test_two_thousand_near_copies(spark, changed, block_nodes):
    """Groups at 50 to 85 per cent similarity: components equal brute force, and no step has rows in the order of the pairs."""
    rng = random.Random(int(changed * 1000))
    rows = list(enumerate(near_copies(rng, 2000, 120, changed) + near_copies(rng, 60, 30, 0.02)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in similar_documents(spark, df, block_nodes=block_nodes).collect()}
    assert got == links_by_counts(rows)


def test_entries_send_members_and_forests(spark):
    """An entry of n members that all pass the sketches and don't link sends n rows, then none."""
    rng = random.Random(1)
    sets = [x for x in map(np.unique, (np.concatenate([np.arange(300), rng.sample(range(10**6, 10**7), 100)]) for _ in range(200)))]
    sets = [np.asarray(x, np.uint64) for x in sets]
    own = [np.arange(5, dtype=np.int64)] * 200
    build = lambda token, percent: Entry(token, np.arange(200), np.full(200, 400), np.arange(200), own, sets, percent)
    assert len(build(0, 80).meeting()) == 200 and build(0, 80).links() == []
    assert len(build(1, 80).meeting()) == 0          # every pair belongs to the least token's entry
    assert len(build(0, 50).links()) == 199          # one forest
    assert SHARED <= 96


def test_null_and_repeated_ids(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(None, text), (7, text), (7, text), (7, "other words stand here now"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in similar_documents(spark, df).collect() if r.n_shingles)
    assert got == [(0, 3, 7), (7, 1, 7), (7, 3, 7), (7, 3, 7)]


def test_empty(spark):
    assert similar_documents(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.root for r in connected(df, run_dir(spark, "test")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {300: 300, 301: 300}


def test_stars_of_random_links():
    rng = random.Random(3)
    for _ in range(60):
        links = [(rng.randrange(30), rng.randrange(30)) for _ in range(rng.randint(1, 40))]
        root = {k: k for link in links for k in link}
        for _ in root:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        u, v = stars(*np.array(links).T)
        assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {k: x for k, x in root.items() if k != x}


@pytest.mark.parametrize("chunk", [7, 60, 1 << 21])
def test_components_over_many_tasks(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK", chunk)
    rng = random.Random(6)
    order = list(range(300))
    rng.shuffle(order)
    links = list(zip(order[:200], order[1:201], strict=False)) + [(order[0], order[210]), (order[220], order[221])]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "u long, v long").repartition(40)
    got = {r.node: r.root for r in connected(df, run_dir(spark, "test")).collect()}
    one = [*order[:201], order[210]]
    assert got == {k: min(one) for k in one} | {k: min(order[220:222]) for k in order[220:222]}
