"""Hidden Markov scoring against all state paths, and a plain Baum-Welch over whole lists of words."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
import xxhash

from stonefly.llm import hidden_markov as hm

SCHEMA = "doc_id long, text string, row string, word int, symbols string"


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in lower.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w] + [None]


def base(docs):
    """Base figures by the contract's words."""
    out = zlib.crc32
    held = lambda i: i is not None and out(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in docs if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    rows = []
    for i, t in docs:
        own = tokens(t)
        rows.append((i, held(i), len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)))
    return rows, c


def path_sums(model, symbols, first):
    """Likelihood, and expected emissions, moves and first states, by all paths of states."""
    k = len(model.move)
    like, emit, move, start = 0.0, np.zeros_like(model.emit), np.zeros_like(model.move), np.zeros(k)
    for path in product(range(k), repeat=len(symbols)):
        p = first[path[0]] * model.emit[symbols[0], path[0]]
        for t in range(1, len(path)):
            p *= model.move[path[t - 1], path[t]] * model.emit[symbols[t], path[t]]
        like += p
        start[path[0]] += p
        for t, s in enumerate(path):
            emit[symbols[t], s] += p
            if t:
                move[path[t - 1], s] += p
    return like, emit / like, move / like, start / like


def random_model(rng, symbols, states):
    normal = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hm.Model(normal(rng.random((symbols, states)) + 0.01, 0), normal(rng.random((states, states)) + 0.01, 1), normal(rng.random(states), 0), normal(rng.random(states), 0))


def test_recursions_equal_all_paths():
    rng = np.random.default_rng(0)
    model = random_model(rng, 5, 3)
    rows = [rng.integers(0, 5, n).astype(np.int32) for n in (6, 1, 4, 4, 2, 6, 1)]
    flat, sizes = np.concatenate(rows), np.array([len(x) for x in rows])
    group = hm.Group(flat, np.cumsum(sizes) - sizes, sizes)
    ll = np.zeros(len(rows))
    ll[group.order] = hm.forward(model, group, model.start, False)[0]
    want = [path_sums(model, r, model.start) for r in rows]
    assert np.allclose(ll, [math.log(x[0]) for x in want], rtol=1e-12)
    emit, move, firsts, total = hm.expected(model, group, np.tile(model.start, (len(rows), 1)))
    assert np.allclose(emit, sum(x[1] for x in want)) and np.allclose(move, sum(x[2] for x in want))
    assert np.allclose(firsts.sum(axis=0), sum(x[3] for x in want)) and math.isclose(total, ll.sum())


def plain_scores(docs, states, rounds, symbols_most, piece, prior):
    """The whole method with Python lists: no batches, partitions, lookup table or join."""
    figures, c = base(docs)
    n, v = sum(c.values()), len(c)
    words = [w for w in c if w is not None]
    steps = Counter(math.floor(math.log2(c[w]) * 16) for w in words)
    least, total = math.inf, 0
    for s in sorted(steps, reverse=True):
        total += steps[s]
        if total > symbols_most:
            break
        least = s
    key = lambda w: xxhash.xxh3_64_intdigest(w) - ((xxhash.xxh3_64_intdigest(w) >> 63) << 64)
    own = sorted((w for w in words if math.floor(math.log2(c[w]) * 16) >= least), key=key)
    place = {w: k for k, w in enumerate(own)}
    rare_n, rare_v = n - c[None] - sum(c[w] for w in own), v - 1 - len(own)
    symbol = lambda w: len(own) + 1 if w is None else place.get(w, len(own))
    vocab = hm.Vocabulary(n, v, np.array([key(w) for w in own], np.int64), np.array([c[w] for w in own], np.int64), np.arange(len(own), dtype=np.int32), len(own), c[None])
    model, shares = hm.first_model(vocab, states), vocab.shares()
    assert math.isclose(shares.sum(), 1) and math.isclose(shares[len(own)], (rare_n + 0.5 * (rare_v + 1)) / (n + 0.5 * (v + 1)))
    train = [[symbol(w) for w in tokens(t)] for (i, t), f in zip(docs, figures, strict=True) if not f[1]]
    for _ in range(rounds):
        emit, move, first, again = np.zeros_like(model.emit), np.zeros_like(model.move), np.zeros(states), np.zeros(states)
        for text in train:
            for a in range(0, len(text), piece):
                o = text[a : a + piece]
                begin = model.again if a else model.start
                f = [begin * model.emit[o[0]]]
                for s in o[1:]:
                    f.append(f[-1] @ model.move * model.emit[s])
                b = [np.ones(states)]
                for s in o[:0:-1]:
                    b.insert(0, model.move @ (model.emit[s] * b[0]))
                like = f[-1].sum()
                for t, s in enumerate(o):
                    emit[s] += f[t] * b[t] / like
                    if t:
                        move += f[t - 1][:, None] * model.move * (model.emit[s] * b[t])[None] / like
                if a:
                    again += f[0] * b[0] / like
                else:
                    first += f[0] * b[0] / like
        model = hm.maximised({"emit": emit, "move": move, "start": first, "again": again}, shares, prior)
    scores = []
    for _, t in docs:
        o, p = [symbol(w) for w in tokens(t)], 0.0
        f = model.start * model.emit[o[0]]
        for s in o[1:]:
            p, f = p + math.log(f.sum()), f / f.sum() @ model.move * model.emit[s]
        p += math.log(f.sum())
        p += sum(math.log((c[w] + 0.5) / (rare_n + 0.5 * (rare_v + 1))) for w in tokens(t) if symbol(w) == len(own))
        scores.append(p / LN10)
    return [(*f, s) for f, s in zip(figures, scores, strict=True)]


LN10 = math.log(10)


def some_docs(rng, n=80):
    common, other = [f"w{k}" for k in range(12)], [f"V{k}é" for k in range(60)]
    docs = [(i, " ".join(rng.choice(common if rng.random() < 0.7 else other) for _ in range(int(rng.integers(0, 9))))) for i in range(n)]
    return docs + [(200, None), (201, ""), (None, "w1 w2"), (None, None), (5, docs[5][1]), (5, "w3 w3"), (202, "only\there\x0bnever \n W1"), (203, "\xa0 w1\x85w2")]


@pytest.mark.parametrize(("symbols", "lookup", "group"), [(10, 20, 16), (4, 4, 1 << 19), (1000, 1000, 40)])
def test_whole_method_equals_a_plain_one(spark, monkeypatch, symbols, lookup, group):
    monkeypatch.setattr(hm, "GROUP", group)
    monkeypatch.setattr(hm, "HELD_WORDS", 5)
    docs = some_docs(np.random.default_rng(symbols))
    df = spark.createDataFrame([(i, t, "a", 1, "b") for i, t in docs], SCHEMA).repartition(4)
    got = hm.hidden_markov_scores(spark, df, states=3, rounds=3, symbols=symbols, lookup=lookup, piece=4, prior=2.0).collect()
    want = plain_scores(docs, 3, 3, symbols, 4, 2.0)
    order = lambda rows: sorted(map(tuple, rows), key=lambda r: (str(r[0]), round(r[5], 6), round(r[6], 6)))
    got, want = order(got), order(want)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_probabilities_of_all_next_words_add_up_to_one(spark):
    """Within the common symbol, and over all symbols, nothing is lost: known words and one new word share it all."""
    counts = {b"a": 5, b"b": 4, b"c": 1, b"d": 1}
    vocab = hm.Vocabulary(11 + 3, 5, np.array([1, 2], np.int64), np.array([5, 4], np.int64), np.array([0, 1], np.int32), 2, 3)
    assert math.isclose(vocab.shares().sum(), 1)
    assert math.isclose(sum(math.exp(vocab.within_rare(counts[w])) for w in (b"c", b"d")) + math.exp(vocab.within_rare(0)), 1)
    assert math.isclose(sum(math.exp(vocab.unigram(x)) for x in (5, 4, 1, 1, 3)) + math.exp(vocab.unigram(0)), 1)


def test_nothing_to_learn_from_and_empty(spark):
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    df = spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")
    got = hm.hidden_markov_scores(spark, df).collect()
    assert {tuple(r)[1:] for r in got} == {(True, 3, 0, 0, 0.0, 0.0)} and len(got) == len(held)
    assert hm.hidden_markov_scores(spark, df.limit(0)).collect() == []


def test_long_text_and_log_likelihood_rises(spark, monkeypatch):
    monkeypatch.setattr(hm, "GROUP", 1000)
    rng = np.random.default_rng(5)
    text = " ".join(rng.choice([f"x{k}" for k in range(50)], 20_000))
    docs = [(0, text), (2, "x1 x2 x3")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in hm.hidden_markov_scores(spark, df, states=2, rounds=2, piece=64, prior=1.0).collect()}
    want = {r[0]: r for r in plain_scores(docs, 2, 2, 1 << 15, 64, 1.0)}
    assert all(math.isclose(got[i].score, want[i][6], rel_tol=1e-9) and got[i].n_tokens == want[i][2] for i in (0, 2))


def test_training_raises_the_likelihood_and_beats_single_words(spark):
    rows = hm.hidden_markov_scores(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > 0.97 * rows["sum(base_score)"]
