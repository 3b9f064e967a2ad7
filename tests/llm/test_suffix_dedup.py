"""Suffix arrays against sorting, repeated bytes against all windows."""

from __future__ import annotations

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stonefly.llm.paragraph_dedup import remove_paragraphs
from stonefly.llm.suffix_dedup import remove_repeats, settle_sides, suffix_array


@given(st.lists(st.integers(1, 3), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array(letters):
    text = [*letters, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, length):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 90))) for _ in range(20)]
    rows = []
    for i in range(150):
        t = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(t) + 1)
            t = rng.choice([t[:k] + rng.choice("xyz ") + t[k + 1 :], t[k:], t[:k], t[:k] + rng.choice(base)[: rng.randint(50, 300)] + t[k:]])
        rows.append((i, t))
    return [*rows, (None, base[0]), (1000, None), (1001, ""), (1002, "a" * 500), (1003, "ab" * 300), (1004, "a" * 99), (1005, "a" * 100), (1006, "b" * 100)]


@pytest.mark.parametrize("most_sides", [20_000, 2])
def test_repeated_bytes(spark, most_sides):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, d string, h int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(spark, df, most_sides=most_sides).collect()}
    assert got == brute(rows, 100)


def test_repeated_rows_count_once(spark):
    text = "".join(random.Random(1).choices("abcdefgh", k=400))
    df = spark.createDataFrame([(1, text), (1, text), (2, text[50:] + "zz")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.kept_text) for r in remove_repeats(spark, df, with_text=True).collect())
    assert got == [(1, 0, text), (1, 0, text), (2, 350, "zz")]


def test_rows_without_id_are_told_apart(spark):
    passage = " ".join("".join(random.Random(k).choices("abcdefgh", k=7)) for k in range(20))
    texts = spark.range(12_000).select(F.concat(F.lit(passage + "\n"), F.col("id").cast("string")).alias("text"))
    low = texts.withColumn("x", F.xxhash64("text").bitwiseAND((1 << 23) - 1)).groupBy("x").agg(F.sort_array(F.collect_list("text")).alias("same"))
    pair = low.filter("size(same) > 1").orderBy("x").first().same[:2]
    df = spark.createDataFrame([(None, x) for x in pair], "doc_id long, text string")
    assert sorted(r.n_removed for r in remove_repeats(spark, df).collect()) == [0, len(os.path.commonprefix(pair))]
    assert sorted(r.n_removed for r in remove_paragraphs(spark, df).collect()) == [0, 1]


def test_many_sides_go_out_while_read():
    taken, windows, marks = 0, set(), 0

    def batches():
        nonlocal taken
        for k in range(24):
            taken += 1
            n = np.arange(1000) + 1000 * k
            sides = [b"s" * 20 if k == 0 else int(i).to_bytes(20) for i in n]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(1000, np.int64)), *(pa.array(x) for x in (n, n, np.full(1000, 100))), *(pa.array(np.zeros(1000, np.int8)) for _ in range(2)), pa.array(sides, pa.binary())], names=["key", "d", "x", "p", "lo", "hi", "sides"])

    for out in settle_sides(batches(), 100, 10):
        kind, d = (out.column(k).to_numpy() for k in ("kind", "d"))
        windows |= set(d[kind == 3].tolist())
        marks += int((kind == 1).sum())
        assert 1000 * taken - len(windows) <= 1000 + 5200
    assert windows == {0, *range(1000, 24_000)} and marks == 999


def test_empty(spark):
    assert remove_repeats(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0
