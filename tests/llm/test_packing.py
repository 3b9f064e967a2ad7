"""Bin-completion packing against brute force and on awkward tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stonefly.llm import packing
from stonefly.llm.tokens import word_tokenizer


@cache
def fewest(items: tuple[int, ...], capacity: int) -> int:
    """Least number of bins by trying every filling around the largest item."""
    if not items:
        return 0
    first, rest = items[0], items[1:]
    best = len(items)

    def fill(i: int, room: int, left: list[int]) -> None:
        nonlocal best
        if i == len(rest):
            best = min(best, 1 + fewest(tuple(left), capacity))
            return
        if rest[i] <= room:
            fill(i + 1, room - rest[i], left)
        fill(i + 1, room, [*left, rest[i]])

    fill(0, capacity - first, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_fewest_bins(seed):
    rng = random.Random(seed)
    items = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
    patterns, proven = packing.bin_completion(dict(Counter(items)), 20)
    used = Counter()
    for pattern, times in patterns:
        assert sum(k * n for k, n in pattern) <= 20
        for k, n in pattern:
            used[k] += n * times
    assert used == Counter(items)
    number = sum(n for _, n in patterns)
    assert number == fewest(tuple(items), 20)
    assert not proven or number == packing.lower_bound(dict(Counter(items)), 20)


def test_better_than_best_fit():
    counts = {8: 1, 6: 1, 5: 2, 3: 1, 2: 4}
    assert sum(n for _, n in packing.best_fit_decreasing(counts, 12)) == 4
    assert sum(n for _, n in packing.bin_completion(counts, 12)[0]) == 3


def test_search_beats_best_fit_on_thousands_of_pieces():
    counts = {8: 900, 6: 900, 5: 1800, 3: 900, 2: 3600}  # 8,100 pieces
    plain = sum(n for _, n in packing.best_fit_decreasing(counts, 12))
    patterns, _ = packing.bin_completion(counts, 12)
    number = sum(n for _, n in patterns)
    assert packing.lower_bound(counts, 12) <= number < plain
    used = Counter()
    for pattern, times in patterns:
        assert sum(k * n for k, n in pattern) <= 12 and times > 0
        for k, n in pattern:
            used[k] += n * times
    assert used == Counter(counts)


def test_search_on_many_lengths_stays_small():
    """Where best-fit isn't at the bound and lengths are many, the search ends, holds one path, and isn't worse."""
    import tracemalloc
    rng = random.Random(7)
    counts = Counter(rng.randint(700, 2400) for _ in range(5000))
    tracemalloc.start()
    patterns, _ = packing.bin_completion(dict(counts), 4096, nodes=300)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 << 20
    assert packing.lower_bound(dict(counts), 4096) <= sum(n for _, n in patterns) <= sum(n for _, n in packing.best_fit_decreasing(dict(counts), 4096))
    assert sum(n * t for pattern, t in patterns for _, n in pattern) == 5000


def test_bad_length():
    with pytest.raises(ValueError):
        packing.bin_completion({5: 1}, 4)


def test_documents(spark):
    rows = [(1, "a cat sat on the mat", "x"), (2, None, "x"), (3, "", "x"), (4, "word " * 9000, "x"), (4, "word " * 9000, "x"), (None, "Don't!", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    layout = packing.pack_documents(spark, docs, word_tokenizer(), with_ids=True)
    got = layout.collect()
    library = Tokenizer.from_file(word_tokenizer())
    want = Counter()
    for doc_id, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4").tobytes()
            want[doc_id, k // 4096, k, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    ends = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 4096
    assert len(ends) == -(-sum(ends.values()) // 4096)
    whole = {r.sequence_id: r for r in packing.sequences(layout).collect()}
    assert {k: r.n_tokens for k, r in whole.items()} == dict(ends)
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole.values())
    assert packing.packing_summary(layout, 4096) == (len(ends), len(ends))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(spark, docs, word_tokenizer()).count() == 0


def test_common_length_is_dealt_in_buckets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    got = packing.pack_documents(spark, docs, word_tokenizer()).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.countDistinct("offset").alias("k"), F.count("*").alias("m")).collect()
    assert len(got) == 3 and all(r.n <= 4096 and r.k == r.m for r in got)
