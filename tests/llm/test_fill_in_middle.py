"""Fill-in-middle against string slicing, and the exact round trip."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from stonefly.llm import fill_in_middle as fim
from stonefly.llm.common import text_buffers


def plainly(doc_id, text, plain=10, spm=20):
    """One document by the contract's words."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


TEXTS = [None, "", "a", "ab cd", "<P>", "x<S>y", "q <M", "<", ">", "<P", "P>", "S>tail <", "Grüße, 世界!\n\ttwo lines", "\x00\x7f null bytes", "😀😀 emoji 😀", "aaa" * 50, "<<PP>>" * 9, "é" * 30, "1 2 3"]


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_equals_slicing(spark, monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    rng = np.random.default_rng(3)
    letters = list("ab <>PSM\né世😀1")
    texts = TEXTS + ["".join(rng.choice(letters, int(rng.integers(0, 40)))) for _ in range(400)]
    ids = list(range(len(texts)))
    column = pa.array(texts, pa.string())
    raw, offsets = text_buffers(column)
    drawn = np.array([[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)] for i in ids])
    got = fim.scatter(raw, offsets, drawn)
    outputs = fim.string_array(got["raw"], got["offsets"], pa.large_string()).to_pylist()
    for i, text in zip(ids, texts, strict=True):
        n, form, pre, mid, output = plainly(i, text)
        assert (got["n"][i], fim.FORMS[int(got["form"][i])].as_py(), outputs[i]) == (n, form, output)
        if form != "plain":
            assert (got["prefix_chars"][i], got["middle_chars"][i]) == (pre, mid)
    back, at = fim.gather(got["raw"], got["offsets"], got["form"])
    assert fim.string_array(back, at, pa.large_string()).to_pylist() == [x or "" for x in texts]


def test_query_rows_null_ids_repeats_and_clashing_names(spark):
    rows = [(i, t, "o", "r") for i, t in enumerate(TEXTS)] + [(None, "no id here", "o", "r"), (None, None, "o", "r"), (3, "ab cd", "o", "r"), (3, "other text", "o", "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, restored string")
    got = fim.digests(fim.fill_in_middle(df)).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    key = lambda r: tuple(str(x) for x in r)
    want = [(i, *plainly(i, t)[:4], sha(plainly(i, t)[4]), sha(t or "")) for i, t, _, _ in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digests(fim.fill_in_middle(df)).count() == 0
    text = "word, " * 400_000 + "é" * 100_000
    df = spark.createDataFrame([(12, text)], "doc_id long, text string")
    row = fim.digests(fim.fill_in_middle(df)).first()
    assert (row.n, row.form, row.prefix_chars, row.middle_chars) == plainly(12, text)[:4]
    assert row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
