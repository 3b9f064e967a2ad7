"""Token files: codes, encoder, round trip."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stonefly.llm import token_files as T
from stonefly.llm.common import run_dir
from stonefly.llm.tokens import encoder, word_tokenizer


@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=40))
@settings(max_examples=80, deadline=None)
def test_codes_round_trip(values):
    control, data = T.pack_codes(np.array(values, np.uint32))
    assert T.unpack_codes(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)).tolist() == values


AWKWARD = ["", None, "  ", "don't <|endoftext|>x y<|startoftext|> z", "<|ENDOFTEXT|>", "é H̱ Éx,. a).b", "\x1c\x1d a\x85b c", "İ ΣΑΣ", "It's 12. straße,", "x" * 5000, "中文 \U0001f600"]


@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.text(alphabet="aAbé., '\ń", max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_encoder_equals_library(texts):
    coder = encoder(word_tokenizer())
    ids, offsets = coder.encode(pa.array(texts + AWKWARD, pa.string()))
    for k, text in enumerate(texts + AWKWARD):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == coder.library.encode(text or "", add_special_tokens=False).ids


def test_files(spark):
    rows = [(5, "b c"), (2, "the end of the road"), (2, "again"), (None, "null id"), (9, None), (7, "long " * 3000), (7, "long " * 3000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    folder = run_dir(spark, "test")
    manifest = T.write_token_files(docs, folder, word_tokenizer(), 2, file_tokens=100)
    got = T.with_crc(T.read_files(manifest, folder)).orderBy("start").collect()
    library = Tokenizer.from_file(word_tokenizer())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (doc_id, text) in zip(got, order, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert manifest.count() > 1


def test_empty(spark):
    assert T.token_digest(spark, spark.createDataFrame([], "doc_id long, text string"), word_tokenizer()).count() == 0
