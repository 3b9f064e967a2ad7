"""What a task holds: arrays over a few texts at once, whatever the batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from stonefly.llm import jaccard_tree, language_id, suffix_dedup, token_files, tokens
from stonefly.llm.tokens import word_tokenizer


class Rows:
    """Stands for a DataFrame: gives the function that its tasks would run."""

    schema = {"doc_id": type("Field", (), {"dataType": type("Long", (), {"simpleString": staticmethod(lambda: "bigint")})})}

    def mapInArrow(self, run, schema):
        return run

    def select(self, *names):
        return self


def texts(n_bytes):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(5000)]
    out = []
    while sum(map(len, out)) < n_bytes:
        out.append(" ".join(rng.choices(words, k=400)))
    return out


def peak_mb(run, batch):
    tracemalloc.start()
    rows = sum(x.num_rows for x in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return rows, peak


def test_sets_of_few_texts_at_once():
    """Before: the words of 4 MB of text at once, 200 to 300 MB in each task."""
    x = texts(4 << 20)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(x)), pa.int64()), pa.array(range(len(x)), pa.int64()), pa.array(x)], names=["doc_id", "h", "text"])
    rows, peak = peak_mb(jaccard_tree.set_rows(Rows(), 5), batch)
    assert rows == len(x) and peak < 100
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(x)), pa.int64()), pa.array(x)], names=["node", "text"])
    rows, peak = peak_mb(jaccard_tree.whole_sets(Rows(), 5), batch)
    assert rows == len(x) and peak < 100


def test_regions_of_few_texts_at_once():
    """Before: the regions of 6 MB of text at once, some 430 MB in each task."""
    x = texts(6 << 20)
    ids = pa.array(np.arange(len(x)))
    rows, peak = peak_mb(suffix_dedup.region_rows(Rows(), 100), pa.RecordBatch.from_arrays([ids, ids, pa.array(x)], names=["d", "x", "text"]))
    assert rows > len(x) and peak < 200


def test_language_sample_reaches_the_driver_packed(spark, monkeypatch):
    """Before: eight bytes for each n-gram of the sample, and sixteen in the driver's Python."""
    frame = type(spark.range(0))
    sent, whole = [], frame.toArrow

    def seen(self):
        sent.append(whole(self))
        return sent[-1]

    monkeypatch.setattr(frame, "toArrow", seen)
    x = [*texts(1 << 17), "ab " * 400, "", "12 34"]
    docs = spark.createDataFrame([(k, "ab"[k % 2], t) for k, t in enumerate(x)], "h long, lang string, text string").coalesce(1)
    idf = 1 + np.arange(language_id.BINS) / language_id.BINS
    got = language_id.features(docs, idf)
    entries = sum(len(b) for _, b, _ in got)
    assert len(got) == len(x) - 2 and sent[0].nbytes < 4.5 * entries
    assert sum(b.nbytes + c.nbytes for _, b, c in got) <= 6 * entries
    # the same weights as from the n-grams themselves
    bins, ends = language_id.ngrams(x)
    for (_, own, shares), a, b in zip(got, [0, *ends], ends, strict=False):
        counts = np.bincount(np.concatenate([k[a:b] for k in bins]), minlength=language_id.BINS)
        assert own.tolist() == np.flatnonzero(counts).tolist()
        assert np.array_equal(shares, (counts[own] / counts.sum() * idf[own]).astype(np.float32))


def test_language_model_of_counted_texts(spark):
    seen, n = language_id.document_frequency(spark.createDataFrame([("ab ab",), ("ab",), (None,), ("b",)], "text string"))
    assert n == 4 and seen.max() == 3 and seen.sum() > 0
    empty = language_id.document_frequency(spark.createDataFrame([], "text string"))
    assert empty[1] == 0 and not empty[0].any()


def test_token_file_tasks_give_memory_back(spark, tmp_path, monkeypatch):
    """Before: a worker kept what its tasks had freed, 440 MB on 0.51 GB, while others ran."""
    calls = tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def release():
        import tempfile

        tempfile.mkstemp(dir=folder)

    monkeypatch.setattr(token_files, "release_memory", release)
    x = [*texts(1 << 16), None, ""]
    docs = spark.createDataFrame(list(enumerate(x)), "doc_id long, text string")
    out = str(tmp_path / "out")
    done = []
    table, narrow = token_files.token_table(docs, word_tokenizer(), 2, f"{out}/tokens")
    done.append(len(list(calls.iterdir())))
    counts = token_files.id_counts(table, narrow)
    done.append(len(list(calls.iterdir())))
    manifest = token_files.write_files(table, narrow, np.array([k for k, _ in counts]), out, 1000)
    done.append(len(list(calls.iterdir())))
    assert token_files.with_crc(token_files.read_files(manifest, out)).collect()[0].n_tokens > 0
    done.append(len(list(calls.iterdir())))
    assert 0 < done[0] < done[1] < done[2] < done[3]


def test_encoder_keeps_few_chunks(monkeypatch):
    """Before: a million chunks in each worker."""
    assert tokens.CACHE_CHUNKS <= 500_000
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 100)
    coder = tokens.Encoder(word_tokenizer())
    x = texts(1 << 14)
    for _ in range(2):
        ids, offsets = coder.encode(pa.array(x))
        assert len(coder.place) == 100
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [coder.library.encode(t, add_special_tokens=False).ids for t in x]
