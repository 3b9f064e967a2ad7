"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams of one to three letters (lower case, runs of
other characters as one blank). A text's weight for an n-gram is its share of the
text's n-grams times the inverse document frequency, which is counted over all
training documents. Weights are learned with the follow-the-regularised-leader
(FTRL-proximal) rule and elastic-net penalties on ``sample_rows`` training documents
at most, dealt evenly over the languages: those with the smallest hash of their id.
A part of them is held back to fit a temperature, by which scores are probabilities.

Text that is null or has no letter gives ``und`` with score 0; so does any text when
there is nothing to learn from. Whole texts are read. Every input row gives one row,
repeated rows too; an empty table gives an empty result. Only the columns named are
read; ``keep`` names further ones to pass through (not ``_text``, ``lang_pred`` or ``score``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stonefly.llm.common import release_memory, run_dir, slices, write_table

BINS = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE_PARTS = 32
#: Bytes of text (one text at least) whose n-grams a task holds at once; they take some 60 times that.
SLICE = 1 << 18
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """By code point: is it a letter?"""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def ngrams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Bins of the n-grams of all texts: an array for each order, and each text's end in it.

    Each text stands between blanks; all orders have one n-gram a position, so that
    the ends are the same. A text without letters has none.
    """
    codes = np.frombuffer("".join(f" {x.lower()} " for x in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(x.lower()) + 2 for x in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    real = letters()[codes]
    keep = real | np.concatenate([[True], real[:-1]]) | np.concatenate([[True], doc[1:] != doc[:-1]])
    some = np.bincount(doc, real, len(texts)) > 0
    keep &= some[doc]
    codes, doc = np.where(real, codes, 32)[keep].astype(np.uint64), doc[keep]
    padded = np.concatenate([codes, np.full(2, 32, np.uint64)])
    out, h = [], np.zeros(len(codes), np.uint64)
    for k in range(max(ORDERS)):
        h = (h ^ padded[k : k + len(codes)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if k + 1 in ORDERS:
            out.append(((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int32))
    return out, np.cumsum(np.bincount(doc, minlength=len(texts)))


@dataclass
class Model:
    """Languages, a weight for each bin and language (inverse document frequency included), biases and temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each text, and whether it has a letter."""
        bins, ends = ngrams(texts)
        sizes = np.diff(ends, prepend=0)
        some = sizes > 0
        total = np.zeros((len(texts), len(self.languages)))
        starts = (ends - sizes)[some]
        if len(starts):
            for b in bins:
                for c in range(len(self.languages)):
                    total[some, c] += np.add.reduceat(self.weights[c][b], starts)
            total[some] /= sizes[some, None] * len(bins)
        return total + self.bias, some

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        z, some = self.logits(texts)
        p = softmax(z / self.temperature)
        best = p.argmax(axis=1)
        return [self.languages[k] if ok else "und" for k, ok in zip(best, some, strict=True)], np.where(some, p[np.arange(len(p)), best], 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def document_frequency(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of the whole column each bin occurs, and how many texts there are: BINS rows at most reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BINS, np.int64), 0
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            rows = [x or "" for x in batch.column("text").to_pylist()]
            n += len(rows)
            for a in range(0, len(rows), 128):
                bins, ends = ngrams(rows[a : a + 128])
                found = np.zeros((len(ends), BINS), bool)
                doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                for b in bins:
                    found[doc, b] = True
                total += found.sum(axis=0)
        release_memory()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *seen.tolist()], pa.int64()), pa.array([n, *total[seen].tolist()], pa.int64())], names=["bin", "n"])

    rows = texts.mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    bins, counts = rows["bin"].to_numpy(), rows["n"].to_numpy()
    got = np.zeros(BINS, np.int64)
    got[bins[bins >= 0]] = counts[bins >= 0]
    return got, int(counts[bins < 0].sum())


def features(texts: DataFrame, idf: np.ndarray) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, bins, weights) of the sample, in order of the hash; n-grams are counted in tasks.

    Of each text the driver gets its bins in two bytes each, and their counts in as many as the largest needs.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            rows = [x or "" for x in batch.column("text").to_pylist()]
            bins, ends = ngrams(rows)
            found, often = [], []
            for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                counts = np.bincount(np.concatenate([x[a:b] for x in bins]), minlength=1)
                own = np.flatnonzero(counts)
                found.append(own.astype("<u2").tobytes())
                often.append(counts[own].astype(f"<u{np.min_scalar_type(counts.max()).itemsize}").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("lang"), pa.array(found, pa.binary()), pa.array(often, pa.binary())], names=["h", "lang", "bins", "counts"])
        release_memory()

    rows = texts.mapInArrow(make, "h long, lang string, bins binary, counts binary").toArrow().sort_by("h")
    out = []
    for lang, found, often in zip(rows["lang"].to_pylist(), rows["bins"], rows["counts"], strict=True):
        own = np.frombuffer(found.as_py(), "<u2")
        if len(own):
            raw = often.as_py()
            counts = np.frombuffer(raw, f"<u{len(raw) // len(own)}").astype(np.int64)
            out.append((lang, own, (counts / max(1, counts.sum()) * idf[own]).astype(np.float32)))
    return out


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = 2, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-5, l2: float = 1e-4, scale: float = 30.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights (classes, BINS) and biases by FTRL-proximal with elastic-net penalties."""
    z, n = np.zeros((classes, BINS + 1)), np.zeros((classes, BINS + 1))

    def weights(at: np.ndarray) -> np.ndarray:
        zz, nn = z[:, at], n[:, at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    for _ in range(epochs):
        for label, bins, shares in rows:
            at = np.append(bins, BINS)  # the last one is the bias
            x = np.append(shares.astype(np.float64) * scale, 1.0)
            w = weights(at)
            p = softmax((w @ x)[None])[0]
            p[label] -= 1
            g = p[:, None] * x
            step = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / alpha
            z[:, at] += g - step * w
            n[:, at] += g * g
    w = weights(np.arange(BINS + 1))
    return w[:, :BINS] * scale, w[:, BINS]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least cross-entropy, by golden section on its logarithm."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()
    a, b, r = np.log(0.05), np.log(20), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(spark: SparkSession, docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 3000) -> Model:
    """Learn from the rows of ``docs`` for which ``training`` holds and text and language are not null."""
    rows = docs.filter(training & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h"))
    seen, n = document_frequency(rows.select("text"))
    if not n:
        return Model([], np.zeros((0, BINS)), np.zeros(0), 1.0)
    idf = np.log((1 + n) / (1 + seen)) + 1
    folder = run_dir(spark, "language-id")
    # the sample: of each language the rows with the smallest hashes, chosen by narrow rows and written
    each = max(1, sample_rows // max(1, rows.select("lang").distinct().count()))
    # first within parts of each language, so that no language is ordered in one task
    chosen = rows.select("lang", "h").distinct().withColumn("part", F.pmod(F.xxhash64("h"), F.lit(SAMPLE_PARTS)))
    for by in (["lang", "part"], ["lang"]):
        chosen = chosen.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).filter(F.col("k") <= each).drop("k")
    chosen = write_table(chosen.select("lang", "h"), f"{folder}/chosen")
    sample = rows.join(chosen, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])
    got = features(sample.select("h", "lang", "text"), idf)
    names = sorted({x[0] for x in got})
    if not names:
        return Model([], np.zeros((0, BINS)), np.zeros(0), 1.0)
    label = {x: k for k, x in enumerate(names)}
    rows_ = [(label[a], b, c) for a, b, c in got]
    held = rows_[::5]
    fit = [x for k, x in enumerate(rows_) if k % 5] or rows_
    w, bias = ftrl(fit, len(names))
    logits = np.array([w[:, b] @ c.astype(np.float64) + bias for _, b, c in held])
    model = Model(names, (w * idf).astype(np.float32), bias, temperature(logits, np.array([x[0] for x in held])))
    # the sample would stay in the driver's memory beside all later steps
    got.clear()
    rows_.clear()
    fit.clear()
    held.clear()
    release_memory()
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row with lang_pred and score; only the text is an input."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages times BINS weights, whatever the corpus
    rows = docs.select(*keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "_text", SLICE)):
            names, scores = shared.value.predict([x or "" for x in batch.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])
        release_memory()

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learn from the documents that aren't held out and predict all: doc_id, held_out, lang_pred, score."""
    model = train(spark, docs, ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
