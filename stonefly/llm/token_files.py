"""Token ids in binary files: frequency-ranked ids, byte-aligned variable-length codes, separate control bytes.

A folder holds ``ranks.bin`` (all ids that occur, most frequent first, ties to
the smaller id, as little-endian unsigned 32-bit integers) and one file for each
run of documents. A file is::

    8 bytes     magic ``SFLYTOK1``
    8 + 8       documents n, ids m (unsigned 64-bit)
    n bytes     1 where the document id is null
    8 n bytes   document ids (signed 64-bit)
    4 n bytes   ids of each document (unsigned 32-bit)
    (m + 3)/4   control bytes: two bits an id, its code's bytes less one
    rest        the codes: each id's rank in as few little-endian bytes as it needs

Documents lie in ascending order of (doc_id, text), nulls first. Files get their
final name by a rename, and readers take only those that the manifest table names,
so a task that was lost or run twice leaves nothing that is read. Files roll at
``file_tokens`` ids (a longer document has a file of its own).

Null text counts as empty: such a document holds just its end id. Repeated rows
stay, each with its own ids. An empty table gives a folder without files. Columns
other than the named two are neither read nor met.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stonefly.llm.common import file_system, put_file, ragged, release_memory, run_dir, shuffle_partitions, slices, write_table
from stonefly.llm.tokens import encoder

MAGIC = b"SFLYTOK1"
#: By control byte: which of the 16 bytes of four 32-bit words are stored.
STORED = np.array([[j <= (c >> (2 * i) & 3) for i in range(4) for j in range(4)] for c in range(256)])

MANIFEST = "file string, shard int, seq long, n_docs long, n_tokens long, n_bytes long"
TOKENS = "shard int, seq long, doc_id long, n_tokens long, ids binary"


def pack_codes(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    size = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = np.concatenate([size, np.zeros(-len(size) % 4, np.uint8)]).reshape(-1, 4)
    control = (control << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    stored = np.arange(4, dtype=np.uint8) <= size[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[stored].tobytes()


def unpack_codes(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values: the table tells which bytes of their words the data bytes are."""
    words = np.zeros(4 * n, np.uint8)
    words[STORED[control].reshape(-1)[: 4 * n]] = data
    return words.view("<u4")


def token_table(docs: DataFrame, tokenizer: str, end_id: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.dtype]:
    """Encode whole texts in order of (doc_id, text) into a written table: one row a document, ids as bytes."""
    spark = docs.sparkSession
    narrow = np.dtype("<u2" if max(encoder(tokenizer).library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(shuffle_partitions(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seq = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer)
        for batch in (part for whole in batches for part in slices(whole, "text")):
            ids, offsets = coder.encode(batch.column("text"))
            n = batch.num_rows
            # each document's ids with the end id behind them
            full = np.full(len(ids) + n, end_id, narrow)
            full[ragged(offsets[:-1] + np.arange(n), np.diff(offsets))] = ids
            ends = (offsets + np.arange(n + 1)) * narrow.itemsize
            column = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(full)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(seq, seq + n)), batch.column("doc_id"), pa.array(np.diff(offsets) + 1), column.cast(pa.binary())], names=["shard", "seq", "doc_id", "n_tokens", "ids"])
            seq += n
        release_memory()  # an idle worker lies beside those of the tasks that run; the kept chunks stay for its next task

    return write_table(rows.mapInArrow(encode, TOKENS), path), narrow


def id_counts(tokens: DataFrame, narrow: np.dtype) -> list[tuple[int, int]]:
    """How often each id occurs in the whole table: at most one row for each id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column("ids"):
                got = np.bincount(np.frombuffer(value.as_buffer(), narrow))
                if len(got) > len(total):
                    got[: len(total)] += total
                    total = got
                else:
                    total[: len(got)] += got
        release_memory()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return [(r["id"], r["n"]) for r in rows.collect()]


def write_files(tokens: DataFrame, narrow: np.dtype, ranked: np.ndarray, folder: str, file_tokens: int) -> DataFrame:
    """Write the files of a token table; the written manifest has one row for each."""
    rank = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    fs, base = file_system(folder)
    put_file(fs, f"{base}/ranks.bin", ranked.astype("<u4").tobytes())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        held: list[tuple] = []  # (shard, seq, doc_id, n, ids) of one file
        size = 0

        def flush() -> pa.RecordBatch:
            shard, seq = held[0][:2]
            ids = np.concatenate([x[4] for x in held])
            control, data = pack_codes(rank[ids])
            doc_ids = [x[2] for x in held]
            head = MAGIC + np.array([len(held), len(ids)], "<u8").tobytes()
            parts = [head, np.array([x is None for x in doc_ids], np.uint8).tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x[3] for x in held], "<u4").tobytes(), control, data]
            name = f"ids-{shard:06d}-{seq:09d}.bin"
            put_file(fs, f"{base}/{name}", parts)
            return pa.RecordBatch.from_pylist([{"file": name, "shard": shard, "seq": seq, "n_docs": len(held), "n_tokens": len(ids), "n_bytes": sum(map(len, parts))}], schema=pa.schema([("file", pa.string()), ("shard", pa.int32()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "seq", "doc_id", "n_tokens")]
            for *row, value in zip(*columns, batch.column("ids"), strict=True):
                if held and (size + row[3] > file_tokens or held[-1][:2] != (row[0], row[1] - 1)):
                    yield flush()
                    held, size = [], 0
                held.append((*row, np.frombuffer(value.as_buffer(), narrow)))
                size += row[3]
        if held:
            yield flush()
        held.clear()
        release_memory()

    return write_table(tokens.mapInArrow(write, MANIFEST), f"{folder}/manifest")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Decode the files that the manifest names: doc_id, start, n_tokens and the ids' bytes (unsigned 32-bit).

    Starts come from sums over the manifest: within a shard, then over the
    shards, of which there are as many as the write had partitions.
    """
    spark = manifest.sparkSession
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    files = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(shards, "shard")
    files = files.select("file", (F.col("start") + F.col("base")).alias("start")).repartition(4 * shuffle_partitions(spark), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        ranked = None
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                if ranked is None:
                    with fs.open_input_stream(f"{base}/ranks.bin", compression=None) as f:
                        ranked = np.frombuffer(f.read(), "<u4")
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    raw = f.read()
                if raw[:8] != MAGIC:
                    raise ValueError(f"{name} is not a token file")
                n, m = (int(x) for x in np.frombuffer(raw, "<u8", 2, 8))
                null = np.frombuffer(raw, np.uint8, n, 24).astype(bool)
                doc_ids = np.frombuffer(raw, "<i8", n, 24 + n)
                lengths = np.frombuffer(raw, "<u4", n, 24 + 9 * n).astype(np.int64)
                at = 24 + 13 * n
                control = np.frombuffer(raw, np.uint8, (m + 3) // 4, at)
                ids = ranked[unpack_codes(control, np.frombuffer(raw, np.uint8, offset=at + len(control)), m)]
                ends = np.cumsum(lengths)
                offsets = np.concatenate([[0], ends])
                for a in range(0, n, 512):  # rows of bounded size leave one batch after the other
                    b = min(n, a + 512)
                    part = ids[offsets[a] : offsets[b]].astype("<u4")
                    own = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((offsets[a : b + 1] - offsets[a]) * 4), pa.py_buffer(part)])
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:b], mask=null[a:b]), pa.array(start + offsets[a:b]), pa.array(lengths[a:b]), own.cast(pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
        release_memory()

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_tokens: int = 1 << 20) -> DataFrame:
    """Encode ``docs`` into token files under ``folder``; returns the manifest table."""
    tokens, narrow = token_table(docs, tokenizer, end_id, f"{folder}/tokens", id_col, text_col)
    counts = sorted(id_counts(tokens, narrow), key=lambda x: (-x[1], x[0]))
    return write_files(tokens, narrow, np.array([k for k, _ in counts], np.int64), folder, file_tokens)


def with_crc(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by their unsigned CRC-32 (of little-endian unsigned 32-bit integers)."""
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def token_digest(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write token files in a new shared folder and read them back: doc_id, start, n_tokens, ids_crc32."""
    folder = run_dir(spark, "token-files")
    return with_crc(read_files(write_token_files(docs, folder, tokenizer, end_id), folder))
