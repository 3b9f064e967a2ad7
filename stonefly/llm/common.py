"""Helpers shared by the training-data operators: shared scratch tables, Arrow batch slicing, remote files."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyarrow import RecordBatch
from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a query's shuffle files are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session (one machine) gets a folder of its own,
    removed at exit; on a cluster an error is raised, because a machine-local
    folder would not be seen by the other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="stonefly-llm-"))
        atexit.register(shutil.rmtree, _OWN[0], True)
    return _OWN[0]


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder name for one run of an operator, under the shared folder."""
    return f"{shared_dir(spark)}/stonefly-llm/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet and return the written table: cuts lineage, survives lost executors.

    The write's shuffle files go as it ends, since nothing reads them again; they would
    lie on the executors' disks until the driver next collects garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(folder: str) -> None:
    """Delete the written tables under a run's own folder, which no plan reads any more; a store that Arrow can't open keeps them."""
    try:
        fs, path = file_system(folder)
        fs.delete_dir(path)
    except (OSError, pa.ArrowException):
        pass


def release_memory() -> None:
    """Give freed memory back to the system at a task's end: the worker process lives on for other stages' tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system and path of a folder given as URI or absolute path."""
    return pafs.FileSystem.from_uri(uri)


def put_file(fs: pafs.FileSystem, path: str, data: bytes | list[bytes]) -> None:
    """Write under a temporary name, then rename: a file under its final name is always whole."""
    fs.create_dir(os.path.dirname(path), recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temporary, compression=None) as out:
        for part in [data] if isinstance(data, bytes) else data:
            out.write(part)
    fs.move(temporary, path)


def slices(batch: RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds at most ``limit`` bytes (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one after the other, and the n + 1 offsets of its rows (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def string_array(raw: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A string column from bytes and the n + 1 offsets of its rows: the inverse of ``text_buffers``."""
    column = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
    return column.cast(kind) if kind else column


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit words (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
