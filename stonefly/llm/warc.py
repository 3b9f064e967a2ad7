"""Deterministic sharded WARC writer and reader.

Records are range-sorted by (page_id, payload digest). The ranges come from a sample of these keys
that a hash of the key chooses, about KEYS_A_SHARD for each shard, so equal rows give equal shards and files
however they are dealt to tasks. Headers, record ids and digests are made anew from the payload; each record
is a gzip member of its own. A file rolls when its compressed size reaches
``file_bytes``. It is written under a temporary name and renamed when whole, and
only files that the manifest table names are read, so lost and repeated tasks leave
nothing behind that counts.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
smallest page id holds the payload (response); the others refer to it (revisit).
Null payload counts as empty, null url gives a ``urn:page:`` target. A record without
page id can't be referred to and is a response; among repeated rows the first is the
response and the rest revisit it. An empty table gives no file and no rows. Columns
other than the three named are neither read nor met.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.llm.common import file_system, run_dir, shuffle_partitions, write_table

CRLF = b"\r\n"
#: Keys that the driver sees for each shard, to set the ranges.
KEYS_A_SHARD = 100
MANIFEST = pa.schema([("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())])
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP header only."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http; msgtype=response",
        "X-Page-Id": "" if page_id is None else str(page_id),
    }
    if revisit:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page-Id": str(refers_to)}
    head["Content-Length"] = str(len(block))
    whole = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + CRLF + block + CRLF + CRLF
    coder = zlib.compressobj(4, zlib.DEFLATED, 31)
    return coder.compress(whole) + coder.flush()


class Roll:
    """Files of one task: the open one grows under a temporary name."""

    def __init__(self, fs: pafs.FileSystem, base: str, shard: int) -> None:
        self.fs, self.base, self.shard, self.number, self.out = fs, base, shard, 0, None

    def add(self, data: bytes) -> int:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.number:06d}.warc.gz"
            self.temporary = f"{self.base}/{self.name}.{uuid.uuid4().hex}.tmp"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.size = self.records = 0
            self.digest = hashlib.sha256()
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)
        self.records += 1
        return self.size

    def close(self) -> pa.RecordBatch:
        self.out.close()
        self.fs.move(self.temporary, f"{self.base}/{self.name}")
        self.out, self.number = None, self.number + 1
        return pa.RecordBatch.from_pylist([{"file": self.name, "n_records": self.records, "n_bytes": self.size, "sha256": self.digest.hexdigest()}], schema=MANIFEST)


def key_columns() -> list[Column]:
    """A key without nulls, so that whole numbers stay whole in pandas: is there an id, the id, the digest."""
    return [F.col("page_id").isNotNull().alias("known"), F.coalesce("page_id", F.lit(0)).alias("number"), F.col("digest")]


def sort_keys(known: pd.Series, page_id: pd.Series, digest: pd.Series) -> np.ndarray:
    """Keys as byte strings in the order of (page_id, digest), null ids first."""
    known = known.to_numpy(bool)
    number = (page_id.to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
    raw = np.zeros((len(known), 49), np.uint8)
    raw[:, 0] = known + 1  # bytes strings drop zeros at their end, not inside
    raw[:, 1:9] = np.where(known[:, None], number.view(np.uint8).reshape(-1, 8), 0)
    raw[:, 9:] = np.frombuffer("".join(digest).encode(), np.uint8).reshape(-1, 40)
    return raw.reshape(-1).view("S49")


def shard_bounds(rows: DataFrame, shards: int) -> np.ndarray:
    """The first keys of all shards but the first. About KEYS_A_SHARD keys a shard reach the driver, and one count."""
    n = rows.count()
    step = max(1, n // (KEYS_A_SHARD * shards))
    chosen = rows.filter(F.pmod(F.xxhash64("page_id", "digest"), F.lit(step)) == 0).groupBy(*key_columns()).agg(F.count("*").alias("n")).toPandas()
    if chosen.empty:
        return np.zeros(0, "S49")
    keys = sort_keys(chosen["known"], chosen["number"], chosen["digest"])
    order = np.argsort(keys, kind="stable")
    keys, before = keys[order], np.cumsum(chosen["n"].to_numpy()[order])
    return np.unique(keys[np.searchsorted(before, before[-1] * np.arange(1, shards) / shards, side="right").clip(0, len(keys) - 1)])


def shard_of(bounds: np.ndarray) -> Callable:
    """The shard of a key: how many bounds are at or below it."""

    @F.pandas_udf("int")
    def shard(known: pd.Series, number: pd.Series, digest: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, sort_keys(known, number, digest), side="right").astype(np.int32))

    return shard


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, file_bytes: int = 32 << 20, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write the records of ``pages`` under ``folder``; returns the written manifest, one row a file."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    # one small row for each payload that occurs more than once, written so that Spark knows its size and can split a common one in the join
    same = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    same = write_table(same, f"{folder}/same")
    shards = shuffle_partitions(spark)
    rows = rows.join(same, "digest", "left").withColumn("shard", shard_of(shard_bounds(rows, shards))(*key_columns()))
    rows = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "page_id", "digest", "url")
    fs, base = file_system(folder)
    fs.create_dir(f"{base}/records", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        roll, last = Roll(fs, f"{base}/records", -1), None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "first", "shard")), strict=True):
                page_id, url, payload, digest, first, shard = (x.as_py() for x in row)
                if shard != roll.shard:  # a task may hold several shards, one after the other
                    if roll.out is not None:
                        yield roll.close()
                    roll = Roll(fs, f"{base}/records", shard)
                again = last == (page_id, digest)  # a repeated row; equal ones lie together
                last = (page_id, digest)
                refers_to = first if first is not None and page_id is not None and (page_id != first or again) else None
                full = base64.b32encode(bytes.fromhex(digest)).decode()
                if roll.add(record(page_id, url, payload, full, refers_to, date)) >= file_bytes:
                    yield roll.close()
        if roll.out is not None:
            yield roll.close()

    return write_table(rows.select("page_id", "url", "payload", "digest", "first", "shard").mapInArrow(write, "file string, n_records long, n_bytes long, sha256 string"), f"{folder}/manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one after the other; one member in memory at a time."""
    raw = b""
    while True:
        raw = raw or stream.read(chunk)
        if not raw:
            return
        decoder, parts = zlib.decompressobj(31), []
        while not decoder.eof:
            raw = raw or stream.read(chunk)
            if not raw:
                raise ValueError("the file ends within a record")
            parts.append(decoder.decompress(raw))
            raw = decoder.unused_data if decoder.eof else b""
        yield b"".join(parts)


def parse(whole: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record; digests and lengths are verified."""
    head, _, rest = whole.partition(CRLF + CRLF)
    fields = lambda text: dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in text.decode().split("\r\n")[1:])
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    if f"sha1:{base32_sha1(block)}" != warc["WARC-Block-Digest"] or rest[len(block) :] != CRLF + CRLF:
        raise ValueError(f"{warc['WARC-Record-ID']}: the block does not match its header")
    http, _, payload = block.partition(CRLF + CRLF)
    if warc["WARC-Type"] == "response" and f"sha1:{base32_sha1(payload)}" != warc["WARC-Payload-Digest"]:
        raise ValueError(f"{warc['WARC-Record-ID']}: the payload does not match its digest")
    return warc, fields(http), payload


def read_warc(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of the files that the manifest names: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    files = manifest.select("file").repartition(4 * shuffle_partitions(manifest.sparkSession), "file")
    schema = RECORD + ", payload binary" * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), *([("payload", pa.binary())] if with_payload else [])])
        for name in (x for batch in batches for x in batch.column("file").to_pylist()):
            rows, held = [], 0
            with fs.open_input_stream(f"{base}/records/{name}", compression=None) as stream:
                for whole in members(stream):
                    warc, http, payload = parse(whole)
                    number = lambda k: int(warc[k]) if warc.get(k) else None  # noqa: E731, B023
                    rows.append({"page_id": number("X-Page-Id"), "url": warc["WARC-Target-URI"], "payload_bytes": int(http["Content-Length"]), "payload_digest": warc["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": warc["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), **({"payload": payload} if with_payload else {})})
                    held += len(payload) * with_payload
                    if len(rows) >= 4096 or held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return files.mapInArrow(read, schema)


def warc_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` as WARC in a new shared folder and read the records back."""
    folder = run_dir(spark, "warc")
    return read_warc(write_warc(pages, folder), folder)


#: The query's rows in DuckDB SQL (page_id is unique there).
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM x)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
