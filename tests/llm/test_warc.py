"""WARC writer and reader."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from stonefly.llm import warc
from stonefly.llm.common import file_system, run_dir

ROWS = [(3, "http://a/3", "same"), (1, "http://a/1", "same"), (2, None, None), (4, "http://a/ 4\r\nX: y", ""), (5, "u", "é" * 300_000), (None, "n", "same"), (6, "u", "one"), (6, "u", "one")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")


def test_round_trip(spark):
    folder = run_dir(spark, "test")
    manifest = warc.write_warc(frame(spark), folder, file_bytes=1)
    got = warc.read_warc(manifest, folder, with_payload=True).collect()
    assert len(got) == len(ROWS) == sum(r.n_records for r in manifest.collect())
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    for page_id, _, html in ROWS:
        payload = (html or "").encode()
        for r in by[page_id]:
            assert r.payload_bytes == len(payload)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert r.payload == (payload if r.record_type == "response" else b"")
    assert [(by[k][0].record_type, by[k][0].refers_to) for k in (1, 3, 2, 4, None)] == [("response", None), ("revisit", 1), ("response", None), ("revisit", 2), ("response", None)]
    assert sorted((r.record_type, r.refers_to) for r in by[6]) == [("response", None), ("revisit", 6)]


def test_small_payloads_are_responses(spark):
    folder = run_dir(spark, "test")
    got = warc.read_warc(warc.write_warc(frame(spark), folder, min_bytes=4), folder).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 4)
    assert [r.refers_to for r in got if r.page_id == 3] == [1]


def test_equal_input_gives_equal_files(spark):
    def files():
        folder = run_dir(spark, "test")
        manifest = warc.write_warc(frame(spark).coalesce(1), folder)
        return sorted((r.file, r.sha256) for r in manifest.collect()), folder

    (a, folder), (b, _) = files(), files()
    assert a == b
    fs, base = file_system(folder)
    with fs.open_input_stream(f"{base}/records/{a[0][0]}", compression=None) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_files_do_not_depend_on_how_rows_are_dealt(spark):
    from pyspark.sql import functions as F
    def files(order, parts):
        rows = spark.range(12_000, numPartitions=parts).select((F.col("id") * 7 % 12_000).alias("page_id"), F.concat(F.lit("u"), F.col("id") % 11).alias("url"), F.concat(F.lit("body "), F.col("id") % 900).alias("html")).unionAll(frame(spark).select("page_id", "url", "html"))
        folder = run_dir(spark, "test")
        manifest = warc.write_warc(rows.repartition(parts, order), folder, file_bytes=40_000)
        return sorted((r.file, r.n_records, r.sha256) for r in manifest.collect())

    a, b = files("url", 3), files("html", 11)
    assert a == b and sum(x[1] for x in a) == 12_008 and len({x[0][:11] for x in a}) == 8
    sizes = {}
    for name, n, _ in a:
        sizes[name[:11]] = sizes.get(name[:11], 0) + n
    assert max(sizes.values()) < 2 * 12_008 / 8


def test_damage_is_found():
    whole = gzip.decompress(warc.record(1, "u", b"payload", warc.base32_sha1(b"payload"), None, "2020-01-01T00:00:00Z"))
    assert warc.parse(whole)[2] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(whole.replace(b"\r\n\r\npayload", b"\r\n\r\nPayload"))


def test_empty(spark):
    assert warc.warc_round_trip(spark, frame(spark, [])).count() == 0
