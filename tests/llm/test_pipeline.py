"""The corpus pipeline: what each stage keeps."""

from __future__ import annotations

import random

import corpus_pipeline as C
from stonefly.llm.common import run_dir


def test_stages(spark, tmp_path):
    rng = random.Random(4)
    kinds = {"en": "the of and tion ing ed er".split(), "de": "der und ung isch keit zu ein".split()}
    text = lambda lang, n: " ".join("".join(rng.choices(kinds[lang], k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, text(lang, 120), lang) for i, lang in enumerate(["en", "de"] * 20)]
    passage = text("en", 60)
    rows += [(100, rows[0][1] + " tail", "en"), (101, text("en", 100) + " " + passage, "en"), (102, passage + " " + text("en", 100), "en")]
    rows += [(200, None, "en"), (201, "1234 " * 80, "en"), (202, "too short", "en"), (203, "", None)]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = run_dir(spark, "test")
    after = {}
    for name, stage in C.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        after[name] = docs
        if name != C.STAGES[-1][0]:
            assert docs.dtypes == before.dtypes
    ids = lambda name: {r.doc_id for r in after[name].select("doc_id").collect()}
    assert ids("language_id") == {r[0] for r in rows} - {200, 201, 203}
    assert ids("quality_rules") == ids("language_id") - {202}
    assert ids("near_duplicates") == ids("quality_rules") - {100}
    assert ids("repeated_bytes") == ids("near_duplicates")
    cut = {r.doc_id: r for r in after["repeated_bytes"].collect()}
    assert passage in cut[101].text and passage not in cut[102].text
    assert cut[102].n_chars == len(cut[102].text)
    assert ids("packing") == ids("repeated_bytes")


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijkl", k=rng.randint(3, 8))) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", host, len(t)) for i, t, host in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_one_of_many_near_copies_stays(spark, tmp_path):
    rng = random.Random(7)
    body = [prose(rng, 12) for _ in range(12)]
    footer = prose(rng, 70)
    rows = [(i, "\n".join([*body, prose(rng, 2)]), "a") for i in range(300)]
    rows += [(1000 + i, prose(rng, 60) + "\n" + footer, "a") for i in range(210)]
    docs = frame(spark, rows)
    kept = C.quality_stage(spark, docs, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == set(range(300))
    assert [r.doc_id for r in C.near_duplicate_stage(spark, kept, str(tmp_path)).collect()] == [0]


def test_rows_without_or_with_one_id(spark, tmp_path):
    rng = random.Random(8)
    base, other, own, last = (prose(rng, 120) for _ in range(4))
    rows = [(None, base + " one", "a"), (None, base + " two", "a"), (None, other, "a"), (None, "too short", "a")]
    rows += [(-3, own, "a"), (-3, "too short", "a"), (-3, base, "b"), (9, own + " more", "a"), (9, last, None), (9, last, None)]
    kept = C.quality_stage(spark, frame(spark, rows), str(tmp_path))
    assert sorted(r.text for r in kept.collect()) == sorted(t for _, t, _ in rows if t != "too short")
    left = C.near_duplicate_stage(spark, kept, str(tmp_path))
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted([("None", other), ("-3", own), ("-3", base), ("9", last)])
    alone = C.near_duplicate_stage(spark, frame(spark, rows[:3]), str(tmp_path))
    assert other in (texts := [r.text for r in alone.collect()]) and len(texts) == 2


def test_run_over_a_table(spark):
    got = C.run(spark, "/root/testdata/sf0.001")
    ends = {}
    for r in got.orderBy("sequence_id", "offset").collect():
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert ends and max(ends.values()) <= 4096


def test_near_duplicate_stage_shuffles_the_texts_once(spark, tmp_path):
    rng = random.Random(9)
    text = prose(rng, 60)
    docs = spark.createDataFrame([(1, text), (1, text), (2, text + " end"), (3, None), (3, ""), (3, ""), (None, "some other text")], "doc_id long, text string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = C.near_duplicate_stage(spark, docs, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2  # the documents and the rows that go
    rows = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert rows == sorted([(1, text), (3, None), (3, ""), (None, "some other text")], key=str)
