"""What steps leave on disk: shuffle files and scratch tables that nothing reads again."""

import glob
import os
import random
import tempfile
import time

import corpus_pipeline
from stonefly.llm import jaccard_tree, suffix_dedup
from stonefly.llm.common import CLEANUP, write_table


def shuffled(spark):
    base = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    return {x for d in base.split(",") for x in glob.glob(f"{d}/**/blockmgr-*/*/shuffle_*.data", recursive=True)}


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    """Before: they lay there until the driver's next collection of garbage."""
    counts = lambda: spark.range(20_000).selectExpr("id % 5000 AS k").groupBy("k").count()
    counts().write.parquet(str(tmp_path / "first"))  # classes are loaded, with the collections that come of it
    before, set_before = shuffled(spark), spark.conf.get(CLEANUP, None)
    got = write_table(counts(), str(tmp_path / "t"))
    until = time.time() + 5
    while (left := {x for x in shuffled(spark) - before if os.path.getsize(x) > 10_000}) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert got.count() == 5000
    assert spark.conf.get(CLEANUP, None) == set_before


def test_near_duplicates_leave_only_their_groups(spark, tmp_path, monkeypatch):
    """Before: sets, sketches and texts of the run stayed beside all later steps."""
    monkeypatch.setattr(jaccard_tree, "run_dir", lambda spark, name: str(tmp_path / "run"))
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    one = text(200)
    docs = spark.createDataFrame([(1, one), (2, one + " more"), (3, text(200)), (4, None), (None, one)], "doc_id long, text string")
    got = jaccard_tree.similar_documents(spark, docs)
    assert os.listdir(tmp_path / "run") == ["groups"]
    assert sorted(map(str, got.select("doc_id", "component_id").collect())) == sorted(f"Row(doc_id={a}, component_id={b})" for a, b in [(1, 1), (2, 1), (3, 3), (4, 4), (None, 1)])


def test_repeated_bytes_send_each_text_once(spark, tmp_path, monkeypatch):
    """Before: the rows joined with their intervals held the text twice."""
    calls, whole = [], suffix_dedup.remove_repeats

    def seen(*args, **kw):
        calls.append(kw["keep"])
        return whole(*args, **kw)

    monkeypatch.setattr(suffix_dedup, "remove_repeats", seen)
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh ", k=300))
    docs = spark.createDataFrame([(1, passage + "x" * 3, "en", "s", 303), (2, "yy" + passage, "en", "s", 302)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.repeated_bytes_stage(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and "text" not in calls[0]
    assert sorted(map(tuple, got.collect())) == [(1, passage + "xxx", "en", "s", 303), (2, "yy", "en", "s", 2)]
