"""Versioned tables: merge, crash, concurrent writers, readers."""

import os
import tempfile

import pytest

from stonefly.sources.versions import VersionedTable


@pytest.fixture
def root():
    return os.path.join(tempfile.mkdtemp(prefix="stonefly-versions-"), "table")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_two_runs_with_one_key_keep_one_row(spark, root):
    t = VersionedTable(spark, root, ["id"], parts=4)
    assert t.versions() == [] and t.manifest() is None
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.merge(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, x int"), "r1") == 1
    before = t.read()
    assert t.merge(spark.createDataFrame([("b", 20), ("c", 30), ("c", 29), (None, 4)], "id string, x int"), "r2") == 2
    want = [("a", 1), ("b", 20), ("c", 29), (None, 4)]
    assert rows(t.read()) == sorted(want, key=str)
    assert t.merge(spark.createDataFrame([("b", 20), ("c", 30), ("c", 29), (None, 4)], "id string, x int"), "r2") == 3  # run again
    assert rows(t.read()) == sorted(want, key=str)
    assert rows(before) == rows(t.read(1)) == sorted([("a", 1), ("b", 2), (None, 3)], key=str)
    assert t.manifest()["run"] == "r2"


def test_only_touched_parts_are_rewritten(spark, root):
    t = VersionedTable(spark, root, ["id"], parts=16)
    t.merge(spark.range(1000), "r1")
    old = t.manifest()["parts"]
    t.merge(spark.createDataFrame([(5,), (1_000_000,)], "id long"), "r2")
    new = t.manifest()["parts"]
    assert 1 <= sum(old[p] != new[p] for p in old) <= 2 and t.read().count() == 1001


def test_crash_before_the_commit_changes_nothing(spark, root, monkeypatch):
    t = VersionedTable(spark, root, ["id"])
    t.merge(spark.createDataFrame([(1, "x")], "id int, v string"), "r1")

    def crash(self, manifest):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", crash)
        with pytest.raises(OSError):
            t.merge(spark.createDataFrame([(1, "y"), (2, "z")], "id int, v string"), "r2")
    assert t.versions() == [1] and rows(t.read()) == [(1, "x")]
    # a manifest that wasn't finished is no version
    with open(os.path.join(root, "manifests", "abc.tmp"), "w") as f:
        f.write('{"version"')
    assert rows(VersionedTable(spark, root, ["id"]).read()) == [(1, "x")]


def test_second_writer_merges_on_the_first(spark, root, monkeypatch):
    t, other = VersionedTable(spark, root, ["id"], parts=2), VersionedTable(spark, root, ["id"], parts=2)
    t.merge(spark.createDataFrame([(1, "a")], "id int, v string"), "r1")
    real, done = VersionedTable._commit, []

    def late(self, manifest):
        if self is t and not done:
            done.append(other.merge(spark.createDataFrame([(2, "b"), (3, "b")], "id int, v string"), "r2"))
        return real(self, manifest)

    monkeypatch.setattr(VersionedTable, "_commit", late)
    assert t.merge(spark.createDataFrame([(3, "c")], "id int, v string"), "r3") == 3 and done == [2]
    assert rows(t.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_columns_are_united_and_types_must_agree(spark, root):
    t = VersionedTable(spark, root, ["id"])
    t.merge(spark.createDataFrame([(1, 1.0), (2, 2.0)], "id int, x double"), "r1")
    t.merge(spark.createDataFrame([(2, "n")], "id int, y string"), "r2")
    assert rows(t.read().select("id", "x", "y")) == [(1, 1.0, None), (2, None, "n")]
    with pytest.raises(ValueError):
        t.merge(spark.createDataFrame([(1, "text")], "id int, x string"), "r3")


def test_many_rows_a_key_and_empty_and_expiry(spark, root):
    t = VersionedTable(spark, root, ["sample"], one_row=False, parts=2)
    schema = "sample string, taxon string, n int"
    t.merge(spark.createDataFrame([("s", "a", 1), ("s", "b", 2), ("t", "a", 3)], schema), "r1")
    t.merge(spark.createDataFrame([("s", "c", 9), ("s", "c", 9)], schema), "r2")
    assert rows(t.read()) == [("s", "c", 9), ("s", "c", 9), ("t", "a", 3)]
    assert t.merge(spark.createDataFrame([], schema), "r3") == 3 and t.read().count() == 3
    assert t.expire(keep=1) == [1, 2] and t.versions() == [3] and t.read().count() == 3
    assert VersionedTable(spark, root + "-2", ["sample"]).merge(spark.createDataFrame([], schema), "r0") == 1
    assert VersionedTable(spark, root + "-2", ["sample"]).read().count() == 0
