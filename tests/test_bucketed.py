"""Bucketed history and master: joins without an exchange."""

import tempfile

import pytest
from pyspark.sql import functions as F

from stonefly.sources.bucketed import read_bucketed, write_bucketed


@pytest.fixture
def shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_and_samples_join_without_an_exchange(shuffled):
    d = tempfile.mkdtemp(prefix="stonefly-buckets-")
    species = shuffled.range(5000).select(F.concat(F.lit("s"), F.col("id") % 700).alias("sample"), F.concat(F.lit("t"), F.col("id") % 90).alias("taxon"), F.col("id").alias("n"))
    samples = species.select("sample").distinct().withColumn("site", F.upper("sample"))
    a, b = write_bucketed(species, f"{d}/species", ["sample"], 6), write_bucketed(samples, f"{d}/samples", ["sample"], 6)
    joined = a.join(b, "sample")
    assert "Exchange" not in plan(joined) and joined.count() == 5000
    again = read_bucketed(shuffled, f"{d}/species").join(read_bucketed(shuffled, f"{d}/samples"), "sample")
    assert "Exchange" not in plan(again)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, species.join(samples, "sample").collect()))
    # the aggregate by sample needs none either
    assert "Exchange" not in plan(read_bucketed(shuffled, f"{d}/species").groupBy("sample").agg(F.sum("n")))


def test_taxa_and_master_and_null_keys(shuffled):
    d = tempfile.mkdtemp(prefix="stonefly-buckets-")
    rows = shuffled.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "taxon string, n int")
    master = shuffled.createDataFrame([("a", "x"), ("c", "y"), (None, "z")], "taxon string, grp string")
    a, b = write_bucketed(rows, f"{d}/rows", ["taxon"], 4), write_bucketed(master, f"{d}/master", ["taxon"], 4)
    got = a.join(b, "taxon", "left")
    assert "Exchange" not in plan(got)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", 1, "x"), ("a", 4, "x"), ("b", 2, None), (None, 3, None)]))
    assert write_bucketed(rows.limit(0), f"{d}/none", ["taxon"], 4).count() == 0
