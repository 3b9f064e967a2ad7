"""Repeated groups: where the keys are counted."""

from pyspark.sql import functions as F

from stonefly.operators.aggregates import repeated_groups


def test_keys_are_dealt_out_before_they_are_counted(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", None, 3), ("b", None, 4), ("c", 1, 5)], "e string, r int, v int")
    out = repeated_groups(df, ["e", "r"], count_col="n")
    assert "RepartitionByExpression [e" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((x.v, x.n) for x in out.collect()) == [(1, 2), (2, 2), (3, 2), (4, 2)]


def test_a_hot_key_is_counted_whole(spark):
    df = spark.range(0, 4000, numPartitions=8).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = repeated_groups(df, ["k"], count_col="n").groupBy("k", "n").count().collect()
    assert [tuple(x) for x in got] == [("hot", 3600, 3600)]
