"""Hot keys: the sketch, its merging, and joins that replicate only for hot keys."""

import pytest
from pyspark.sql import functions as F

from stonefly.operators import skew as K
from stonefly.operators.joins import join_null_safe, with_group_aggregates


@pytest.fixture
def shuffled(spark):
    """No side is broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def rows_by_key(spark):
    """50,000 rows: a null key with a third, one key with a fifth, the rest even over 5,000 keys."""
    i = F.col("id")
    return spark.range(50_000, numPartitions=6).select(
        F.when(i % 3 == 0, None).when(i % 5 == 0, F.lit(-1)).otherwise(i % 5000).cast("long").alias("k"), i.alias("v"))


def test_hot_keys_and_their_buckets(spark):
    df = rows_by_key(spark)
    hot = {r._kh: r._buckets for r in K.hot_keys(K.key_sketch(df, ["k"], 40), 40).collect()}
    counts = {r.kh: r.n for r in df.groupBy(K.key_hash(["k"]).alias("kh")).agg(F.count("*").alias("n")).collect()}
    want = {h for h, n in counts.items() if n * 40 > 50_000}
    assert set(hot) == want and len(want) == 2
    assert all(abs(hot[h] - counts[h] * 40 / 50_000) <= 1 for h in hot)


def test_merged_sketches_equal_one_over_both(spark):
    df = rows_by_key(spark)
    halves = [K.key_sketch(df.filter(f"v % 2 = {x}"), ["k"], 40) for x in (0, 1)]
    merged = K.merge_key_sketches(halves[0].unionAll(halves[1]))
    assert merged.first().n == 50_000
    assert sorted(map(tuple, K.hot_keys(merged, 40).collect())) == sorted(map(tuple, K.hot_keys(K.key_sketch(df, ["k"], 40), 40).collect()))


def test_only_hot_keys_are_copied(shuffled):
    df = rows_by_key(shuffled)
    small = df.groupBy("k").agg(F.max("v").alias("m"))
    hot = K.hot_keys(K.key_sketch(df, ["k"]))
    _, copies = K.bucketed(df, small, ["k"], hot)
    extra = sum(r._buckets - 1 for r in hot.collect())
    assert copies.count() == small.count() + extra and 0 < extra <= 16
    even = shuffled.range(1000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    plain = even.select("k").distinct()
    assert K.bucketed(even, plain, ["k"], K.hot_keys(K.key_sketch(even, ["k"])))[1].count() == 500


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_results_equal_a_plain_join(shuffled, how):
    df = rows_by_key(shuffled)
    small = df.filter("k IS NULL OR k % 7 <> 1").groupBy("k").agg(F.max("v").alias("m"))
    got = K.skew_join(df, small, ["k"], how)
    want = join_null_safe(df, small, ["k"], how)
    key = lambda d: d.select(F.count("*"), F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)"))).first()
    assert got.columns == want.columns and key(got) == key(want)


def test_equal_rows_are_dealt_to_many_buckets(shuffled):
    same = shuffled.range(100_000, numPartitions=40).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    small = shuffled.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    big, _ = K.bucketed(same, small, ["k"], K.hot_keys(K.key_sketch(same, ["k"])))
    sizes = [r["count"] for r in big.groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 35_000 and sum(sizes) == 100_000
    assert K.skew_join(same, small, ["k"]).filter("name = 'one'").count() == 100_000


def test_composite_and_empty(shuffled):
    df = shuffled.createDataFrame([("a", None, 1.0)] * 50 + [("a", 1, 2.0), (None, None, 3.0)], "s string, r int, v double")
    got = {(r.s, r.r, r.v): (r.m, r.n) for r in with_group_aggregates(df, ["s", "r"], {"m": F.avg("v"), "n": F.count("*")}).collect()}
    assert got == {("a", None, 1.0): (1.0, 50), ("a", 1, 2.0): (2.0, 1), (None, None, 3.0): (3.0, 1)}
    assert with_group_aggregates(df.limit(0), ["s"], {"m": F.avg("v")}).collect() == []
