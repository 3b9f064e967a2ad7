"""Hot keys: a mergeable frequent-items sketch, and joins that replicate only for them.

``key_sketch`` reads the key columns once.  Each task keeps a bounded number
of counters (Spark's frequent-items sketch), the partial sketches merge, and
the one-row result can be stored and merged with those of other runs or
tables (``merge_key_sketches``).  ``hot_keys`` turns it into the keys that hold
more than an even share of the rows, with the number of buckets their share
asks.  ``skew_join`` deals a hot key's rows to that many tasks and copies the
other side's row only for those keys, so a table without hot keys costs one
pass over its keys and no copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters of a sketch for each part that a key's share is held against: the
#: sketch is then off by less than half of an even part's rows.
COUNTERS_A_PART = 8
LEAST_COUNTERS, MOST_COUNTERS = 10_000, 1_000_000


def default_parts(df: DataFrame) -> int:
    """Tasks of a shuffle: an even share is one of them."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def counters(parts: int) -> int:
    return min(MOST_COUNTERS, max(LEAST_COUNTERS, COUNTERS_A_PART * parts))


def key_hash(keys: Sequence[str]):
    """One number for a key of any columns and types; null is a value like any other."""
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def key_sketch(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """One row: ``sketch`` of the keys' frequencies and ``n`` rows."""
    size = counters(parts or default_parts(df))
    return df.select(key_hash(keys).alias("_kh")).agg(
        F.expr(f"approx_top_k_accumulate(_kh, {size})").alias("sketch"), F.count(F.lit(1)).alias("n"))


def merge_key_sketches(sketches: DataFrame) -> DataFrame:
    """Several sketches (rows as of ``key_sketch``, of one size) as one row for all their tables."""
    return sketches.agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"), F.sum("n").alias("n"))


def hot_keys(sketch: DataFrame, parts: int | None = None) -> DataFrame:
    """Keys (as ``_kh``) with more than one part's even share of the rows, and
    the ``_buckets`` that bring them down to it.

    At most ``parts`` rows by definition: that many keys at most can hold
    more than one ``parts``-th of all rows each.
    """
    parts = parts or default_parts(sketch)
    found = sketch.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {counters(parts)})")).alias("x"), "n")
    share = F.col("x.count") * F.lit(parts) / F.col("n")
    return found.filter(share > 1).select(F.col("x.item").alias("_kh"), F.ceil(share).cast("int").alias("_buckets"))


def hot_from_counts(counts: DataFrame, keys: Sequence[str], n: str, parts: int | None = None) -> DataFrame:
    """``hot_keys`` from exact counts (one row a key), where a plan has them
    anyway: the table isn't read again, since the aggregate's exchange is shared."""
    parts = parts or default_parts(counts)
    total = counts.agg(F.sum(n)).scalar()
    few = counts.select(key_hash(keys).alias("_kh"), (F.col(n) * F.lit(parts) / total).alias("share")).filter("share > 1")
    # keys that share a hash (one chance in 2^64) are one key here
    return few.groupBy("_kh").agg(F.ceil(F.sum("share")).cast("int").alias("_buckets"))


def broadcast_by_size(df: DataFrame) -> bool:
    """Will Spark broadcast this join side by its own size estimate?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def bucketed(df: DataFrame, small: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_bucket``: a hot key's rows are dealt to its buckets,
    its partner is copied into each; all else has bucket 0.

    A row's bucket comes from its content and the task that reads it, so equal
    rows spread over as many buckets as tasks hold them, and a task that runs
    again deals its rows as before.
    """
    spread = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    few = F.broadcast(hot)  # at most one row for each task of a shuffle
    dealt = F.pmod(F.xxhash64(*spread, F.spark_partition_id()), F.col("_buckets"))
    big = (df.withColumn("_kh", key_hash(keys)).join(few, "_kh", "left")
           .withColumn("_bucket", F.when(F.col("_buckets").isNotNull(), dealt).otherwise(0).cast("int")).drop("_kh", "_buckets"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_buckets", F.lit(1)) - 1))
    other = (small.withColumn("_kh", key_hash(keys)).join(few, "_kh", "left")
             .withColumn("_bucket", copies).drop("_kh", "_buckets"))
    return big, other


def skew_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left",
              hot: DataFrame | None = None) -> DataFrame:
    """Join ``big`` to a table with at most one row for each key, whatever the
    key's share of ``big`` (JN-10).  Keys match null-safe, the null key is
    a key like any other.  ``how``: inner, left, left_semi or left_anti.

    A small side that Spark broadcasts by its own size estimate needs no
    dealing.  Otherwise hot keys are found by a sketch over ``big``'s keys, or
    given as ``hot`` (rows as of ``hot_keys``, e.g. from stored sketches).
    """
    from stonefly.operators.joins import join_null_safe
    if hot is None:
        if broadcast_by_size(small):
            return join_null_safe(big, small, keys, how)
        hot = hot_keys(key_sketch(big, keys))
    b, s = bucketed(big, small, keys, hot)
    return join_null_safe(b, s, [*keys, "_bucket"], how).drop("_bucket")
