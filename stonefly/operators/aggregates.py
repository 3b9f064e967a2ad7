"""Aggregations, windows and top-k (AG-*, WN-*, SL-*).

Every operator here is written so that one key holding a large share of the
rows never lands whole in a single task: partial (map-side) aggregation is
used where possible, top-k is computed in two salted rounds, and "newest row
per key" is an aggregate over a struct instead of a sorted window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stonefly.functions.nulls import strict_max, strict_sum

DEFAULT_SALT_BUCKETS = 32


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def group_totals(df: DataFrame, keys: Sequence[str], value: str, how: str = "sum",
                 strict: bool = False, alias: str | None = None) -> DataFrame:
    """Sum / max / mean per key (AG-01..03).  ``strict`` reproduces R's
    behaviour without ``na.rm`` (one null makes the group null)."""
    alias = alias or f"{how}_{value}"
    if how == "sum":
        e = strict_sum(value) if strict else F.sum(value)
    elif how == "max":
        e = strict_max(value) if strict else F.max(value)
    elif how == "mean":
        e = F.avg(value)
    else:
        raise ValueError(how)
    return df.groupBy(*keys).agg(e.alias(alias))


def _group_limit_enabled(df: DataFrame, k: int) -> bool:
    """Spark 3.5+ plans ``row_number() <= k`` with a partial
    ``WindowGroupLimit`` before the shuffle when k is within this threshold."""
    try:
        return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "-1")) >= k
    except Exception:  # noqa: BLE001
        return False


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], k: int,
                    salt_cols: Sequence[str] | None = None, buckets: int = DEFAULT_SALT_BUCKETS,
                    rank_col: str = "rank", strategy: str = "auto") -> DataFrame:
    """Exact top-k rows per group, skew-safe.

    ``strategy="limit"`` (the default when Spark's window group limit is on
    for this k): one ``row_number() <= k`` window.  Spark then runs a
    partial group limit in every map task before the shuffle, so a hot group
    sends at most k rows per map partition to its final task.

    ``strategy="salted"``: two explicit rounds.  Round 1 ranks within (group,
    salt), the salt hashing ``salt_cols`` (the row identity), so a hot group
    is spread over ``buckets`` tasks that each keep k rows; round 2 ranks
    the <= k*buckets survivors.

    ``order_cols`` must be a total order (add a tie breaker) for the result
    to be deterministic.
    """
    order = _cols(order_cols)
    if strategy == "auto":
        strategy = "limit" if _group_limit_enabled(df, k) else "salted"
    if strategy == "limit":
        w = Window.partitionBy(*group_cols).orderBy(*order)
        return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
    salt_src = _cols(salt_cols) if salt_cols else [F.struct(*[F.col(c) for c in df.columns])]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_src), F.lit(buckets)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order)
    pre = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)


def newest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Newest row per key (WN-03): the row with the greatest ``order_cols``
    tuple.  ``max(struct(...))`` is a partial aggregate, so even a very large
    key is reduced map-side; the last order column breaks ties."""
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    s = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest])
    return (df.groupBy(*keys).agg(F.max(s).alias("_newest"))
            .select(*keys, *[F.col(f"_newest.{c}").alias(c) for c in list(order_cols) + rest]))


def repeated_groups(df: DataFrame, keys: Sequence[str], min_rows: int = 2,
                    count_col: str | None = None) -> DataFrame:
    """Rows whose key occurs at least ``min_rows`` times (WN-02, VAL-19).

    Counting is a partial aggregate; the rows come back through a join that
    matches null keys and splits hot ones, not a per-key window.  The keys are
    dealt out before they are counted, so no task holds its counters beside the
    sort buffers of the joins that ``df`` may end in; dealt by the task that reads
    them, too, so a hot key's rows go to as many tasks as hold them.
    """
    from stonefly.operators.skew import hot_from_counts, skew_join
    dealt = df.select(*keys, F.spark_partition_id().alias("_task")).repartition(*keys, "_task")
    every = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_from_counts(every, keys, "_n")
    counts = every.filter(F.col("_n") >= min_rows)
    if count_col:
        return skew_join(df, counts.withColumnRenamed("_n", count_col), keys, "inner", hot).select(*df.columns, count_col)
    return skew_join(df, counts.select(*keys), keys, "left_semi", hot)


def count_rows(df: DataFrame) -> int:
    """``nrow`` (AG-09); an action."""
    return df.count()


def global_range(df: DataFrame, c: str, extra: dict | None = None) -> DataFrame:
    """``range(x)`` as one row (AG-08); ``extra`` aggregates share the pass."""
    return df.agg(F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                  *[e.alias(n) for n, e in (extra or {}).items()])


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """``unique(x)`` (AG-06) - stays a DataFrame, never collected."""
    return df.select(c).distinct()
