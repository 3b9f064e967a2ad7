"""Join operators (JN-*).

Broadcast decisions are left to Spark's own size check: a side is broadcast
when Catalyst's estimate is under ``spark.sql.autoBroadcastJoinThreshold``,
and AQE re-decides from the actual shuffle sizes at runtime (and splits a
skewed partition of a join of two shuffles).  Configuration tables are in-plan
literals (``sources.literal``) so their estimate is exact and tiny.  Joins back
to an aggregate or a lookup deal hot keys to several tasks (``skew.skew_join``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stonefly.operators.skew import skew_join


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join where null keys match each other (dplyr/merge default).

    The output carries the left key columns (for full joins the keys are
    coalesced) and the right side's remaining columns.
    """
    la, ra = left.alias("_l"), right.alias("_r")

    def L(c):
        return F.col(f"_l.`{c}`")

    def R(c):
        return F.col(f"_r.`{c}`")

    cond = reduce(lambda a, b: a & b, [L(k).eqNullSafe(R(k)) for k in keys])
    joined = la.join(ra, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    if how in ("full", "outer", "full_outer", "fullouter"):
        key_cols = [F.coalesce(L(k), R(k)).alias(k) for k in keys]
    elif how in ("right", "right_outer"):
        key_cols = [R(k).alias(k) for k in keys]
    else:
        key_cols = [L(k).alias(k) for k in keys]
    rest_l = [L(c).alias(c) for c in left.columns if c not in keys]
    rest_r = [R(c).alias(c) for c in right.columns if c not in keys and c not in left.columns]
    return joined.select(*key_cols, *rest_l, *rest_r)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left", null_safe: bool = True) -> DataFrame:
    """Join on every shared column name (JN-04, JN-05 with ``how="full"``)."""
    keys = [c for c in left.columns if c in set(right.columns)]
    if not keys:
        raise ValueError("natural join needs at least one shared column")
    if null_safe:
        return join_null_safe(left, right, keys, how)
    return left.join(right, keys, how)


def join_renamed(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                 right_keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``merge(by.x=, by.y=)``: keys with different names; the right key
    columns are dropped from the output (JN-01, JN-06)."""
    cond = reduce(lambda a, b: a & b, [left[lk] == right[rk] for lk, rk in zip(left_keys, right_keys)])
    out = left.join(right, cond, how)
    for rk in right_keys:
        if rk not in left_keys:
            out = out.drop(right[rk])
    return out


def join_with_suffixes(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                       suffixes: tuple[str, str] = (".x", ".y")) -> DataFrame:
    """dplyr-style name collisions: shared non-key columns get suffixes (JN-11)."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    lren = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    rren = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return join_null_safe(lren, rren, keys, how)


def fold_joins(base: DataFrame, others: Sequence[DataFrame], keys: Sequence[str], how: str = "left") -> DataFrame:
    """``reduce(full_join, by=UID)`` over tables sharing the key (JN-09)."""
    out = base
    for o in others:
        out = join_null_safe(out, o, keys, how)
    return out


def with_group_aggregates(df: DataFrame, keys: Sequence[str], aggs: dict) -> DataFrame:
    """Grouped mutate: attach per-group aggregates to every row (JN-10, WN-01).

    Written as a partial aggregate plus a join back rather than a window:
    the aggregate combines map-side and the join splits hot keys, while a
    window would put the whole group in one task.  Null keys are a group.
    """
    agg = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
    return skew_join(df, agg, keys).select(*df.columns, *aggs)


def semi_flag(df: DataFrame, other: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Add a boolean ``flag``: row has a partner in ``other`` (no fan-out:
    the partner keys are de-duplicated first)."""
    marks = other.select(*keys).dropDuplicates().withColumn(flag, F.lit(True))
    out = skew_join(df, marks, keys).select(*df.columns, flag)
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def unique_or_fail(df: DataFrame, keys: Sequence[str], what: str = "lookup") -> DataFrame:
    """``df`` with at most one row for each key, or a failing job (JN-12).

    The count rides along in the plan: no action is started here, and a
    join's write fails with the key named when its lookup would fan out.
    """
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("_"))).alias("_r"))
    named = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null"))) for k in keys])
    message = F.concat(F.lit(f"{what}: "), F.col("_n").cast("string"), F.lit(" rows for the key "), named)
    # the check is part of a key's value, so no rewrite of the plan drops it
    first = F.when(F.col("_n") > 1, F.raise_error(message).cast(df.schema[keys[0]].dataType)).otherwise(F.col(f"`{keys[0]}`"))
    picked = {keys[0]: first} | {k: F.col(f"`{k}`") for k in keys[1:]} | {c: F.col(f"_r.`{c}`") for c in rest}
    return one.select(*[picked[c].alias(c) for c in df.columns])


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Join fan-out guard (JN-12): raise when ``keys`` repeat in ``df``."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"keys {list(keys)} are not unique: a join on them would fan out")
