"""Value maps, corrections and crosswalks (CND-02, DOM-04/12..16/30).

Fixed maps become ``CASE`` expressions (JVM-side, no join).  Maps that are
tables join as a lookup: one row for each key by a stated rule, so no row can
fan out, and broadcast only when the estimate says the table is small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stonefly.functions.text import ordered_replace
from stonefly.operators.joins import unique_or_fail
from stonefly.operators.skew import skew_join


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(c, mapping: Mapping, default=None, keep_unmatched: bool = False) -> Column:
    """``case_match(x, a ~ b, ..., .default=)`` for a fixed map."""
    col = _c(c)
    expr = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    fallback = col if keep_unmatched else F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def least_per_key(table: DataFrame, keys: Sequence[str], strict: bool = False) -> DataFrame:
    """One row for each key: the one with the least other columns, in their
    order and nulls last, so a conflicting lookup gives the same choice for
    any row order.  ``strict``: rows that agree count once, and a key whose
    rows differ fails the job that reads it, with the key named (JN-12)."""
    if strict:
        return unique_or_fail(table.distinct(), keys)
    rest = [c for c in table.columns if c not in keys]
    if not rest:
        return table.distinct()
    ranked = F.struct(*[x for c in rest for x in (F.col(f"`{c}`").isNull().alias(f"_no_{c}"), F.col(f"`{c}`"))])
    least = table.groupBy(*keys).agg(F.min(ranked).alias("_least"))
    return least.select(*keys, *[F.col(f"_least.`{c}`").alias(c) for c in rest])


def lookup_conflicts(table: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys of a lookup with several different values (JN-12): the keys, how
    many, and the choice that the joins here make."""
    several = table.select(*keys, *values).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values")).filter("n_values > 1")
    return skew_join(several, least_per_key(table.select(*keys, *values), keys), keys)


def lookup_join(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str, out: str,
                keep_unmatched: bool = True, strict: bool = False) -> DataFrame:
    """Map ``key`` through a two-column table; unmatched keep the old value
    (or null) - a table-driven ``case_match``.  ``strict``: see ``least_per_key``."""
    t = least_per_key(table.filter(F.col(table_key).isNotNull()).select(F.col(table_key).alias("_lk"), F.col(value).alias("_lv")), ["_lk"], strict)
    j = skew_join(df.withColumn("_lk", F.col(key)), t, ["_lk"])
    e = F.coalesce(F.col("_lv"), F.col(key)) if keep_unmatched else F.col("_lv")
    return j.select(*df.columns, "_lk", "_lv").withColumn(out, e).drop("_lk", "_lv")


def replace_from_crosswalk(df: DataFrame, col: str, crosswalk: DataFrame, old: str, new: str,
                           flag: str | None = "changed", strict: bool = False) -> DataFrame:
    """Superseded ids -> current ids (DOM-04 ``site_check``, DOM-30).

    Crosswalk rows with old == new, or with an empty/missing new id (an
    adjustment table's blank rows), are dropped; of several new ids for one
    old id the least is taken (``lookup_conflicts`` lists them; ``strict``
    fails); a left join replaces matched ids and flags them.
    """
    cw = (crosswalk.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
          .filter((F.col("_old") != F.col("_new")) & F.col("_new").isNotNull() & (F.trim(F.col("_new")) != ""))
          .filter(F.col("_old").isNotNull()))
    j = skew_join(df.withColumn("_old", F.col(col)), least_per_key(cw, ["_old"], strict), ["_old"])
    out = j.select(*df.columns, "_new").withColumn(col, F.coalesce(F.col("_new"), F.col(col)))
    if flag:
        out = out.withColumn(flag, F.col("_new").isNotNull())
    return out.drop("_new")


def correct_distinct(df: DataFrame, col: str, rules: Sequence, out: str | None = None) -> DataFrame:
    """Ordered regex corrections of ``col`` (STR-09, DOM-15/27) as one
    expression on each row: the plan below runs once and nothing is shuffled."""
    return df.withColumn(out or col, ordered_replace(col, rules))


def apply_key_corrections(df: DataFrame, keys: Sequence[str], corrections: DataFrame,
                          targets: Sequence[str], strict: bool = False) -> DataFrame:
    """Manual corrections keyed by (site, date, ...) (DOM-13): each target
    column takes the correction's value where one exists.  ``strict``: see
    ``least_per_key``."""
    c = least_per_key(corrections.select(*keys, *[F.col(t).alias(f"_fix_{t}") for t in targets]), keys, strict)
    j = skew_join(df, c, keys).select(*df.columns, *[f"_fix_{t}" for t in targets])
    return j.withColumns({t: F.coalesce(F.col(f"_fix_{t}"), F.col(t)) for t in targets}).drop(
        *[f"_fix_{t}" for t in targets])
