"""Reshaping (RS-*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], names_to: str = "name",
                 values_to: str = "value", drop_na: bool = True, value_type: str = "double") -> DataFrame:
    """``pivot_longer(cols, names_to, values_to, values_drop_na)``.  Narrow
    transformation: no shuffle, one output row per (row, value column).

    The pairs of a row are one array that ``inline`` spreads; nulls are left
    out of it.  (``unpivot`` plans an Expand, for which Spark 4.1 generates
    code that doesn't compile when later expressions share work, so that
    stage ran interpreted.)
    """
    pairs = F.array(*[F.struct(F.lit(c).alias(names_to), F.col(c).cast(value_type).alias(values_to)) for c in values])
    if drop_na:
        pairs = F.filter(pairs, lambda x: x[values_to].isNotNull())
    return df.select(*ids, F.inline(pairs))


def split_metric_name(df: DataFrame, name_col: str = "metric_name", type_col: str = "metric_type",
                      prefixes: Mapping[str, str] | None = None, default_raw: Sequence[str] = ()) -> DataFrame:
    """``raw_x`` / ``score_x`` -> type and bare name (RS-02).  First matching
    prefix wins; names listed in ``default_raw`` count as raw."""
    prefixes = prefixes or {"raw_": "raw", "score_": "score"}
    n = F.col(name_col)
    t = None
    for p, label in prefixes.items():
        cond = n.startswith(p)
        t = F.when(cond, F.lit(label)) if t is None else t.when(cond, F.lit(label))
    if default_raw:
        t = t.when(n.isin(list(default_raw)), F.lit("raw"))
    pattern = "^(" + "|".join(prefixes) + ")"
    return df.withColumn(type_col, t).withColumn(name_col, F.regexp_replace(n, pattern, ""))


def split_targets(df: DataFrame, targets: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One wide table -> target tables: per target its columns, distinct
    (RS-03, RS-05).  Plans stay lazy."""
    out = {}
    for name, cols in targets.items():
        present = [c for c in cols if c in df.columns]
        out[name] = df.select(*present).distinct()
    return out


def struct_to_columns(df: DataFrame, struct_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``unnest_wider`` (RS-04)."""
    return df.select(*keep, f"{struct_col}.*")
