"""Set operations (SET-*)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    """``rbind`` (same columns) or ``bind_rows`` (``fill_missing=True``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), dfs)


def value_except(a: DataFrame, b: DataFrame, col_a: str, col_b: str | None = None) -> DataFrame:
    """``setdiff(a$x, b$y)``: distinct values of a not in b.  Written as a
    null-safe anti join so one null in b does not hide every value."""
    col_b = col_b or col_a
    left = a.select(F.col(col_a).alias("value")).distinct()
    right = b.select(F.col(col_b).alias("value")).distinct()
    return left.join(right, left["value"].eqNullSafe(right["value"]), "left_anti")


def row_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that are not rows of b (SET-04)."""
    return a.subtract(b.select(*a.columns))


def column_diff(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of a missing from b (SET-05); schema only, no job."""
    bset = set(b.columns)
    return [c for c in a.columns if c not in bset]
