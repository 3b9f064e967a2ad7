"""Null rules of the source data model kept explicit.

* membership never yields null (``NA %in% x`` is FALSE),
* joins may match null with null,
* a plain ``sum``/``max`` is null as soon as one input is null,
* ``paste`` writes a null as the text ``NA`` (parity mode only).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def isin_safe(c, values: Iterable) -> Column:
    """``c %in% values``: True/False, never null."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def not_in_safe(c, values: Iterable) -> Column:
    """``!c %in% values``: a null value is *not* in the set, so it is kept."""
    return ~isin_safe(c, values)


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence) -> Column:
    """AND of ``<=>`` per key; ``keys`` holds names or (left, right) name pairs."""
    cond = None
    for k in keys:
        lk, rk = (k, k) if isinstance(k, str) else k
        c = left[lk].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


def strict_sum(c) -> Column:
    """``sum(x)`` without ``na.rm``: null when any input row is null."""
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def strict_max(c) -> Column:
    """``max(x)`` without ``na.rm``."""
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.max(c))


def paste(*cols, sep: str = " ", parity: bool = False) -> Column:
    """``paste(..., sep=)``.  Default: null if any part is null (keeps bad keys
    visible to the checks).  ``parity=True`` writes the text ``NA`` instead."""
    parts = [_c(c).cast("string") for c in cols]
    if parity:
        return F.concat_ws(sep, *[F.coalesce(p, F.lit("NA")) for p in parts])
    out = F.concat_ws(sep, *parts)
    any_null = None
    for p in parts:
        t = p.isNull()
        any_null = t if any_null is None else any_null | t
    return F.when(~any_null, out)


def replace_na(c, value) -> Column:
    """``replace_na(x, v)``."""
    return F.coalesce(_c(c), F.lit(value))


def all_true(cols: Iterable) -> Column:
    """Row-wise AND over boolean columns, null counted as False (BOOL-01)."""
    out = None
    for c in cols:
        t = F.coalesce(_c(c), F.lit(False))
        out = t if out is None else out & t
    return out if out is not None else F.lit(True)
