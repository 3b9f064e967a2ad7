"""Numeric helpers (NUM-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` in plain IEEE arithmetic.

    Unlike ``round`` (which rounds the shortest decimal text of the double)
    this is the same operation in every engine, so results hash equal.
    """
    scale = float(10 ** digits)
    return F.floor(_c(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def round_half_up_sql(expr: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(FLOOR(({expr}) * CAST({scale!r} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({scale!r} AS DOUBLE))"


def round_r(c, digits: int = 0) -> Column:
    """R's ``round``: half to even (NUM-01), as ``rint(x * 10^d) / 10^d``: plain
    IEEE arithmetic, the same in every engine."""
    scale = float(10 ** digits)
    return F.rint(_c(c).cast("double") * F.lit(scale)) / F.lit(scale)


def round_r_sql(expr: str, digits: int = 0) -> str:
    scale = float(10 ** digits)
    return f"(round_even(({expr}) * CAST({scale!r} AS DOUBLE), 0) / CAST({scale!r} AS DOUBLE))"


def to_number(c, type_: str = "double") -> Column:
    """``as.numeric``: text that is not a number becomes null (NUM-02)."""
    return F.expr(f"try_cast(`{c}` as {type_})") if isinstance(c, str) else c.try_cast(type_)
