"""Column shaping (PR-*).  Schema-level work runs on the driver from
``df.columns`` / ``df.schema`` only; no data is touched."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stonefly.functions.text import screaming_snake, split_fixed


def select_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """``select(keep, starts_with(prefix))`` (PR-03)."""
    return df.select(*keep, *[c for c in df.columns if c.startswith(prefix) and c not in keep])


def rename_from_table(df: DataFrame, mapping: Mapping[str, str], subset: bool = True) -> DataFrame:
    """Rename with an old->new table, only names present (PR-07); with
    ``subset`` keep just the renamed columns, in table order."""
    present = {o: n for o, n in mapping.items() if o in df.columns}
    out = df.withColumnsRenamed(present)
    if subset:
        seen, cols = set(), []
        for n in present.values():
            if n not in seen:
                seen.add(n)
                cols.append(n)
        out = out.select(*cols)
    return out


def upper_names(df: DataFrame) -> DataFrame:
    """Upper-case all column names (PR-08)."""
    return df.toDF(*[c.upper() for c in df.columns])


def clean_names(df: DataFrame) -> DataFrame:
    """Screaming-snake column names, de-duplicated with ``_2``, ``_3`` (PR-09)."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = screaming_snake(c)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        names.append(n)
    return df.toDF(*names)


def add_constants(df: DataFrame, constants: Mapping[str, object], types: Mapping[str, str] | None = None) -> DataFrame:
    """Constant and typed-null columns (PR-10)."""
    types = types or {}
    cols = {}
    for k, v in constants.items():
        e = F.lit(v)
        if k in types:
            e = e.cast(types[k])
        elif v is None:
            e = e.cast("string")
        cols[k] = e
    return df.withColumns(cols)


def across(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column], suffix: str = "",
           before: bool = False) -> DataFrame:
    """Apply ``fn`` to each column; with a suffix the results are new
    columns, placed first when ``before`` (PR-11)."""
    new = {c + suffix: fn(F.col(c)) for c in cols}
    out = df.withColumns(new)
    if before and suffix:
        first = list(new)
        out = out.select(*first, *[c for c in out.columns if c not in new])
    return out


def mutate_by_type(df: DataFrame, dtype: type, fn: Callable[[Column], Column]) -> DataFrame:
    """``mutate_if(is.<type>, fn)`` over the schema (PR-12)."""
    cols = {f.name: fn(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, dtype)}
    return df.withColumns(cols) if cols else df


def round_numeric(df: DataFrame, digits: int = 3) -> DataFrame:
    """``mutate_if(is.numeric, round, digits)``: doubles rounded, integers kept."""
    return mutate_by_type(df, (T.DoubleType, T.FloatType, T.DecimalType), lambda c: F.round(c, digits))


def blank_nulls(df: DataFrame) -> DataFrame:
    """Sink-side ``df[is.na(df)] <- ""`` (PR-13): every column as text,
    null written as empty."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def bind_split(df: DataFrame, col: str, sep: str, names: Sequence[str]) -> DataFrame:
    """``cbind(df, str_split_fixed(df$col, sep, n))`` with names (PR-14)."""
    parts = split_fixed(col, sep, len(names))
    return df.withColumns(dict(zip(names, parts)))
