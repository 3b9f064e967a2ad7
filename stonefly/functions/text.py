"""String functions (STR-*), all JVM-side built-in expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fixed(c, sep: str, n: int) -> list[Column]:
    """``str_split_fixed(x, sep, n)``: n pieces, the rest stays in the last
    piece, missing pieces are ``""``; a null input gives null pieces."""
    c = _c(c)
    arr = F.split(c, re.escape(sep), n)
    return [F.when(c.isNotNull(), F.coalesce(F.try_element_at(arr, F.lit(i + 1)), F.lit("")))
            for i in range(n)]


def right(c, n: int) -> Column:
    """Last n characters."""
    return F.right(_c(c), F.lit(n))


def substr_range(c, start: int, stop: int) -> Column:
    """``substr(x, start, stop)`` with 1-based inclusive bounds."""
    return F.substring(_c(c), start, max(stop - start + 1, 0))


def lpad_keep(c, width: int, pad: str = "0") -> Column:
    """Left pad to ``width`` but never truncate a longer value."""
    c = _c(c).cast("string")
    return F.when(F.char_length(c) >= width, c).otherwise(F.lpad(c, width, pad))


def replace_first(c, pattern: str, replacement: str) -> Column:
    """``sub`` / ``str_replace``: replace the first regex match only."""
    rep = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(c), "(?s)^(?<stoneflypre>.*?)(?:" + pattern + ")", "${stoneflypre}" + rep)


def replace_all(c, pattern: str, replacement: str, literal: bool = False) -> Column:
    """``gsub`` / ``str_replace_all``; ``literal`` for fixed strings."""
    if literal:
        return F.replace(_c(c), F.lit(pattern), F.lit(replacement))
    rep = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(c), pattern, rep)


def remove_all(c, pattern: str) -> Column:
    return F.regexp_replace(_c(c), pattern, "")


def drop_after_space(c) -> Column:
    """``gsub(" .*$", "", x)``: keep the first word."""
    return F.regexp_replace(_c(c), " .*$", "")


def ordered_replace(c, rules: Sequence) -> Column:
    """Apply ``(pattern, replacement[, literal])`` rules in sequence, each to
    the running value (STR-09).  Order matters and is kept."""
    out = _c(c)
    for r in rules:
        pattern, replacement = r[0], r[1]
        literal = bool(r[2]) if len(r) > 2 else False
        out = replace_all(out, pattern, replacement, literal)
    return out


def whole_id_rules(rules: Iterable, suffix: str = r"(_\d{8}.*)?") -> list[tuple]:
    """Turn literal id corrections into anchored regexes: the whole site part
    must match (dots are literal), an optional date/event tail is kept."""
    out = []
    for r in rules:
        old, new = r[0], r[1]
        out.append(("^" + re.escape(old) + "(?=" + suffix + "$)", new, False))
    return out


def normalise_taxon(c) -> Column:
    """lower case, spaces to ``_``, trimmed (the species check normaliser)."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(c)), " ", "_"), r"^\s+|\s+$", "")


def collapse_sentence(arr, sep: str = ", ", last: str = ", and ") -> Column:
    """Join an array like ``glue_collapse(sep=, last=)`` (AG-11)."""
    a = _c(arr)
    n = F.size(a)
    head = F.array_join(F.slice(a, 1, F.greatest(n - 1, F.lit(1))), sep)
    return (F.when(n <= 0, F.lit(""))
            .when(n == 1, F.element_at(a, 1))
            .otherwise(F.concat(head, F.lit(last), F.element_at(a, -1))))


def screaming_snake(name: str) -> str:
    """``janitor::clean_names("screaming_snake")`` for one column name."""
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name.strip())
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_")
    s = re.sub(r"_+", "_", s).upper()
    if not s:
        s = "X"
    if s[0].isdigit():
        s = "X" + s
    return s
