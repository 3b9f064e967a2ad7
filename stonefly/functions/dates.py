"""Date parsing, formatting, audits and key builders (DT-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# R strptime tokens -> Spark datetime pattern letters (fixed values).  Parsing
# accepts one or two digit fields like R; formatting pads like R.
_R_TO_SPARK_PARSE = {"%Y": "yyyy", "%y": "yy", "%m": "M", "%d": "d", "%H": "H", "%M": "m",
                     "%S": "s", "%B": "MMMM", "%b": "MMM"}
_R_TO_SPARK_FORMAT = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm",
                      "%S": "ss", "%B": "MMMM", "%b": "MMM"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def spark_pattern(fmt: str, parse: bool = True) -> str:
    """Translate an R format such as ``%m/%d/%Y`` to ``M/d/yyyy`` (parsing)
    or ``MM/dd/yyyy`` (formatting).  Spark patterns pass through unchanged."""
    if "%" not in fmt:
        return fmt
    out = fmt
    for r, s in (_R_TO_SPARK_PARSE if parse else _R_TO_SPARK_FORMAT).items():
        out = out.replace(r, s)
    return out


def parse_date(c, fmt: str) -> Column:
    """``as.Date(x, fmt)``: null when the text does not fit."""
    return F.try_to_date(_c(c).cast("string"), spark_pattern(fmt))


def parse_date_any(c, formats: Sequence[str]) -> Column:
    """``parse_date_time(x, orders=c(f1, f2))``: first format that fits."""
    return F.coalesce(*[parse_date(c, f) for f in formats])


def format_date(c, fmt: str) -> Column:
    return F.date_format(_c(c), spark_pattern(fmt, parse=False))


def bad_date_count(c, formats: Sequence[str]) -> Column:
    """Aggregate: non-null texts that fit none of ``formats`` (DT-04)."""
    c = _c(c)
    return F.count_if(c.isNotNull() & parse_date_any(c, formats).isNull())


def event_id(site, ts) -> Column:
    """``site_yyyyMMddTHHmm``."""
    return F.concat(_c(site).cast("string"), F.lit("_"), F.date_format(_c(ts), "yyyyMMdd'T'HHmm"))


def linked_id(site, date, method, replicate) -> Column:
    """Sample key ``site_yyyyMMdd_method_replicate``."""
    sep = F.lit("_")
    return F.concat(_c(site).cast("string"), sep, F.date_format(_c(date), "yyyyMMdd"), sep,
                    _c(method).cast("string"), sep, _c(replicate).cast("string"))
