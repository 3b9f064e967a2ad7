"""Registry of the queries run on the driver tables and their SQL oracles."""

from __future__ import annotations

from stonefly.plans import (domain_queries, flow_queries, metric_queries, quality_queries, relational_queries, shaping_queries,
                            text_queries)

_MODULES = [metric_queries, relational_queries, text_queries, domain_queries, quality_queries, shaping_queries, flow_queries]


def queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
