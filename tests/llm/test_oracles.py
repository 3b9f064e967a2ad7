"""Every training-data query that has SQL against DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from stonefly.llm import queries as Q

SF = "/root/testdata/sf0.001"


def rows(records, cols):
    norm = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(norm(r[c]) for c in cols) for r in records), key=str)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    df = Q.queries()[name](spark, SF)
    res = con.execute(Q.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = [dict(zip(cols, r, strict=True)) for r in res.fetchall()]
    assert sorted(cols) == sorted(df.columns)
    assert rows([r.asDict() for r in df.collect()], sorted(cols)) == rows(want, sorted(cols))
