"""Driver contract: entry(), registry, and every query against DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from stonefly.plans import catalog
from stonefly.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_registry_has_sql_for_every_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "score_bioassessment_profile" in df.columns


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# The training-data queries have tests of their own.
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    cols = sorted(sdf.columns)
    assert _rows(srows, cols) == _rows(drows, cols)


def test_entry_schema_is_stable(spark):
    df = E.entry(spark)
    assert df.columns == [
        "sample_id", "o_orderstatus", "method", "total_individuals", "richness", "ept_richness",
        "hilsenhoff_biotic_index", "percent_model_affinity", "nutrient_biotic_index_phosphorus",
        "score_richness", "score_ept_richness", "score_hilsenhoff_biotic_index", "score_percent_model_affinity",
        "score_nutrient_biotic_index_phosphorus", "score_bioassessment_profile", "impact_category"]
    assert dict(df.dtypes)["score_bioassessment_profile"] == "double"
