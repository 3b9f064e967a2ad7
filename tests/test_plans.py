"""Structural checks on the physical plans of every registered query."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stonefly.plans import catalog

SF = "/root/testdata/sf0.001"
# No registered query needs a nested-loop join (name matching is an n-gram equi-join).
NESTED_LOOP_OK: set = set()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# The queries of the library proper; the training-data operators are free in style.
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_has_no_cartesian_or_python(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(catalog.queries()[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "CartesianProduct" not in plan
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF)", plan)
    if name not in NESTED_LOOP_OK:
        assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    """A narrow query reads only the columns it needs."""
    df = E.queries()["filtered_orders"](spark, SF)
    plan = _plan(df)
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1).split(",")
    assert len(read) == 5 and not any(c.startswith("o_orderdate") for c in read)   # 5 of 6 columns
    assert "EqualTo(o_orderstatus,F)" in plan                                       # filter reaches the scan


def test_top_k_limits_before_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(E.queries()["top3_taxa"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # partial limit below the exchange, final limit above it
    assert re.search(r"WindowGroupLimit.*\n(.*\n)*.*Exchange hashpartitioning\(sample_id.*\n(.*\n)*.*WindowGroupLimit", plan)
