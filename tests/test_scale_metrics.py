"""What the metric flow does once a line, once an order and once a sample."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stonefly.operators import metrics as M
from stonefly.plans import lab as LAB


def _plan(spark, name):
    from tests.conftest import SF_SMALL
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["published_metrics", "metrics_long", "parameter_table"])
def test_texts_are_made_below_the_join_with_lines(spark, name):
    plan = _plan(spark, name)
    assert "collect_set" not in plan
    join = min(plan.index(x) for x in ("(l_orderkey", "l_orderkey#") if x in plan)
    assert plan.index("gettimestamp") > join


def test_affinity_of_a_model_with_null_and_repeated_keys(spark):
    df = spark.createDataFrame([("a", None, "t1", 2.0, "g1"), ("a", None, "t2", 6.0, "g2"), ("a", None, "t3", 2.0, None),
                                ("b", 1, "t1", 1.0, "g1"), ("b", 1, "t2", 1.0, "g9"), ("c", 2, "t1", 5.0, "g1")],
                               "s string, method int, t string, n double, grp string")
    model = spark.createDataFrame([(None, "g1", 15.0), (None, "g2", 70.0), (None, "g3", 15.0), (None, None, 5.0),
                                   (1, "g1", 30.0), (1, "g1", 60.0), (1, "g2", None)], "method int, grp string, percent double")
    out = M.community_metrics(df, ["s", "method"], "t", "n", group_col="grp", model=model, model_keys=["method"]).collect()
    got = {r.s: r.percent_model_affinity for r in out}
    assert got == {"a": 15.0 + 60.0, "b": 30.0 + 50.0, "c": 0.0}


def test_own_columns_of_samples_come_from_rows_or_apart(spark):
    rows = spark.createDataFrame([("a", 1, "x", 1.0, "e1", 5.0), ("a", 1, "x", 2.0, "e2", 9.0), ("a", 1, "y", 1.0, "e1", None),
                                  ("b", None, "y", 3.0, None, None), (None, 1, "y", 3.0, "e3", 1.0)],
                                 "sid string, method int, taxon string, n double, event_id string, total double")
    taxa = spark.createDataFrame([("x", True, True, 1.0, 2.0, "g")], "taxon string, is_ept boolean, is_nco boolean, "
                                 "tolerance double, nbi_p_tolerance double, taxon_group string")
    for own in (None, rows.select("sid", "method", "event_id", "total")):
        out = LAB.sample_rows(rows, taxa, carry=["event_id"], largest=["total"], own=own)
        got = {(r.sid, r.method, r.event_id, r.total): {(x.taxon, x.n, x.taxon_group) for x in r.taxa}
               for r in out.select("sid", "method", "event_id", "total", F.col("taxa")).collect()}
        a = {("x", 3.0, "g"), ("y", 1.0, None)}
        assert got == {("a", 1, "e1", 9.0): a, ("a", 1, "e2", 9.0): a, ("b", None, None, None): {("y", 3.0, None)}}
