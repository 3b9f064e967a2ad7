"""Lazy guards of lookups, the survey register, and profiles merged over runs."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from stonefly.operators import joins as J
from stonefly.operators import lookup as L
from stonefly.operators import quality as Q
from stonefly.plans import warehouse as WH


def test_guard_fails_the_job_not_the_plan(spark):
    table = spark.createDataFrame([("a", 1, 5), ("a", 1, 6), ("b", 2, None), (None, None, 1)], "k string, j int, v int")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, j int")
    guarded = J.unique_or_fail(table, ["k", "j"], "prices")         # no job yet
    assert guarded.columns == table.columns
    with pytest.raises(Exception, match="prices: 2 rows for the key k=a, j=1"):
        J.join_null_safe(rows, guarded, ["k", "j"]).collect()
    fine = J.unique_or_fail(table.filter("v IS NULL OR v <> 6"), ["k", "j"])
    assert sorted(map(str, map(tuple, fine.collect()))) == sorted(map(str, [("a", 1, 5), ("b", 2, None), (None, None, 1)]))


def test_strict_lookups_fail_on_conflicts_and_take_repeats(spark):
    df = spark.createDataFrame([("a",), ("b",)], "site string")
    repeats = spark.createDataFrame([("a", "x"), ("a", "x")], "old string, new string")
    assert sorted(r.site for r in L.replace_from_crosswalk(df, "site", repeats, "old", "new", strict=True).collect()) == ["b", "x"]
    conflict = spark.createDataFrame([("a", "x"), ("a", "y")], "old string, new string")
    with pytest.raises(Exception, match="rows for the key _old=a"):
        L.replace_from_crosswalk(df, "site", conflict, "old", "new", strict=True).collect()
    with pytest.raises(Exception, match="_lk=a"):
        L.lookup_join(df, "site", conflict, "old", "new", "out", strict=True).collect()


def test_survey_fan_out_fails_and_register_has_flags(spark):
    samples = spark.createDataFrame([("s1", "d"), ("s2", "d"), ("s2", "d")], "site_id string, DATE string")
    two = spark.createDataFrame([("s1", "d", "f1"), ("s1", "d", "f2")], "site_id string, DATE string, final_id string")
    with pytest.raises(Exception, match="survey events: 2 rows for the key site_id=s1, DATE=d"):
        WH.attach_events(samples, two)[0].collect()
    _, missing = WH.attach_events(samples, two.filter("final_id = 'f1'"))
    sites = spark.createDataFrame([("s1",)], "code string")
    assert [tuple(r) for r in WH.missing_survey_register(missing.select("site_id", "DATE"), sites).collect()] == [("s2", "d", "T", "T", "")]
    notes = spark.createDataFrame([("s2", "F", "T", "no date fits")], "site string, missing_site string, missing_survey string, notes string")
    assert [tuple(r) for r in WH.missing_survey_register(missing.select("site_id", "DATE"), sites, notes).collect()] == [("s2", "d", "F", "T", "no date fits")]


def test_profiles_merge_over_runs(spark):
    n = 30_000
    df = spark.range(n).select((F.col("id") % 7).alias("run_no"), F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % n).cast("double")).alias("x"),
                               F.concat(F.lit("t"), (F.col("id") % 1000).cast("string")).alias("t"), F.lit(None).cast("int").alias("none"))
    parts = Q.profile_sketches(df, F.col("run_no").cast("string"), ["x", "t", "none"])
    assert parts.count() == 21 and "Expand" not in parts._jdf.queryExecution().executedPlan().toString()
    got = {r.column_name: r for r in Q.merge_profiles(parts, (0.25, 0.5, 0.75, 0.9)).collect()}
    xs = sorted(float(i * 7919 % n) for i in range(n) if i % 10)
    x = got["x"]
    assert (x.n, x.n_missing, x.min, x.max) == (n, n // 10, xs[0], xs[-1])
    assert math.isclose(x.mean, statistics.fmean(xs), rel_tol=1e-12) and math.isclose(x.sd, statistics.stdev(xs), rel_tol=1e-9)
    for p in (25, 50, 75, 90):
        low = sum(v < x[f"p{p}"] for v in xs) / len(xs)
        high = sum(v <= x[f"p{p}"] for v in xs) / len(xs)
        assert low <= p / 100 + 2 * Q.KLL_RANK_ERROR and high >= p / 100 - 2 * Q.KLL_RANK_ERROR
    assert abs(x.n_unique - len(set(xs))) <= 2 * Q.HLL_ERROR * len(set(xs)) and abs(got["t"].n_unique - 1000) <= 50
    assert (got["t"].mean, got["t"].p50, got["none"].n_missing, got["none"].mean, got["none"].p50) == (None, None, n, None, None)
    whole = {r.column_name: r for r in Q.merge_profiles(Q.profile_sketches(df.drop("run_no"), "all")).collect()}
    assert math.isclose(whole["x"].sd, x.sd, rel_tol=1e-9) and whole["t"].n_unique == pytest.approx(got["t"].n_unique, rel=0.05)
