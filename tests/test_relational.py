"""Joins, set operations, reshape, substring matching."""

import pytest
from pyspark.sql import functions as F

from stonefly.operators import joins as J
from stonefly.operators import reshape as R
from stonefly.operators import setops as SO
from stonefly.operators.text_match import rows_containing_any


def test_natural_full_join_coalesces_keys(spark):
    a = spark.createDataFrame([("s1", 1.0), ("s2", 2.0), (None, 9.0)], "id string, x double")
    b = spark.createDataFrame([("s2", 20.0), ("s3", 30.0), (None, 90.0)], "id string, y double")
    got = sorted(J.natural_join(a, b, "full").collect(), key=lambda r: str(r.id))
    assert [tuple(r) for r in got] == [(None, 9.0, 90.0), ("s1", 1.0, None), ("s2", 2.0, 20.0), ("s3", None, 30.0)]


def test_group_aggregates_equal_window(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0)], "k int, v double")
    got = sorted(tuple(r) for r in J.with_group_aggregates(df, ["k"], {"m": F.avg("v")}).collect())
    want = sorted(tuple(r) for r in df.withColumn("m", F.avg("v").over(Window.partitionBy("k"))).collect())
    assert got == want


def test_semi_flag_has_no_fanout(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    got = sorted(tuple(r) for r in J.semi_flag(df, other, ["k"], "has").collect())
    assert got == [(1, True), (2, False)]


def test_assert_unique_raises(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        J.assert_unique(df, ["k"])


def test_join_with_suffixes(spark):
    a = spark.createDataFrame([(1, "a")], "k int, site string")
    b = spark.createDataFrame([(1, "b")], "k int, site string")
    assert J.join_with_suffixes(a, b, ["k"]).columns == ["k", "site.x", "site.y"]


def test_union_and_except(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    u = SO.union_all([a, b], fill_missing=True)
    assert sorted(u.columns) == ["a", "b", "k"] and u.count() == 2
    v1 = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    v2 = spark.createDataFrame([(2,), (None,)], "v int")
    assert [r[0] for r in SO.value_except(v1, v2, "v").collect()] == [1]
    assert SO.column_diff(a, b) == ["a"]


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([(1, 1.0, None, 3.0), (2, 4.0, 5.0, 6.0)], "id int, raw_a double, raw_b double, score_c double")
    long = R.wide_to_long(df, ["id"], ["raw_a", "raw_b", "score_c"], "name", "value")
    assert long.count() == 5
    back = long.groupBy("id").pivot("name", ["raw_a", "raw_b", "score_c"]).agg(F.first("value"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    split = R.split_metric_name(long, "name", "unit")
    assert {(r.name, r.unit) for r in split.collect()} == {("a", "raw"), ("b", "raw"), ("c", "score")}


def test_contains_any_matches_brute_force(spark):
    rows = [(1, "hydropsyche_betteni", "trichoptera"), (2, "baetis", "ephemeroptera"), (3, "ab", "x"),
            (4, None, "plecoptera"), (5, "chironomus", "diptera"), (6, "", None), (7, "éa世", "世世"), (3, "ab", "x")]
    df = spark.createDataFrame(rows, "id int, name string, _v string")
    for ws in (["psyche", "a", "pleco", "zzz", None, "", "a"], ["世世", "éa"], [None], []):
        words = spark.createDataFrame([(w,) for w in ws], "w string")
        got = sorted(r.id for r in rows_containing_any(df, ["name", "_v"], words, "w").collect())
        want = sorted({r[0] for r in rows if any(w and (w in (r[1] or "") or w in (r[2] or "")) for w in ws)})
        assert got == want


def test_contains_any_random_against_brute_force(spark):
    import random
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abc") for _ in range(n))
    rows = [(i, text(rng.randint(0, 9)), text(rng.randint(0, 9))) for i in range(300)]
    names = [text(rng.randint(1, 6)) for _ in range(25)]
    got = rows_containing_any(spark.createDataFrame(rows, "id int, x string, y string"), ["x", "y"], spark.createDataFrame([(n,) for n in names], "w string"), "w")
    assert sorted(r.id for r in got.collect()) == [i for i, x, y in rows if any(n in x or n in y for n in names)]


def test_contains_any_reads_the_table_twice(spark):
    d = "/root/testdata/sf0.001"
    part = spark.read.parquet(f"{d}/part.parquet").select("p_name", "p_type", "p_brand")
    names = spark.read.parquet(f"{d}/supplier.parquet").select("s_name")
    out = rows_containing_any(part, ["p_name", "p_type", "p_brand"], names, "s_name")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("part.parquet") <= 2 and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_skew_join_is_exact_for_hot_and_null_keys(spark, how):
    from stonefly.operators.skew import skew_join
    # key 1 holds most rows (hot); key 3 has no partner; key 4 only on the small side; the null keys match
    big = spark.createDataFrame([(1, i) for i in range(300)] + [(2, 0), (2, 1), (3, 0), (None, 0), (None, 0)], "k int, i int")
    small = spark.createDataFrame([(1, "one"), (2, "two"), (4, "four"), (None, "none")], "k int, name string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(map(str, map(tuple, skew_join(big, small, ["k"], how).collect())))
        want = sorted(map(str, map(tuple, J.join_null_safe(big, small, ["k"], how).collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want and len(got) == {"left": 305, "inner": 304, "left_semi": 304, "left_anti": 1}[how]


def test_null_keys_are_a_group(spark):
    import stonefly.operators.joins as J
    from stonefly.operators.aggregates import repeated_groups
    from stonefly.operators.quality import duplicate_rows
    df = spark.createDataFrame([("e1", None, 5.0), ("e1", None, 7.0), ("e2", 1, 1.0), (None, None, 2.0)], "e string, r int, v double")
    got = {(r.e, r.r, r.v): r.m for r in J.with_group_aggregates(df, ["e", "r"], {"m": F.avg("v")}).collect()}
    assert got == {("e1", None, 5.0): 6.0, ("e1", None, 7.0): 6.0, ("e2", 1, 1.0): 1.0, (None, None, 2.0): 2.0}
    assert sorted(r.v for r in repeated_groups(df, ["e", "r"]).collect()) == [5.0, 7.0]
    assert [r.n for r in repeated_groups(df, ["e", "r"], count_col="n").collect()] == [2, 2]
    assert sorted(r.v for r in duplicate_rows(df, ["e", "r"]).collect()) == [5.0, 7.0]


def test_conflicting_lookups_have_a_stated_choice(spark):
    from stonefly.operators import lookup as K
    rows = [("a", "c"), ("a", "b"), ("x", "y"), ("n", None), ("s", "s")]
    df = spark.createDataFrame([("a",), ("x",), ("z",), (None,), ("n",)], "site string")
    for order in (rows, rows[::-1]):
        cw = spark.createDataFrame(order, "old string, new string")
        got = [(r.site, r.changed) for r in K.replace_from_crosswalk(df, "site", cw, "old", "new").collect()]
        assert sorted(got, key=str) == sorted([("b", True), ("y", True), ("z", False), (None, False), ("n", False)], key=str)
        assert [tuple(r) for r in K.lookup_conflicts(cw, ["old"], ["new"]).collect()] == [("a", 2, "b")]


