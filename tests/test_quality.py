"""Rule-table validation, failing rows, foreign keys, profile."""

import pytest
from pyspark.sql import functions as F

from stonefly.config.rules import RULE_SETS, event_rules
from stonefly.operators import quality as Q
from stonefly.operators.quality import Rule


@pytest.fixture(scope="module")
def events(spark):
    return spark.sql("""
        SELECT * FROM VALUES
          ('E1', 'P1', 'Q1', 'S1', timestamp_ntz'2023-07-01 10:00:00'),
          ('E1', 'P1', 'Q1', 'S1', timestamp_ntz'2023-07-01 10:00:00'),
          ('E2', NULL, 'Q1', 'S2', timestamp_ntz'1960-07-01 10:00:00'),
          ('E3', 'P2', repeat('q', 60), 'S3', NULL)
        AS t(EVENT_ID, PROJECT, QAPP_ID, SITE_CODE, EVENT_DATETIME)""")


def test_event_rules_report(spark, events):
    rs = event_rules("2030-01-01 00:00:00")
    rep = {r.step: r for r in Q.interrogate(events, rs.rules).collect()}
    assert len(rep) == len(rs.rules)
    for r in rep.values():
        assert 0 <= r.n_pass <= r.units
    by = {(r.check_type, r.columns): r for r in rep.values()}
    assert by[("col_count_match", "")].n_pass == 1
    assert by[("col_is_posix", "EVENT_DATETIME")].n_pass == 1
    assert by[("col_vals_not_null", "PROJECT")].n_pass == 3
    assert by[("col_vals_expr", "QAPP_ID")].n_pass == 3
    assert by[("rows_distinct", "")].n_pass == 2          # both copies of the duplicate row fail
    assert by[("rows_distinct", "EVENT_ID")].n_pass == 2
    assert by[("col_vals_between", "EVENT_DATETIME")].n_pass == 2   # 1960 and NULL fail
    fails = Q.failing_checks(Q.interrogate(events, rs.rules))
    assert fails.filter(F.col("f_pass") >= 1).count() == 0


def test_missing_column_is_reported_not_raised(spark, events):
    rep = Q.interrogate(events, [Rule("col_vals_not_null", ("NOPE",)), Rule("col_exists", ("NOPE",))]).collect()
    assert [r.n_pass for r in rep] == [0, 0]


def test_na_pass_between(spark):
    df = spark.createDataFrame([(1.0,), (None,), (50.0,)], "v double")
    rep = Q.interrogate(df, [Rule("col_vals_between", ("v",), (0, 10), na_pass=True),
                             Rule("col_vals_between", ("v",), (0, 10))]).orderBy("step").collect()
    assert [r.n_pass for r in rep] == [2, 1]


def test_failing_rows_limited_and_ordered(spark):
    df = spark.range(500).withColumn("v", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")))
    rows = Q.failing_rows(df, [Rule("col_vals_not_null", ("v",))], n=50, order_by=["id"]).collect()
    assert [r.id for r in rows] == [i for i in range(0, 150, 3)]


def test_validate_dispatch(spark, events):
    with pytest.raises(ValueError):
        Q.validate(events, "NO_SUCH_TABLE")
    assert Q.validate(events, "event").count() == len(RULE_SETS["EVENT"].rules)


def test_warning_text(spark, events):
    rep = Q.interrogate(events, event_rules("2030-01-01 00:00:00").rules)
    text = Q.warning_text(rep, "EVENT")
    assert text.startswith("There are ") and "EVENT" in text and ", and " in text


def test_compare_schemas(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(1.0, "x", 2)], "k double, s string, extra int")
    got = sorted(tuple(r) for r in Q.compare_schemas(spark, a, b).collect())
    assert got == [("extra", None, "int"), ("k", "int", "double")]


def test_validate_fks_with_staged_rows(spark):
    child = spark.createDataFrame([("u1", "S1"), ("u2", "S2"), ("u3", "S3"), ("u4", None)], "UID string, SITE_CODE string")
    site = spark.createDataFrame([("S1",)], "SITE_CODE string")
    dictionary = spark.createDataFrame(
        [("EVENT", "SITE_CODE", False, True, "SITE"), ("EVENT", "UID", True, False, "NONE")],
        "TABLE_NAME string, COLUMN_NAME string, PRIMARY_KEY boolean, FOREIGN_KEY boolean, PARENT_TABLE string")
    log = spark.createDataFrame([
        ("x", "SITE", 1, '{"SITE_CODE": "OLD"}'), ("x", "SITE", 2, '{"SITE_CODE": "S2"}'),
        ("y", "SITE", 1, '{"SITE_CODE": "S1"}'), ("z", "OTHER", 1, '{"SITE_CODE": "S3"}')],
        "UID string, TABLE_NAME string, VERSION int, DATA string")
    out = Q.validate_fks(child, "EVENT", dictionary, {"SITE": site}, log)
    got = sorted((r.UID, r.MATCHED_SITE, r.FK_VALIDATION_PASSED) for r in out.collect())
    assert got == [("u1", True, True), ("u2", True, True), ("u3", False, False), ("u4", False, False)]
    assert out.count() == child.count()          # no fan-out
    none = Q.validate_fks(child, "NOPE", dictionary, {}, None)
    assert none.filter(~F.col("FK_VALIDATION_PASSED")).count() == 0


def test_profile_exact_and_approx(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (3.0, "a"), (None, "b")], "x double, s string")
    ex = {r.column_name: r for r in Q.profile(df, exact=True).collect()}
    assert ex["x"].n == 4 and ex["x"].n_missing == 1 and ex["x"].n_unique == 3
    assert ex["x"].mean == pytest.approx(2.0) and ex["x"].sd == pytest.approx(1.0)
    assert ex["s"].n_unique == 2 and ex["s"].mean is None
    ap = {r.column_name: r for r in Q.profile(df).collect()}
    assert ap["x"].p50 == 2.0


def test_rule_values_with_quotes(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("x",)], "v string")
    rep = Q.interrogate(df, [Rule("col_vals_in_set", ("v",), ("it's", "a\\b")),
                             Rule("col_vals_regex", ("v",), ("^it'",))]).orderBy("step").collect()
    assert [r.n_pass for r in rep] == [2, 1]
    assert rep[0]["values"] == "it's, a\\b"


def test_base_column_presence(spark, events):
    rep = Q.validate(events, "EVENT", base_only=True).collect()
    missing = {r.columns for r in rep if r.n_pass == 0}
    assert missing == {"EVENT_CODE"} and len(rep) == 5
    from stonefly.config.rules import base_column_rules
    assert len(base_column_rules("WATERBODY").rules) == 8
    with pytest.raises(ValueError):
        Q.validate(events, "NOPE", base_only=True)


def test_wide_key_counts_exact(spark):
    """Hash-first uniqueness equals plain grouping, nulls equal to nulls."""
    rows = [(1, "a", None, 1.0, "x"), (1, "a", None, 1.0, "x"), (2, "b", "c", 2.0, "y"), (3, None, None, None, None),
            (3, None, None, None, None), (3, None, None, None, None), (4, "d", "e", 4.0, "z")]
    df = spark.createDataFrame(rows, "a int, b string, c string, d double, e string")
    got = Q.key_counts(df, df.columns).first()
    assert (got.units, got.n_pass) == (7, 2)
    narrow = Q.key_counts(df, ["a"]).first()
    assert (narrow.units, narrow.n_pass) == (7, 2)
