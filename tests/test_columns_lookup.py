"""Column shaping and lookup helpers."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stonefly.operators import columns as C
from stonefly.operators import lookup as L
from stonefly.sources.literal import literal_table


def test_rename_from_table_and_prefix(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "MSSIH_A int, MSSIH_B double, other string")
    assert C.select_prefix(df, "MSSIH_").columns == ["MSSIH_A", "MSSIH_B"]
    out = C.rename_from_table(df, {"MSSIH_B": "B_NEW", "absent": "X", "MSSIH_A": "A_NEW"})
    assert out.columns == ["B_NEW", "A_NEW"]
    assert C.rename_from_table(df, {"MSSIH_A": "A"}, subset=False).columns == ["A", "MSSIH_B", "other"]


def test_names_and_constants(spark):
    df = spark.createDataFrame([(1, 2)], "`Site Id` int, `siteId` int")
    assert C.clean_names(df).columns == ["SITE_ID", "SITE_ID_2"]
    assert C.upper_names(spark.createDataFrame([(1,)], "a int")).columns == ["A"]
    out = C.add_constants(df, {"UNIT": "count", "DEPTH": None, "WHEN": None}, {"DEPTH": "double", "WHEN": "timestamp_ntz"})
    assert dict(out.dtypes)["DEPTH"] == "double" and dict(out.dtypes)["WHEN"] == "timestamp_ntz"
    assert out.first()["UNIT"] == "count"


def test_across_bind_split_blank_round(spark):
    df = spark.createDataFrame([("13-PATS-0.5", 1.23456, None)], "site string, v double, s string")
    out = C.across(df, ["v"], lambda c: c * 2, suffix="_x2", before=True)
    assert out.columns[0] == "v_x2"
    parts = C.bind_split(df, "site", "-", ["BASIN", "LOCATION", "RIVMILE"]).first()
    assert (parts.BASIN, parts.LOCATION, parts.RIVMILE) == ("13", "PATS", "0.5")
    blank = C.blank_nulls(df).first()
    assert blank.s == "" and blank.v == "1.23456"
    assert C.round_numeric(df, 3).first().v == 1.235
    low = C.mutate_by_type(df, T.StringType, F.lower).first()
    assert low.site == "13-pats-0.5"


def test_lookup_join_and_case_map(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    table = spark.createDataFrame([("a", "A"), ("a", "A2")], "old string, new string")
    got = sorted((r.k, r.v) for r in L.lookup_join(df, "k", table, "old", "new", "v").collect()
                 if r.k is not None)
    assert len(got) == 2 and got[1] == ("b", "b")          # no fan-out, unmatched kept
    cm = df.select(L.case_map("k", {"a": "A"}, default="?").alias("m")).collect()
    assert [r.m for r in cm] == ["A", "?", "?"]


def test_literal_table_is_small_for_the_optimizer(spark):
    t = literal_table(spark, [("x", 1), ("y", 2)], [("name", "string"), ("id", "int")])
    assert sorted(tuple(r) for r in t.collect()) == [("x", 1), ("y", 2)]
    big = spark.range(100000).select((F.col("id") % 2 + 1).cast("int").alias("id"))
    plan = big.join(t, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan          # Spark's own size check broadcasts it


def test_crosswalk_ignores_blank_adjustments(spark):
    df = spark.createDataFrame([("baetis_sp.",), ("caenis",), ("x",)], "MSTR_MACRO_SPECIES_ID string")
    adj = spark.createDataFrame([("baetis_sp.", "baetis"), ("caenis", ""), ("x", "x")],
                                "MSDH_GENSPECIES string, changed_to_match_master string")
    out = L.replace_from_crosswalk(df, "MSTR_MACRO_SPECIES_ID", adj, "MSDH_GENSPECIES", "changed_to_match_master")
    got = sorted((r.MSTR_MACRO_SPECIES_ID, r.changed) for r in out.collect())
    assert got == [("baetis", True), ("caenis", False), ("x", False)]
