"""Null rules, text and date helpers."""

import pytest
from pyspark.sql import functions as F

from stonefly.config import corrections as CFG
from stonefly.functions import dates as D
from stonefly.functions import nulls as N
from stonefly.functions import text as X
from stonefly.functions.numeric import round_half_up


def test_membership_never_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    got = df.select(N.isin_safe("x", ["a"]).alias("i"), N.not_in_safe("x", ["a"]).alias("n")).collect()
    assert [(r.i, r.n) for r in got] == [(True, False), (False, True), (False, True)]


def test_strict_sum_and_max(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("h", 2.0)], "k string, v double")
    got = {r.k: (r.s, r.m, r.plain) for r in df.groupBy("k").agg(
        N.strict_sum("v").alias("s"), N.strict_max("v").alias("m"), F.sum("v").alias("plain")).collect()}
    assert got == {"g": (None, None, 1.0), "h": (2.0, 2.0, 2.0)}


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k int, g string")
    b = spark.createDataFrame([(1, None, 10), (2, "y", 20)], "k int, g string, v int")
    from stonefly.operators.joins import join_null_safe
    got = sorted(tuple(r) for r in join_null_safe(a, b, ["k", "g"], "left").collect())
    assert got == [(1, None, 10), (2, "x", None)]


def test_paste_rules(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    r = df.select(N.paste("x", "y", sep="_").alias("p"), N.paste("x", "y", sep="_", parity=True).alias("q")).first()
    assert r.p is None and r.q == "a_NA"


def test_split_fixed(spark):
    df = spark.createDataFrame([("13-PATS-0.5",), ("02-HOUS--124",), ("solo",), (None,)], "s string")
    got = df.select(*[c.alias(f"p{i}") for i, c in enumerate(X.split_fixed("s", "-", 3))]).collect()
    assert [tuple(r) for r in got] == [("13", "PATS", "0.5"), ("02", "HOUS", "-124"), ("solo", "", ""),
                                       (None, None, None)]


def test_replace_first_and_all(spark):
    df = spark.createDataFrame([("a0b0$",)], "s string")
    r = df.select(X.replace_first("s", "0", "$1").alias("f"), X.replace_all("s", "0", "x").alias("a"),
                  X.replace_all("s", "$", "!", literal=True).alias("lit")).first()
    assert (r.f, r.a, r.lit) == ("a$1b0$", "axbx$", "a0b0!")


def test_lpad_never_truncates(spark):
    df = spark.createDataFrame([("7",), ("123",)], "s string")
    assert [r[0] for r in df.select(X.lpad_keep("s", 2)).collect()] == ["07", "123"]


def test_ordered_taxon_cleaning_chain(spark):
    names = ["lymnaea_columella", "undetermined_tubificidae_sp.", "baetis_complex", "cricotopus/orthocladius",
             "drunella_cornutella", "glossiphonia_complanata", "paraleptophlebia_sp."]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    rules = CFG.TAXON_CLEANING + CFG.TAXON_CORRECTIONS
    got = [r[0] for r in df.select(X.ordered_replace("s", rules)).collect()]
    assert got == ["lymnaea_columella", "tubificidae", "baetis_complex", "cricotopus-orthocladius",
                   "drunella_cornutella", "glossiphonia_complanata", "leptophlebia"]


def test_whole_id_rules_are_literal_and_anchored(spark):
    rules = X.whole_id_rules([("13-LHUD-105", "13-LHUD-105.0")])
    df = spark.createDataFrame([("13-LHUD-105",), ("13-LHUD-105.0",), ("13-LHUD-105_20230101T1000",),
                                ("13-LHUDX105",)], "s string")
    got = [r[0] for r in df.select(X.ordered_replace("s", rules)).collect()]
    assert got == ["13-LHUD-105.0", "13-LHUD-105.0", "13-LHUD-105.0_20230101T1000", "13-LHUDX105"]


def test_collapse_sentence(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (["a", "b", "c"],)], "x array<string>")
    assert [r[0] for r in df.select(X.collapse_sentence("x")).collect()] == ["", "a", "a, and b", "a, b, and c"]


def test_screaming_snake():
    assert X.screaming_snake("Client Project.Name") == "CLIENT_PROJECT_NAME"
    assert X.screaming_snake("eventSMASId") == "EVENT_SMAS_ID"
    assert X.screaming_snake("2nd col") == "X2ND_COL"


def test_dates_two_formats_and_keys(spark):
    df = spark.createDataFrame([("07/05/2018",), ("7-5-2018",), ("2018-07-05",), (None,)], "d string")
    out = df.select(D.parse_date_any("d", ["%m/%d/%Y", "%m-%d-%Y"]).alias("p"),
                    D.bad_date_count("d", ["%m/%d/%Y"]).over(__import__("pyspark.sql.window", fromlist=["W"])
                                                             .Window.partitionBy()).alias("bad")).collect()
    assert [str(r.p) for r in out] == ["2018-07-05", "2018-07-05", "None", "None"]
    assert out[0].bad == 2
    r = spark.sql("select timestamp_ntz'2023-09-18 12:05:00' ts, date'2023-09-18' d").select(
        D.event_id(F.lit("11-ARCH-1.9"), "ts").alias("e"), D.linked_id(F.lit("s"), "d", F.lit(1), F.lit(2)).alias("l"),
        D.format_date("d", "%m-%d-%Y").alias("f")).first()
    assert (r.e, r.l, r.f) == ("11-ARCH-1.9_20230918T1205", "s_20230918_1_2", "09-18-2023")


def test_round_half_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.005,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 0)).collect()]
    assert got == [3.0, -2.0, 1.0, None]


def test_site_and_event_corrections(spark):
    from stonefly.config import site_events as S
    from stonefly.operators.lookup import case_map, correct_distinct
    df = spark.createDataFrame([("13-LHUD-105",), ("13-LHUD-105.0",), ("12-SAUQ-2.2_20240717T1200",),
                                ("11-TWNS-0.2",), ("99-NONE-1.0",)], "s string")
    fixed = {r.s0: r.s for r in correct_distinct(df.withColumn("s0", F.col("s")), "s", S.site_rules()).collect()}
    assert fixed == {"13-LHUD-105": "13-LHUD-105.0", "13-LHUD-105.0": "13-LHUD-105.0",
                     "12-SAUQ-2.2_20240717T1200": "12-SAUQ-1.7_20240717T1200", "11-TWNS-0.2": "11-STEB-0.2",
                     "99-NONE-1.0": "99-NONE-1.0"}
    raw = [r[0] for r in df.select(X.ordered_replace("s", S.site_rules(parity=True))).collect()]
    assert raw[1] == "13-LHUD-105.0.0"          # the source's unanchored behaviour, kept in parity mode
    ev = spark.createDataFrame([("12-MOYR-5.1_20100729",), ("x",)], "e string")
    assert [r[0] for r in ev.select(case_map("e", S.event_map(), keep_unmatched=True)).collect()] == \
        ["12-MOYR-5.1_20100728", "x"]


def test_taxon_names_lose_tabs_and_newlines(spark):
    from pyspark.sql import functions as F

    from stonefly.functions.text import normalise_taxon
    df = spark.createDataFrame([("Baetis\t",), ("\nPerla sp.",)], "t string")
    assert [r[0] for r in df.select(normalise_taxon(F.col("t"))).collect()] == ["baetis", "perla_sp."]
