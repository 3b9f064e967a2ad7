"""Lab and warehouse flows on hand-made fixtures (FIXTURES.md layouts)."""

import pytest
from pyspark.sql import functions as F

from stonefly.plans import lab as LAB
from stonefly.plans import warehouse as WH

RAW_COLS = ("WAA_ID string, MSSIH_EVENT_SMAS_HISTORY_ID string, MSSIH_EVENT_SMAS_SAMPLE_DATE string, "
            "MSSIH_REPLICATE int, MSSIH_BIOSAMPLE_COLLECT_METHOD string, MSSIH_TAXONOMIST string, "
            "MSDH_GENSPECIES string, MSDH_INDIVIDUAL_SPECIES_CNT int, MSSIH_TOTAL_INDIV_CNT_IND int, "
            "MSSIH_TOTAL_INDIV_CNT_NOTE string, X_Grids string, Client_Project_Name string, `group` string, "
            "event_id string")


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("W1", "13-PATS-0.5", "07/05/2018", 1, "Kick: Standard", "WAA", "Hydropsyche betteni", 6, 100, "", "3", "P", "",
         "13-PATS-0.5_20180705T1000"),
        ("W1", "13-PATS-0.5", "07/05/2018", 1, "Kick: Standard", "WAA", "Baetis sp.", 90, 100, "", "3", "P", "",
         "13-PATS-0.5_20180705T1000"),
        ("W1", "13-PATS-0.5", "07/05/2018", 1, "Kick: Standard", "WAA", "Baetis sp.", 4, 100, "", "", "P", "",
         "13-PATS-0.5_20180705T1000"),
        ("W2", "13-PATS-1.3", "07-05-2018", 2, "Kick: Standard", "WAA", "Baetis sp.", 50, 60, "", None, "P", "",
         "13-PATS-1.3_20180705T1100"),
        ("W3", "13-PATS-1.3", "07-05-2018", 1, "Low-Gradient", "WAA", "Baetis sp.", 5, 5, "", "", "P", "",
         "13-PATS-1.3_20180705T1100"),
    ]
    return spark.createDataFrame(rows, RAW_COLS)


def test_prepare_keeps_unknown_methods_and_splits_site(spark, raw):
    prepared = LAB.prepare_contract_lab(raw, LAB.collect_method_table(spark))
    prep = prepared.orderBy("MSSIH_EVENT_SMAS_HISTORY_ID", "COLLECT").collect()
    assert len(prep) == 5
    assert [r.COLLECT for r in prep if r.MSSIH_BIOSAMPLE_COLLECT_METHOD == "Low-Gradient"] == [None]
    r = prep[0]
    assert (r.BASIN, r.LOCATION, r.RIVMILE, r.COLLECT) == ("13", "PATS", "0.5", 1)
    assert [tuple(x) for x in LAB.unknown_methods(prepared).collect()] == [("Low-Gradient", 1, 1)]
    # a batch with a table of its own, with two ids for one name: the least, no fan-out
    own = spark.createDataFrame([("Kick: Standard", 1), ("Low-Gradient", 8), ("Low-Gradient", 7)],
                                "BIOSAMPLE_COLLECT_METHOD string, BIOSAMPLE_COLLECT_METHOD_ID int")
    got = LAB.prepare_contract_lab(raw, own)
    assert sorted(r.COLLECT for r in got.collect()) == [1, 1, 1, 1, 7] and LAB.unknown_methods(got).count() == 0


def test_history_tables_max_and_sum(spark, raw):
    prep = LAB.prepare_contract_lab(raw, LAB.collect_method_table(spark))
    h = LAB.history_tables(prep, total="max")
    se = {r.MSSIH_LINKED_ID_VALIDATOR: r for r in h["sample_event"].collect()}
    assert set(se) == {"13-PATS-0.5_20180705_1_1", "13-PATS-1.3_20180705_1_2", "13-PATS-1.3_20180705_Low-Gradient_1"}
    assert se["13-PATS-0.5_20180705_1_1"].MSSIH_TOTAL_INDIV_CNT == 100.0
    assert se["13-PATS-0.5_20180705_1_1"].MSSIH_EVENT_SMAS_SAMPLE_DATE == "07-05-2018"
    s = {r.MSSIH_LINKED_ID_VALIDATOR: r for r in LAB.history_tables(prep, total="sum")["sample_event"].collect()}
    assert s["13-PATS-0.5_20180705_1_1"].MSSIH_TOTAL_INDIV_CNT == 100.0
    assert s["13-PATS-1.3_20180705_1_2"].MSSIH_TOTAL_INDIV_CNT == 50.0
    sp = h["species_history"].collect()
    assert len(sp) == 5 and {r.MSTR_MACRO_SPECIES_ID for r in sp} == {"hydropsyche_betteni", "baetis_sp."}


def test_score_samples_and_publish(spark, raw):
    prep = LAB.prepare_contract_lab(raw, LAB.collect_method_table(spark))
    h = LAB.history_tables(prep)
    taxa = spark.createDataFrame([("hydropsyche_betteni", True, True, 4.0, 6.0, "trichoptera"),
                                  ("baetis_sp.", True, True, 6.0, 7.0, "ephemeroptera")],
                                 "taxon string, is_ept boolean, is_nco boolean, tolerance double, "
                                 "nbi_p_tolerance double, taxon_group string")
    model = spark.createDataFrame([(1, "ephemeroptera", 40.0), (1, "trichoptera", 15.0)],
                                  "method int, taxon_group string, percent double")
    wide = LAB.score_samples(h["species_history"], h["sample_event"], taxa, model)
    pub = {r.MMDH_LINKED_ID_VALIDATOR: r for r in LAB.metric_table(wide).collect()}
    r = pub["13-PATS-0.5_20180705_1_1"]
    assert r.MMDH_RICHNESS == 2 and r.MMDH_EPT_RICH == 2
    assert r.MMDH_HBI_INDEX == pytest.approx((6 * 4 + 94 * 6) / 100, abs=1e-3)
    assert r.MMDH_PCT_MODEL_AFFINITY == pytest.approx(40 + 6, abs=1e-3)
    assert r.MMDH_PCT_DOMINANCE_3 is None                   # not a metric of the kick method (MET-12)
    assert r.MMDH_BIO_ASMT_PROFILE_SCORE is not None
    low = pub["13-PATS-1.3_20180705_Low-Gradient_1"]        # keeps its row, has no metrics (MET-13)
    assert all(low[c] is None for c in low.asDict() if c != "MMDH_LINKED_ID_VALIDATOR")


SCORE_ROWS = "sid string, method int, taxon string, n double, event_id string, site_id string, total double"


def _taxa(spark):
    return spark.createDataFrame([("a", True, True, 4.0, 6.0, "g"), ("b", False, True, 6.0, 7.0, "h")],
                                 "taxon string, is_ept boolean, is_nco boolean, tolerance double, "
                                 "nbi_p_tolerance double, taxon_group string")


def _model(spark):
    return spark.createDataFrame([(1, "g", 40.0), (1, "h", 60.0)], "method int, taxon_group string, percent double")


def test_rows_without_sample_key_are_reported_not_scored(spark):
    rows = [("13-PATS-0.5", "bad", 1, "a b", 3), ("13-PATS-1.3", "bad", 1, "c d", 4), ("13-PATS-1.3", "07/05/2018", 1, "c d", 4)]
    prep = spark.createDataFrame(rows, "site_id string, COLL_DATE string, COLLECT int, MACRO_GENSPECIES string, INDIV int").withColumn("Replicate", F.lit(1))
    keyed = LAB.with_sample_ids(prep, site_col="site_id")
    scored = LAB.score_rows(keyed.select(F.col("MSSIH_LINKED_ID_VALIDATOR").alias("sid"), F.col("COLLECT").alias("method"), F.col("MACRO_GENSPECIES").alias("taxon"), F.col("INDIV").cast("double").alias("n")), _taxa(spark), _model(spark))
    assert [(r.sid, r.richness) for r in scored.collect()] == [("13-PATS-1.3_20180705_1_1", 1)]
    got = LAB.rows_without_key(prep, site_col="site_id").orderBy("site_id").collect()
    assert [(r.site_id, r.COLL_DATE, r.n_rows, r.date_unreadable) for r in got] == [("13-PATS-0.5", "bad", 1, True), ("13-PATS-1.3", "bad", 1, True)]


def test_two_events_on_one_sample_stay_apart(spark):
    rows = [("s", 1, "a", 3.0, "e1", "x", 5.0), ("s", 1, "b", 4.0, "e2", "x", 9.0), ("s", 1, "a", 1.0, "e1", "x", 5.0), ("t", None, "a", 2.0, "e3", "y", 2.0)]
    df = spark.createDataFrame(rows, SCORE_ROWS)
    got = LAB.score_rows(df, _taxa(spark), _model(spark), carry=["event_id", "site_id"], largest=["total"]).collect()
    assert sorted((r.sid, r.event_id, r.richness, r.total) for r in got) == [("s", "e1", 2, 9.0), ("s", "e2", 2, 9.0), ("t", "e3", None, 2.0)]


def test_choices_do_not_depend_on_the_row_order(spark, raw):
    scored = spark.createDataFrame([("13_PATS_0.5_1", "13", "PATS", "0.5", "07/05/2018", 2.0625)],
                                   "EVENT_ID string, BASIN string, LOCATION string, RIVMILE string, DATE string, HBI double")
    letters = [("13-PATS-0.5", "07/05/2018", "B"), ("13-PATS-0.5", "07/05/2018", "A")]
    methods = [("13-PATS-0.5", 6), ("13-PATS-0.5", 1)]
    for turn in (1, -1):
        rules = spark.createDataFrame(letters[::turn], "site string, date string, letter string")
        assert {r.group for r in LAB.lake_groups(raw.drop("group"), rules).filter("MSSIH_EVENT_SMAS_HISTORY_ID = '13-PATS-0.5'").collect()} == {"A"}
        collect = spark.createDataFrame(methods[::turn], "site_id string, COLLECT int")
        row = LAB.publish_scoring_output(scored, collect).first()
        assert (row.MMDH_LINKED_ID_VALIDATOR, row.MMDH_HBI_INDEX) == ("13-PATS-0.5_20180705_1_1", 2.062)  # half to even
        assert [tuple(r) for r in LAB.collect_conflicts(collect).collect()] == [("13-PATS-0.5", 2, 1)]
    own = LAB.publish_scoring_output(scored.withColumn("COLLECT", F.lit(6)), collect).first()
    assert own.MMDH_LINKED_ID_VALIDATOR == "13-PATS-0.5_20180705_6_1"


def test_metrics_with_samples_join_on_five_columns(spark):
    keys = ", ".join(f"{k} string" for k in LAB.METRIC_SAMPLE_KEYS)
    metrics = spark.createDataFrame([("s", "d", "m", "1", None, 5.0, "x"), ("s", "d", "m", "2", None, 6.0, "x")], f"{keys}, RICH double, NOTE string")
    samples = spark.createDataFrame([("s", "d", "m", "1", None, 80.0, "y"), ("s", "d", "m", "1", None, 80.0, "y"), ("s", "d", "k", "2", None, 9.0, "z")], f"{keys}, TOTAL double, NOTE string")
    out = LAB.metrics_with_samples(metrics, samples)
    assert out.columns[-4:] == ["RICH", "NOTE.x", "TOTAL", "NOTE.y"] and [tuple(r)[5:] for r in out.collect()] == [(5.0, "x", 80.0, "y")]


def test_raw_repair(spark, raw):
    bad = raw.limit(1).withColumn("MSSIH_EVENT_SMAS_SAMPLE_DATE", F.lit("2018")).withColumn("MSDH_GENSPECIES", F.lit("neoleptophlebia_sp."))
    got = {(r.MSSIH_EVENT_SMAS_SAMPLE_DATE, r.MSDH_GENSPECIES == "leptophlebia_sp.") for r in LAB.repair_raw(raw.unionByName(bad)).collect()}
    assert got == {("07/05/2018", False), ("2018", True)}


def test_prep_sample_table_moves_letters_to_group(spark):
    df = spark.createDataFrame([("s", "07-05-2018", "2A", "x", "Lake Composite", 100.0, "A", "e")],
                               "MSSIH_EVENT_SMAS_HISTORY_ID string, MSSIH_EVENT_SMAS_SAMPLE_DATE string, "
                               "MSSIH_REPLICATE string, MSSIH_TAXONOMIST string, MSSIH_BIOSAMPLE_COLLECT_METHOD string, "
                               "MSSIH_TOTAL_INDIV_CNT double, MSSIH_GROUP string, event_id string")
    r = WH.prep_sample_table(df).first()
    assert (r.sample_group, r.replicate, r.sample_date) == ("A_2A", 2.0, "20180705")


def test_metrics_long_qualifies_whole_event(spark):
    wide = spark.createDataFrame([
        ("e1", "s", "20180705", "Kick: Standard", "1", "", 4.2, 20.0, 90.0),
        ("e1", "s", "20180705", "Kick: Standard", "2", "", 6.0, 25.0, 150.0),
        ("e2", "t", "20180705", "Kick: Standard", "1", "", 8.0, None, 150.0)],
        "event_id string, site_id string, date string, collection_method string, replicate string, "
        "sample_group string, MMDH_BIO_ASMT_PROFILE_SCORE double, MMDH_RICHNESS double, total_individual_count double")
    long = WH.metrics_long(wide).collect()
    assert len(long) == 8                           # null richness of e2 dropped
    e1 = [r for r in long if r.event_id == "e1"]
    assert all(r.result_qualifier == "<tc" for r in e1)
    prof = [r for r in e1 if r.parameter_name == "bioassessment_profile"]
    assert {r.result_category for r in prof} == {"moderately_impacted", "slightly_impacted"}
    assert all(r.result_qualifier_description for r in prof)
    assert {r.unit for r in long} == {"raw", "score_0-10"}
    assert all(r.organization_name == "NYSDEC" and r.sample_method == "kick_standard" for r in long)
    e2 = [r for r in long if r.event_id == "e2"]
    assert all(r.result_qualifier == "" for r in e2)


def test_taxa_abundance_cleaning(spark):
    raw = spark.createDataFrame([("W1", "s", "07/05/2018", 1, "Kick: Standard", "undetermined_baetis_sp.", 3, "",
                                  "", "P", "e"),
                                 ("W1", "s", "07/05/2018", 1, "Kick: Standard", "lymnaea_columella", 2, "",
                                  "4", "P", "e")],
                                "WAA_ID string, MSSIH_EVENT_SMAS_HISTORY_ID string, MSSIH_EVENT_SMAS_SAMPLE_DATE string, "
                                "MSSIH_REPLICATE int, MSSIH_BIOSAMPLE_COLLECT_METHOD string, MSDH_GENSPECIES string, "
                                "MSDH_INDIVIDUAL_SPECIES_CNT int, MSSIH_TOTAL_INDIV_CNT_NOTE string, X_Grids string, "
                                "Client_Project_Name string, event_id string")
    got = {r.TAXON_ID: r for r in WH.taxa_abundance(raw).collect()}
    assert set(got) == {"baetis", "lymnaea_columella"}
    assert got["baetis"].SUBSAMPLE_AMOUNT_UNIT == "not_applicable"
    assert got["lymnaea_columella"].SUBSAMPLE_AMOUNT_UNIT == "grid"
    assert got["baetis"].UNIT == "count" and got["baetis"].ANALYSIS_DATETIME is None


def test_site_check_and_species_check(spark, raw):
    prep = LAB.prepare_contract_lab(raw, LAB.collect_method_table(spark))
    cw = spark.createDataFrame([("13-PATS-0.6", "13-PATS-0.5"), ("13-PATS-1.3", "13-PATS-1.3")],
                               "SMAS_HISTORY_ID string, ORIGINAL_SITE_ID string")
    rows, changed = LAB.site_check(prep, cw)
    assert {r.site_id for r in rows.collect()} == {"13-PATS-0.6", "13-PATS-1.3"}
    assert [tuple(r) for r in changed.collect()] == [("13-PATS-0.5", "13-PATS-0.6")]
    master = spark.createDataFrame([("arthropoda", "insecta", "ephemeroptera", "baetidae", "", "baetis", "sp.",
                                     "baetis_sp.")],
                                   "MMS_PHYLUM string, MMS_CLASS string, MMS_ORDER string, MMS_FAMILY string, "
                                   "MMS_SUBFAMILY string, MMS_GENUS string, MMS_SPECIES string, MMS_MACRO_GENSPECIES string")
    new, double = LAB.species_check(prep, master)
    assert {r.MACRO_GENSPECIES for r in new.collect()} == {"hydropsyche_betteni"}
    assert double.count() == 0


def test_key_corrections_and_rmn_override(spark):
    from stonefly.operators.lookup import apply_key_corrections
    df = spark.createDataFrame([("s1", "20230101", "s1_20230101T1000", 1), ("s2", "20230102", "e2", 2)],
                               "site string, date string, event_id string, REPLICATE int")
    fixes = spark.createDataFrame([("s1", "20230101", "s1_20230101T0900")], "site string, date string, event_id string")
    got = sorted(tuple(r) for r in apply_key_corrections(df, ["site", "date"], fixes, ["event_id"]).collect())
    assert got == [("s1", "20230101", "s1_20230101T0900", 1), ("s2", "20230102", "e2", 2)]
    t = spark.createDataFrame([("s1", 2, "kick_standard"), ("s1", 1, "kick_standard"), ("s2", 2, "kick_standard")],
                              "SITE_CODE string, REPLICATE int, SAMPLE_METHOD string")
    rmn = spark.createDataFrame([("s1",)], "site string")
    got = sorted(tuple(r) for r in WH.rmn_override(t, rmn).collect())
    assert got == [("s1", 1, "kick_standard"), ("s1", 2, "rmn_kick"), ("s2", 2, "kick_standard")]


def test_prepare_in_house(spark):
    raw = spark.createDataFrame([("13-PATS", "0.5", "07/05/2018", 1, 1, "Baetis sp.", 4)],
                                "LOCATION string, STATION string, DATE string, COLLECT int, REPLICATE int, "
                                "GENSPECIES string, INDIV int")
    r = LAB.prepare_in_house(raw).first()
    assert (r.BASIN, r.LOCATION, r.RIVMILE, r.site_id, r.Replicate) == ("13", "PATS", 0.5, "13-PATS-0.5", 1)


def test_harmonise_groups_and_family_names(spark):
    from stonefly.sources.literal import literal_table
    raw = spark.createDataFrame([("04-LHONYE-0.0", "06/04/2024", 1, "Kick: RMN 300 Count", "P", "physidae"),
                                 ("04-LHONYE-0.0", "06/05/2024", 1, "Lake: Littoral", "RMN", "baetis"),
                                 ("x", "06/05/2024", 3, "Kick: Headwater Stream", "P", "gammaridae")],
                                "MSSIH_EVENT_SMAS_HISTORY_ID string, MSSIH_EVENT_SMAS_SAMPLE_DATE string, "
                                "MSSIH_REPLICATE int, MSSIH_BIOSAMPLE_COLLECT_METHOD string, "
                                "Client_Project_Name string, MSDH_GENSPECIES string")
    rules = literal_table(spark, [("04-LHONYE-0.0", "06/04/2024", "A"), ("04-LHONYE-0.0", "06/05/2024", "B")],
                          [("s", "string"), ("d", "string"), ("g", "string")])
    out = LAB.lake_groups(LAB.harmonise_methods(raw), rules).withColumn(
        "MSDH_GENSPECIES", LAB.undetermined_family("MSDH_GENSPECIES"))
    got = sorted((r.MSSIH_EVENT_SMAS_SAMPLE_DATE, r.MSSIH_REPLICATE, r.MSSIH_BIOSAMPLE_COLLECT_METHOD, r.group,
                  r.MSDH_GENSPECIES) for r in out.collect())
    assert got == [("06/04/2024", 2, "Kick: Standard", "A", "undetermined_physidae"),
                   ("06/05/2024", 1, "Littoral", "B", "baetis"),
                   ("06/05/2024", 3, "Kick: Standard", "", "undetermined_gammaridae")]
    rmn = LAB.harmonise_methods(raw, project_rmn=True).filter("Client_Project_Name = 'RMN'").first()
    assert rmn.MSSIH_BIOSAMPLE_COLLECT_METHOD == "Kick: Standard"


def test_parameter_table_validates(spark):
    from stonefly.operators import quality as Q
    from stonefly.plans.domain_queries import parameter_table
    rep = Q.validate(parameter_table(spark, "/root/testdata/sf0.001"), "PARAMETER").collect()
    assert all(r.n_pass == r.units for r in rep), [r for r in rep if r.n_pass != r.units]


def test_in_house_history_tables(spark):
    raw = spark.createDataFrame([("13-PATS", "0.5", "07/05/2018", 1, 1, "Baetis sp.", 4),
                                 ("13-PATS", "0.5", "07/05/2018", 1, 1, "Hydropsyche betteni", 6),
                                 ("13-PATS", "1.3", "7/5/2018", 1, 2, "Baetis sp.", 5)],
                                "LOCATION string, STATION string, DATE string, COLLECT int, REPLICATE int, "
                                "GENSPECIES string, INDIV int")
    prep = LAB.prepare_in_house(raw)
    h = LAB.history_tables(prep, taxonomist="SBU", total="sum", site_col="site_id", date_format="%m/%d/%Y",
                           method_names=LAB.collect_method_table(spark))
    se = {r.MSSIH_LINKED_ID_VALIDATOR: r for r in h["sample_event"].collect()}
    assert set(se) == {"13-PATS-0.5_20180705_1_1", "13-PATS-1.3_20180705_1_2"}
    r = se["13-PATS-0.5_20180705_1_1"]
    assert (r.MSSIH_TOTAL_INDIV_CNT, r.MSSIH_EVENT_SMAS_SAMPLE_DATE, r.MSSIH_TAXONOMIST,
            r.MSSIH_BIOSAMPLE_COLLECT_METHOD, r.MSSIH_GROUP) == (10.0, "07/05/2018", "SBU", "Kick: Standard", "")


def test_survey_events_and_missing(spark):
    survey = spark.createDataFrame([
        ("11-ARCH-1.9", "11-ARCH-1.9x", "09/18/2023", "12:00", None),
        ("11-ARCH-1.9", "11-ARCH-1.9x", "09/18/2023", "12:00", None),
        ("13-OLD-1.0", "13-OLD-1.0", "07/01/2023", "9:05", "13-OLD-1.0_20230701T0905")],
        "finalSiteID string, revisedOriginalSiteID string, eventSMASSampleDate string, eventSMASArrivetime string, "
        "eventSMASId string")
    ev = WH.survey_events(survey)
    got = sorted(tuple(map(str, r)) for r in ev.collect())
    assert got == [("11-ARCH-1.9x", "2023-09-18", "11-ARCH-1.9", "11-ARCH-1.9_20230918T1200"),
                   ("13-OLD-1.0", "2023-07-01", "13-OLD-1.0", "13-OLD-1.0_20230701T0905")]
    samples = spark.sql("SELECT * FROM VALUES ('11-ARCH-1.9x', date'2023-09-18'), ('zz', date'2023-01-01') "
                        "AS t(site_id, DATE)")
    rows, missing = WH.attach_events(samples, ev)
    assert rows.count() == 2 and [r.site_id for r in missing.collect()] == ["zz"]


def test_prepare_without_group_column(spark, raw):
    prep = LAB.prepare_contract_lab(raw.drop("group"), LAB.collect_method_table(spark))
    assert {r.group for r in prep.collect()} == {""}


def test_totals_are_strict_and_bad_dates_stay_apart(spark):
    from stonefly.plans import lab as LAB
    rows = [("s1", "01/02/2020", 6, 3), ("s1", "01/02/2020", None, 4), ("s2", "bad", 9, 2), ("s3", "worse", None, 7), ("s4", "02/03/2020", 5, 1)]
    df = spark.createDataFrame(rows, "MSSIH_EVENT_SMAS_HISTORY_ID string, COLL_DATE string, MSSIH_TOTAL_INDIV_CNT_IND int, INDIV int")
    from pyspark.sql import functions as F
    df = df.withColumns({"COLLECT": F.lit(1), "Replicate": F.lit(1), "MACRO_GENSPECIES": F.lit("a b")})
    largest = {r[0]: r[1] for r in LAB.history_tables(df)["sample_event"].select("MSSIH_EVENT_SMAS_HISTORY_ID", "MSSIH_TOTAL_INDIV_CNT").collect()}
    assert largest == {"s1": None, "s2": 9.0, "s3": None, "s4": 5.0}
    added = {r[0]: r[1] for r in LAB.history_tables(df, total="sum")["sample_event"].select("MSSIH_EVENT_SMAS_HISTORY_ID", "MSSIH_TOTAL_INDIV_CNT").collect()}
    assert added == {"s1": 7.0, "s2": 2.0, "s3": 7.0, "s4": 1.0}
