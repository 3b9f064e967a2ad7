"""Batch job end to end on a small lab file."""

import os
import tempfile

from stonefly.plans.jobs import run_lab_batch

HEADER = ("WAA_ID,MSSIH_EVENT_SMAS_HISTORY_ID,MSSIH_EVENT_SMAS_SAMPLE_DATE,MSSIH_REPLICATE,"
          "MSSIH_BIOSAMPLE_COLLECT_METHOD,MSSIH_TAXONOMIST,MSDH_GENSPECIES,MSDH_INDIVIDUAL_SPECIES_CNT,"
          "MSSIH_TOTAL_INDIV_CNT_IND,MSSIH_TOTAL_INDIV_CNT_NOTE,X_Grids,Client_Project_Name,group,event_id\n")
ROWS = [
    "W1,13-PATS-0.5,07/05/2018,1,Kick: Standard,WAA,Baetis sp.,60,100,,3,P,,13-PATS-0.5_20180705T1000",
    "W1,13-PATS-0.5,07/05/2018,1,Kick: Standard,WAA,Hydropsyche betteni,40,100,NA,3,P,,13-PATS-0.5_20180705T1000",
    "W2,13-PATS-1.3,07/05/2018,1,Kick: Headwater Stream,WAA,Baetis sp.,50,80,,,P,,13-PATS-1.3_20180705T1100",
    "W3,13-PATS-1.8,07-05-2018,1,Low-Gradient,WAA,Baetis sp.,5,150,,,P,,13-PATS-1.8_20180705T1200",
    "W4,13-PATS-1.9,someday,1,Kick: Standard,WAA,Baetis sp.,5,150,,,P,,13-PATS-1.9_20180705T1200",
]


def test_run_lab_batch(spark):
    d = tempfile.mkdtemp(prefix="stonefly-job-")
    path = os.path.join(d, "lab.csv")
    with open(path, "w") as f:
        f.write(HEADER + "\n".join(ROWS) + "\n")
    taxa = spark.createDataFrame([("baetis_sp.", True, True, 6.0, 7.0, "ephemeroptera"),
                                  ("hydropsyche_betteni", True, True, 4.0, 6.0, "trichoptera")],
                                 "taxon string, is_ept boolean, is_nco boolean, tolerance double, "
                                 "nbi_p_tolerance double, taxon_group string")
    from stonefly.plans import lab as LAB
    res = run_lab_batch(spark, path, os.path.join(d, "out"), "20240101", taxa, LAB.batch_group_model)
    pub = {r.MMDH_LINKED_ID_VALIDATOR: r for r in res.published.collect()}
    # headwater scored as kick, the unknown method without metrics, the unreadable date not at all
    assert set(pub) == {"13-PATS-0.5_20180705_1_1", "13-PATS-1.3_20180705_1_1", "13-PATS-1.8_20180705_Low-Gradient_1"}
    assert pub["13-PATS-1.8_20180705_Low-Gradient_1"].MMDH_RICHNESS is None
    assert [tuple(r) for r in res.tables["unknown_methods"].collect()] == [("Low-Gradient", 1, 1)]
    assert [r.site_id for r in res.tables["rows_without_key"].collect()] == ["13-PATS-1.9"]
    assert pub["13-PATS-0.5_20180705_1_1"].MMDH_RICHNESS == 2
    low = {r.event_id: r.result_qualifier for r in res.metrics_long.collect()}
    assert low["13-PATS-1.3_20180705T1100"] == "<tc" and low["13-PATS-0.5_20180705T1000"] == ""
    assert low["13-PATS-1.8_20180705T1200"] == "<tc"   # below the 200 of its method
    assert res.result_report.count() == 144
    out = os.listdir(os.path.join(d, "out"))
    assert "20240101_S_MACRO_METRICS_DATA_HISTORY.csv" in out and "history" in out
    for name in ("sample_table", "taxa_abundance", "target_SAMPLE", "report_EVENT", "new_species"):
        assert f"20240101_{name}" in out
    dates = {str(r.EVENT_DATETIME) for r in res.tables["taxa_abundance"].collect()}
    assert dates == {"2018-07-05", "None"}                   # dashes repaired, the unreadable one null
    # a second run of the same samples keeps one row each, and its counts
    from stonefly.sources.versions import VersionedTable
    run_lab_batch(spark, path, os.path.join(d, "out"), "20240102", taxa, LAB.batch_group_model)
    history = VersionedTable(spark, os.path.join(d, "out", "history", "samples"), ["MSSIH_LINKED_ID_VALIDATOR"])
    assert history.versions() == [1, 2] and history.read().count() == 3
    assert VersionedTable(spark, os.path.join(d, "out", "history", "species"), ["MSDH_LINKED_ID_VALIDATOR"], one_row=False).read().count() == 4


def test_in_house_batch(spark):
    d = tempfile.mkdtemp(prefix="stonefly-job-")
    path = os.path.join(d, "lab.csv")
    with open(path, "w") as f:
        f.write("LOCATION,STATION,DATE,COLLECT,REPLICATE,GENSPECIES,INDIV\n13-PATS,0.5,07/05/2018,1,1,Baetis sp.,60\n13-PATS,0.5,07-05-2018,1,1,Gammarus,50\n13-PATS,1.3,07/05/2018,9,1,Baetis sp.,5\n")
    taxa = spark.createDataFrame([("baetis_sp.", True, True, 6.0, 7.0, "ephemeroptera")],
                                 "taxon string, is_ept boolean, is_nco boolean, tolerance double, nbi_p_tolerance double, taxon_group string")
    model = spark.createDataFrame([(1, "ephemeroptera", 40.0)], "method int, taxon_group string, percent double")
    res = run_lab_batch(spark, path, os.path.join(d, "out"), "20240101", taxa, model, file_type="internal", write=False)
    se = {r.MSSIH_LINKED_ID_VALIDATOR: r for r in res.sample_event.collect()}
    assert {k: r.MSSIH_TOTAL_INDIV_CNT for k, r in se.items()} == {"13-PATS-0.5_20180705_1_1": 110.0, "13-PATS-1.3_20180705_9_1": 5.0}
    pub = {r.MMDH_LINKED_ID_VALIDATOR: r for r in res.published.collect()}
    assert pub["13-PATS-0.5_20180705_1_1"].MMDH_RICHNESS == 2 and pub["13-PATS-1.3_20180705_9_1"].MMDH_RICHNESS is None
    total = {(r.site_id, r.result_value) for r in res.metrics_long.filter("parameter_name = 'total_individual_count'").collect()}
    assert total == {("13-PATS-0.5", 110.0), ("13-PATS-1.3", 5.0)}
