"""Reconciliation and intake checks."""

from stonefly.plans import checks as K


def test_reconcile_and_missing_sites(spark):
    a = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "event_id string")
    b = spark.createDataFrame([("e2",), ("e4",)], "event_id string")
    r = K.reconcile(a, b, "event_id")
    assert sorted(x.value for x in r["only_in_a"].collect()) == ["e1", "e3"]
    assert [x.value for x in r["only_in_b"].collect()] == ["e4"]
    metrics = spark.createDataFrame([("s1",), ("s2",)], "site_id string")
    wh = spark.createDataFrame([("s1",)], "SITE_CODE string")
    survey = spark.createDataFrame([("s2", "x"), ("s1", "y"), ("s2", "z")], "site_id string, v string")
    out = K.sites_not_in_warehouse(metrics, wh, survey=survey)
    assert [x.site_id for x in out["missing_sites"].collect()] == ["s2"]
    assert sorted(x.v for x in out["survey_rows"].collect()) == ["x", "z"]


def test_taxon_crosswalk_and_template(spark):
    taxa = spark.createDataFrame([("baetis", 1), ("unknownus", 2)], "TAXON_ID string, n int")
    cw = spark.createDataFrame([("baetis",), ("baetis",)], "TAXON_ID string")
    assert [r.TAXON_ID for r in K.taxon_crosswalk_errors(taxa, cw).collect()] == ["unknownus"]
    rep = {r.column_name: r for r in K.incoming_template_check(taxa, {"TAXON_ID": "string", "n": "double",
                                                                      "grids": "string"}).collect()}
    assert rep["TAXON_ID"].type_ok and not rep["n"].type_ok and not rep["grids"].present
