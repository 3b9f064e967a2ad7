"""DOM-08 on the committed scoring output: must equal the published table."""

import os

import pytest

from stonefly.plans import lab as LAB
from stonefly.sources.io import read_csv_typed

HERE = os.path.join(os.path.dirname(__file__), "fixtures")
METRICS = ["RICHNESS", "RICH_SCORE", "EPT_RICH", "EPT_SCORE", "HBI", "HBI_SCORE", "PMA", "PMA_SCORE", "NBI_P",
           "NBI_P_SCORE", "FINAL_SCORE"]
PUBLISHED = ["MMDH_RICHNESS", "MMDH_RICHNESS_SCORE", "MMDH_EPT_RICH", "MMDH_EPT_SCORE", "MMDH_HBI_INDEX",
             "MMDH_HBI_SCORE", "MMDH_BIO_ASMT_PROFILE_SCORE", "MMDH_PCT_MODEL_AFFINITY",
             "MMDH_PCT_MODEL_AFFINITY_SCORE", "MMDH_NUTRIENT_BIOTIC_INDEX_P", "MMDH_NBI_P_SCORE"]


def test_publish_reproduces_published_metrics(spark):
    scored = read_csv_typed(spark, os.path.join(HERE, "scoring_output_2018.csv"),
                            {"EVENT_ID": "string", "LOCATION": "string", "RIVMILE": "string", "BASIN": "int",
                             "DATE": "string", **{m: "double" for m in METRICS}})
    collect = spark.createDataFrame([(f"13-PATS-{m}", 1) for m in ("0.5", "1.3", "1.8")],
                                    "site_id string, COLLECT int")
    got = {r.MMDH_LINKED_ID_VALIDATOR: r for r in LAB.publish_scoring_output(scored, collect).collect()}
    want = read_csv_typed(spark, os.path.join(HERE, "published_metrics_2018.csv"),
                          {"MMDH_LINKED_ID_VALIDATOR": "string", **{m: "double" for m in PUBLISHED}}).collect()
    assert len(got) == len(want) == 12
    for w in want:
        g = got[w.MMDH_LINKED_ID_VALIDATOR]
        for m in PUBLISHED:
            assert g[m] == pytest.approx(w[m]), (w.MMDH_LINKED_ID_VALIDATOR, m)
