"""Score curves and profile against the published kick-sample metrics."""

import pytest
from pyspark.sql import functions as F

from stonefly.operators import metrics as M

# Published metrics of 18 kick samples: richness, EPT, HBI, PMA, NBI-P and
# their scores, plus the profile (golden values from the committed outputs).
GOLDEN = [
    # id, rich, rich_s, ept, ept_s, hbi, hbi_s, profile, pma, pma_s, nbi, nbi_s
    ("13-PATS-0.5_20180705_1_1", 24, 6.76, 2, 3.06, 5.74, 5.95, 4.46, 50, 5.16, 7.45, 1.37),
    ("13-PATS-0.5_20180705_1_2", 21, 5.88, 3, 3.61, 5.53, 6.21, 4.06, 47, 4.6, 8.08, 0),
    ("13-PATS-0.5_20180705_1_3", 22, 6.18, 3, 3.61, 6.21, 5.36, 4.06, 45, 4.27, 7.65, 0.87),
    ("13-PATS-0.5_20180705_1_4", 24, 6.76, 3, 3.61, 5.61, 6.11, 4.2, 45, 4.27, 7.9, 0.25),
    ("13-PATS-1.3_20180705_1_1", 21, 5.88, 2, 3.06, 6.36, 5.18, 3.89, 48, 4.76, 7.77, 0.58),
    ("13-PATS-1.3_20180705_1_2", 16, 4.26, 2, 3.06, 6.08, 5.53, 3.39, 44, 4.11, 8, 0),
    ("13-PATS-1.3_20180705_1_3", 21, 5.88, 3, 3.61, 5.94, 5.7, 4.01, 45, 4.27, 7.77, 0.58),
    ("13-PATS-1.3_20180705_1_4", 19, 5.29, 2, 3.06, 6.19, 5.39, 3.8, 49, 4.92, 7.87, 0.32),
    ("13-PATS-1.8_20180705_1_1", 23, 6.47, 4, 4.17, 6.26, 5.3, 4.69, 46, 4.44, 6.77, 3.08),
    ("13-PATS-1.8_20180705_1_2", 16, 4.26, 2, 3.06, 6.22, 5.35, 3.7, 45, 4.27, 7.38, 1.55),
    ("13-PATS-1.8_20180705_1_3", 21, 5.88, 3, 3.61, 5.51, 6.24, 5.01, 48, 4.76, 6.17, 4.58),
    ("13-PATS-1.8_20180705_1_4", 15, 3.97, 3, 3.61, 4.76, 7.18, 5.08, 45, 4.27, 5.45, 6.38),
    ("02-DODG-0.1_20210701_1_1", 22, 6.18, 10, 7.27, 4.82, 7.1, 7, 89, 9.9, 6.18, 4.55),
    ("02-DODG-0.1_20210701_1_2", 25, 7.06, 9, 6.82, 5.21, 6.61, 6.53, 73, 8.37, 6.49, 3.77),
    ("02-DODG-0.1_20210701_1_3", 27, 7.78, 9, 6.82, 5.01, 6.86, 6.65, 77, 8.75, 6.79, 3.02),
    ("02-DODG-0.3_20210701_1_1", 20, 5.59, 9, 6.82, 4.22, 7.78, 7.12, 77, 8.75, 5.34, 6.65),
    ("02-DODG-0.3_20210701_1_2", 21, 5.88, 8, 6.36, 4.35, 7.65, 6.51, 60, 6.77, 5.64, 5.9),
    ("02-DODG-0.3_20210701_1_3", 27, 7.78, 10, 7.27, 4.87, 7.04, 7.11, 72, 8.27, 5.93, 5.18),
]
METRICS = ["richness", "ept_richness", "hilsenhoff_biotic_index", "percent_model_affinity",
           "nutrient_biotic_index_phosphorus"]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(g[0], 1, float(g[1]), float(g[3]), float(g[5]), float(g[8]), float(g[10])) for g in GOLDEN]
    df = spark.createDataFrame(rows, "sample string, method int, richness double, ept_richness double, "
                                     "hilsenhoff_biotic_index double, percent_model_affinity double, "
                                     "nutrient_biotic_index_phosphorus double")
    out = M.method_scores(df, "method", METRICS)
    return {r["sample"]: r for r in out.collect()}


def test_scores_match_published(scored):
    for g in GOLDEN:
        r = scored[g[0]]
        for metric, expected in zip(METRICS, (g[2], g[4], g[6], g[9], g[11])):
            assert r[f"score_{metric}"] == pytest.approx(expected, abs=0.006), (g[0], metric)


def test_profile_is_mean_of_five(scored):
    for g in GOLDEN:
        assert scored[g[0]]["score_bioassessment_profile"] == pytest.approx(g[7], abs=0.0051), g[0]


def test_unscored_method_keeps_row_with_null_scores(spark):
    df = spark.createDataFrame([("a", 3, 20.0, 5.0, 5.0, 50.0, 6.0)],
                               "sample string, method int, richness double, ept_richness double, "
                               "hilsenhoff_biotic_index double, percent_model_affinity double, "
                               "nutrient_biotic_index_phosphorus double")
    r = M.method_scores(df, "method", METRICS).collect()[0]
    assert r["score_richness"] is None and r["score_bioassessment_profile"] is None


def test_scores_clamped_and_lower_segment_at_shared_limit(spark):
    df = spark.createDataFrame([(1, 18.0), (1, 60.0), (1, 0.0)], "method int, richness double")
    out = [r["score_richness"] for r in M.method_scores(df, "method", ["richness"]).orderBy("richness").collect()]
    assert out[0] == 0.0                        # far below the first segment -> clamped at 0
    assert out[1] == pytest.approx(2.5 + 8 / 8.5 * 2.5)  # 18 stays on the lower segment
    assert out[2] == 10.0                       # above the last segment -> clamped at 10


def test_impact_category_first_match(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (5.0,), (7.5,), (7.51,), (None,)], "v double")
    got = {r["v"]: r["c"] for r in df.select("v", M.impact_category("v").alias("c")).collect()}
    assert got == {2.0: "severly_impacted", 2.5: "moderately_impacted", 5.0: "moderately_impacted",
                   7.5: "slightly_impacted", 7.51: "non_impacted", None: ""}


def test_low_count_minimum(spark):
    df = spark.createDataFrame([("Kick: Standard", 99.0), ("Kick: Standard", 100.0),
                                ("Multiplate: Navigable", 249.0), ("Sediment Ponar", 1.0), (None, 1.0)],
                               "m string, t double")
    got = [r["low"] for r in df.select(M.below_count_minimum("m", "t").alias("low")).collect()]
    assert got == [True, False, True, False, False]
