"""Scoring configuration: metric curves, thresholds, method names.

FIXED VALUES.  These must equal the values used by the published scores and
by the source notebooks; they are data, kept together in natural order.
"""

from __future__ import annotations

# --- fixed values: collection method id -> name (1 riffle kick, 2 multiplate
# navigable, 5 multiplate non-navigable, 6 sandy jab, 3 ponar) ---------------
METHOD_NAMES = {
    1: "Kick: Standard",
    2: "Multiplate: Navigable",
    5: "Multiplate: Non-Navigable",
    6: "Kick: Sandy Stream",
    3: "Sediment Ponar",
}

# --- fixed values: piecewise-linear score segments per (method, metric) ----
# (lo, hi, score_lo, score_hi); the first segment whose ``hi`` is not below
# the value applies (integer metrics take the lower segment at a shared
# limit); values outside all segments extend the nearest end segment and the
# score is clamped to 0..10.  Only the riffle (kick) curves are pinned down by
# published scores; other methods ship without curves (no invented values).
SCORE_SEGMENTS = {
    (1, "richness"): [(10, 18.5, 2.5, 5), (18, 26.5, 5, 7.5), (26, 35, 7.5, 10)],
    (1, "ept_richness"): [(1, 5.5, 2.5, 5), (5, 10.5, 5, 7.5)],
    (1, "hilsenhoff_biotic_index"): [(2, 4.5, 10, 7.5), (4.5, 6.5, 7.5, 5), (6.5, 8.5, 5, 2.5)],
    (1, "percent_model_affinity"): [(34, 49.5, 2.5, 5), (49, 64.5, 5, 7.5), (64, 90, 7.5, 10)],
    (1, "nutrient_biotic_index_phosphorus"): [(4, 8, 10, 0)],
}

# Metrics that enter the profile score of each method.
PROFILE_METRICS = {
    1: ["richness", "ept_richness", "hilsenhoff_biotic_index", "percent_model_affinity",
        "nutrient_biotic_index_phosphorus"],
}

# Metrics that each method has (the published kick tables have these five; the
# others follow the published sampling procedure).  A method that isn't
# named has no metrics.
METHOD_METRICS = {
    1: ["richness", "ept_richness", "hilsenhoff_biotic_index", "percent_model_affinity",
        "nutrient_biotic_index_phosphorus"],
    2: ["richness", "ept_richness", "hilsenhoff_biotic_index", "shannon_diversity"],
    5: ["richness", "ept_richness", "hilsenhoff_biotic_index", "shannon_diversity"],
    6: ["richness", "ept_richness", "hilsenhoff_biotic_index", "non_chiro_oligo_richness"],
    3: ["richness", "hilsenhoff_biotic_index", "percent_model_affinity", "percent_dominance_3", "shannon_diversity"],
}

SCORE_MIN, SCORE_MAX = 0.0, 10.0

# --- fixed values: impact category of the profile score (first match wins,
# so 5.0 is moderate and 7.5 is slight) ---------------------------------------
IMPACT_CATEGORIES = [
    ("severly_impacted", None, 2.5),      # value < 2.5
    ("moderately_impacted", 2.5, 5.0),    # 2.5 <= value <= 5.0
    ("slightly_impacted", 5.0, 7.5),      # 5.0 <  value <= 7.5
    ("non_impacted", 7.5, None),          # value > 7.5
]

# --- fixed values: minimum individual count per collection method; below it
# the event's results get the "<tc" qualifier -------------------------------
COUNT_MINIMUM = {
    "Kick: Standard": 100,
    "Kick: Sandy Stream": 100,
    "Multiplate: Navigable": 250,
    "Multiplate: Non-Navigable": 250,
    "Low-Gradient": 200,
    "Lake Composite": 300,
}
LOW_COUNT_QUALIFIER = "<tc"
LOW_COUNT_DESCRIPTION = "total macroinvertebrate count not met for method in SOP 214, Biological Enumeration"

# --- fixed values: canonical sample method names (default "unknown") -------
SAMPLE_METHODS = {
    "Kick: Standard": "kick_standard",
    "Multiplate: Navigable": "multiplate_navigable",
    "Multiplate: Non-Navigable": "multiplate_non-navigable",
    "Sediment Ponar": "sediment_ponar",
    "Kick: Sandy Stream": "kick_sandy-stream",
    "Kick: Headwater Stream": "kick_standard",
    "Multihabitat: Lake": "multihabitat_lake",
    "Low-Gradient": "low_gradient",
    "Lake: Ponar": "lake_ponar",
    "Ponar": "lake_ponar",
    "Lake: Littoral": "lake_littoral",
    "Littoral": "lake_littoral",
    "Other: Various (Historical)": "other_various-historical",
}
SAMPLE_METHOD_DEFAULT = "unknown"

# --- fixed values: wide metric columns of the lab output -> long parameter
# names (raw_/score_ prefix gives the unit) ----------------------------------
LONG_METRIC_COLUMNS = {
    "MMDH_BIO_ASMT_PROFILE_SCORE": "score_bioassessment_profile",
    "MMDH_RICHNESS": "raw_richness",
    "MMDH_RICHNESS_SCORE": "score_richness",
    "MMDH_EPT_RICH": "raw_ept_richness",
    "MMDH_EPT_SCORE": "score_ept_richness",
    "MMDH_HBI_INDEX": "raw_hilsenhoff_biotic_index",
    "MMDH_HBI_SCORE": "score_hilsenhoff_biotic_index",
    "MMDH_SHANNON": "raw_shannon_diversity",
    "MMDH_SHANNON_SCORE": "score_shannon_diversity",
    "MMDH_PCT_MODEL_AFFINITY": "raw_percent_model_affinity",
    "MMDH_PCT_MODEL_AFFINITY_SCORE": "score_percent_model_affinity",
    "MMDH_NUTRIENT_BIOTIC_INDEX_P": "raw_nutrient_biotic_index_phosphorus",
    "MMDH_NBI_P_SCORE": "score_nutrient_biotic_index_phosphorus",
    "MMDH_NCO_RICH": "raw_non_chiro_oligo_richness",
    "MMDH_NCO_RICH_SCORE": "score_non_chiro_oligo_richness",
    "MMDH_PCT_DOMINANCE_3": "raw_percent_dominance_3",
    "MMDH_PCT_DOMINANCE_3_SCORE": "score_percent_dominance_3",
}

# --- fixed values: lab metric names -> published column names (18 rows) ----
PUBLISHED_COLUMN_NAMES = {
    "RICHNESS": "MMDH_RICHNESS",
    "RICH_SCORE": "MMDH_RICHNESS_SCORE",
    "EPT_RICH": "MMDH_EPT_RICH",
    "EPT_SCORE": "MMDH_EPT_SCORE",
    "HBI": "MMDH_HBI_INDEX",
    "HBI_SCORE": "MMDH_HBI_SCORE",
    "SHANNON": "MMDH_SHANNON",
    "SHANNON_SCORE": "MMDH_SHANNON_SCORE",
    "FINAL_SCORE": "MMDH_BIO_ASMT_PROFILE_SCORE",
    "PMA": "MMDH_PCT_MODEL_AFFINITY",
    "PMA_SCORE": "MMDH_PCT_MODEL_AFFINITY_SCORE",
    "NBI_P": "MMDH_NUTRIENT_BIOTIC_INDEX_P",
    "NBI_P_SCORE": "MMDH_NBI_P_SCORE",
    "NCO_RICH": "MMDH_NCO_RICH",
    "NCO_RICH_SCORE": "MMDH_NCO_RICH_SCORE",
    "PCT_DOM3": "MMDH_PCT_DOMINANCE_3",
    "PCT_DOM3_SCORE": "MMDH_PCT_DOMINANCE_3_SCORE",
    "MMDH_LINKED_ID_VALIDATOR": "MMDH_LINKED_ID_VALIDATOR",
}

# --- fixed values: constant columns of the long metric (RESULT) rows -------
LONG_METRIC_CONSTANTS = {
    "activity_type": "macroinvertebrate_metrics",
    "sample_type": "calculated",
    "sample_source": "bap_r_package",
    "sampling_location": "unknown",
    "lab_name": "not_applicable",
    "organization_name": "NYSDEC",
}

# --- fixed values: constant columns of taxa abundance rows -----------------
TAXA_ABUNDANCE_CONSTANTS = {
    "RESULT_QUALIFIER": 0,
    "UNIT": "count",
    "SAMPLE_SOURCE": "lab",
    "SAMPLE_TYPE": "macroinvertebrate_abundance",
    "LAB_ANALYTICAL_METHOD": "not_applicable",
    "TEST_TYPE": "not_applicable",
    "RESULT_CATEGORY": "not_applicable",
    "LAB_QUALIFIER": "not_applicable",
    "PREP_METHOD": "not_applicable",
}

# --- fixed values: method harmonising before scoring (DOM-09) ---------------
# Methods scored like the standard kick, and the replicate given to RMN
# 300-count samples so they stay apart from the standard kick of the site.
METHOD_HARMONISE = {
    "Kick: Headwater Stream": "Kick: Standard",
    "Kick: RMN 300 Count": "Kick: Standard",
    "Lake: Littoral": "Littoral",
}
RMN_METHOD = "Kick: RMN 300 Count"
RMN_REPLICATE = 2
RMN_PROJECT = "RMN"

# --- fixed values: taxon names repaired in the raw file ------------------------
RAW_TAXON_REPAIRS = {"neoleptophlebia_sp.": "leptophlebia_sp."}

# --- fixed values: undetermined-family taxon renames (DOM-29) ----------------
UNDETERMINED_FAMILY = {
    "physidae": "undetermined_physidae",
    "gammaridae": "undetermined_gammaridae",
    "crangonyctidae": "undetermined_crangonyctidae",
    "cambaridae": "undetermined_cambaridae",
    "turbellaria": "undetermined_turbellaria",
}
