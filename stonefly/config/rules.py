"""Validation rule sets per warehouse table (VAL-13).

FIXED VALUES: column lists, length limits, allowed value sets and ranges of
the warehouse targets, written as rule data in the order of the source
checks.  Tables not listed here have no rule set yet (``validate`` raises).
"""

from stonefly.operators.quality import Rule, RuleSet, expand


def _len(col: str, n: int) -> Rule:
    return Rule("col_vals_expr", (col,), expr=f"char_length({col}) <= {n}", step_id=col)


# --- fixed values: WATERBODY ---------------------------------------------------
_WB_COLS = ["WATERBODY_CODE", "WATERBODY_NAME", "WATERBODY_TYPE", "BEACH_PRESENT", "FISHERIES_INDEX_NUMBER",
            "PUBLIC_WATER_SUPPLY", "USGS_POND_NUMBER", "WATERBODY_ALTERNATE_NAME"]
WATERBODY = RuleSet("WATERBODY", [
    *expand("col_exists", _WB_COLS),
    *expand("col_is_character", ["BEACH_PRESENT", "WATERBODY_CODE", "WATERBODY_NAME", "WATERBODY_TYPE",
                                 "FISHERIES_INDEX_NUMBER", "PUBLIC_WATER_SUPPLY", "USGS_POND_NUMBER",
                                 "WATERBODY_ALTERNATE_NAME"]),
    _len("WATERBODY_CODE", 50), _len("WATERBODY_NAME", 100), _len("WATERBODY_TYPE", 50),
    _len("BEACH_PRESENT", 15), _len("FISHERIES_INDEX_NUMBER", 75), _len("PUBLIC_WATER_SUPPLY", 15),
    _len("USGS_POND_NUMBER", 15), _len("WATERBODY_ALTERNATE_NAME", 100),
    *expand("col_vals_not_null", ["BEACH_PRESENT", "WATERBODY_CODE", "WATERBODY_NAME", "WATERBODY_TYPE",
                                  "FISHERIES_INDEX_NUMBER", "PUBLIC_WATER_SUPPLY", "USGS_POND_NUMBER",
                                  "WATERBODY_ALTERNATE_NAME"]),
    Rule("col_vals_in_set", ("BEACH_PRESENT",), ("not_applicable", "unknown", "FALSE", "TRUE")),
    Rule("col_vals_in_set", ("PUBLIC_WATER_SUPPLY",), ("not_applicable", "unknown", "FALSE", "TRUE")),
    Rule("col_vals_in_set", ("WATERBODY_TYPE",), ("river_stream", "lake", "outfall", "other")),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("WATERBODY_CODE",)),
])

# --- fixed values: EVENT ---------------------------------------------------------
EVENT = RuleSet("EVENT", [
    Rule("col_count_match", values=(5,)),
    *expand("col_exists", ["EVENT_DATETIME", "EVENT_ID", "PROJECT", "QAPP_ID", "SITE_CODE"]),
    *expand("col_is_character", ["EVENT_ID", "QAPP_ID", "PROJECT", "SITE_CODE"]),
    Rule("col_is_posix", ("EVENT_DATETIME",)),
    _len("EVENT_ID", 50), _len("PROJECT", 100), _len("QAPP_ID", 50),
    *expand("col_vals_not_null", ["EVENT_DATETIME", "EVENT_ID", "PROJECT", "QAPP_ID", "SITE_CODE"]),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("EVENT_ID",)),
    # Upper bound is the run time; pass it as a job parameter (see event_rules).
    Rule("col_vals_between", ("EVENT_DATETIME",), ("1965-01-01 00:00:00", "9999-12-31 23:59:59")),
])

# --- fixed values: SAMPLE_DELIVERY_GROUP ---------------------------------------
SAMPLE_DELIVERY_GROUP = RuleSet("SAMPLE_DELIVERY_GROUP", [
    Rule("col_exists", ("SAMPLE_DELIVERY_GROUP",)),
    Rule("col_is_character", ("SAMPLE_DELIVERY_GROUP",)),
    _len("SAMPLE_DELIVERY_GROUP", 50),
    Rule("col_vals_not_null", ("SAMPLE_DELIVERY_GROUP",)),
    Rule("rows_distinct"),
])


# --- fixed values: PROJECT -------------------------------------------------------
PROJECT_TYPES = ("Biomonitoring", "CSLAP", "HAB", "HABs", "Historical RIBS", "LRNC", "Mohawk", "LCI", "Other",
                 "PEERS", "Pre RIBS", "Probability Sampling", "PWS", "QAQC", "RAS", "Reference", "RIBS Intensive",
                 "RIBS Routine", "RIBS Screening", "RMN", "Special Request", "Special Study", "TMDL", "Undefined",
                 "WSNC", "Intensive", "Quality Control", "Regional Monitoring Network", "Screening", "Trend")
PROJECT = RuleSet("PROJECT", [
    *expand("col_exists", ["PROJECT", "PROJECT_TYPE", "PROJECT_DESCRIPTION"]),
    *expand("col_is_character", ["PROJECT", "PROJECT_TYPE", "PROJECT_DESCRIPTION"]),
    Rule("col_count_match", values=(3,)),
    _len("PROJECT", 100), _len("PROJECT_DESCRIPTION", 256), _len("PROJECT_TYPE", 100),
    *expand("col_vals_not_null", ["PROJECT", "PROJECT_TYPE", "PROJECT_DESCRIPTION"]),
    Rule("col_vals_in_set", ("PROJECT_TYPE",), PROJECT_TYPES),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("PROJECT",)),
])

# --- fixed values: RESULT_QUALIFIER ---------------------------------------------
RESULT_QUALIFIER = RuleSet("RESULT_QUALIFIER", [
    *expand("col_exists", ["RESULT_QUALIFIER", "RESULT_QUALIFIER_DESCRIPTION"]),
    *expand("col_is_character", ["RESULT_QUALIFIER", "RESULT_QUALIFIER_DESCRIPTION"]),
    Rule("col_count_match", values=(2,)),
    _len("RESULT_QUALIFIER", 10), _len("RESULT_QUALIFIER_DESCRIPTION", 200),
    *expand("col_vals_not_null", ["RESULT_QUALIFIER", "RESULT_QUALIFIER_DESCRIPTION"]),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("RESULT_QUALIFIER",)),
])

# --- fixed values: PARAMETER ------------------------------------------------------
_PARAM_COLS = ["PARAMETER_NAME", "CASRN", "FRACTION", "MATRIX", "METHOD_SPECIATION", "UNIT"]
PARAMETER_UNITS = ("percent", "pg/L", "score_0-10", "raw", "boolean", "meters", "uS/cm", "celsius", "cm_per_second",
                   "observed_taxa", "ordinal", "mg/L", "pH units", "rating_scale_category", "ppt", "NTU", "ug/L",
                   "cfu/100mL", "umhos/cm", "category", "score_0-200", "score_0-100", "score_0-20",
                   "rating_scale_0-10", "rating_scale_A-F", "count", "total_count", "index_score", "score", "ng/L",
                   "cfs", "RFU", "ug/g", "color units", "celsius", "not_applicable", "binary", "1/cm", "mg/kg",
                   "score_1-5", "m", "mV", "FNU", "ug/l")
PARAMETER = RuleSet("PARAMETER", [
    *expand("col_exists", _PARAM_COLS),
    *expand("col_is_character", _PARAM_COLS),
    Rule("col_count_match", values=(6,)),
    _len("PARAMETER_NAME", 100), _len("CASRN", 50), _len("FRACTION", 50), _len("MATRIX", 50),
    _len("METHOD_SPECIATION", 50), _len("UNIT", 50),
    *expand("col_vals_not_null", _PARAM_COLS),
    Rule("col_vals_in_set", ("FRACTION",), ("not_applicable", "dissolved", "total", "total_recoverable", "unknown")),
    Rule("col_vals_in_set", ("MATRIX",), ("water", "not_applicable", "sediment")),
    Rule("col_vals_in_set", ("METHOD_SPECIATION",), ("not_applicable", "as_caco3", "as_so4", "as_n", "as_p",
                                                     "hydrogen_ion_h+")),
    Rule("col_vals_in_set", ("UNIT",), PARAMETER_UNITS),
    Rule("rows_distinct"),
])

# --- fixed values: PARAMETER_NAME -------------------------------------------------
PARAMETER_NAME = RuleSet("PARAMETER_NAME", [
    *expand("col_exists", ["PARAMETER_NAME", "PARAMETER_DESCRIPTION"]),
    *expand("col_is_character", ["PARAMETER_NAME", "PARAMETER_DESCRIPTION"]),
    Rule("col_count_match", values=(2,)),
    _len("PARAMETER_NAME", 100),
    *expand("col_vals_not_null", ["PARAMETER_NAME", "PARAMETER_DESCRIPTION"]),
    Rule("rows_distinct"),
])


# --- fixed values: SITE ------------------------------------------------------------
# BASIN is declared character; the second, numeric BASIN rule of the source
# contradicts it and is dropped.
_SITE_CHAR = ["BASIN", "COUNTY", "ECOREGION_LEVEL_4", "HORIZONTAL_DATUM", "HORIZONTAL_METHOD", "HUC12", "LOCATION",
              "LOCATION_TYPE", "MUNICIPALITY", "NUTRIENT_ECOREGION", "SITE_CODE", "SITE_DESCRIPTION", "SUBBASIN",
              "WATERBODY_CLASS", "WATERSHED_ID_NUMBER", "WIPWL"]
COUNTIES = ("Adams (MA)", "Albany", "Allegany", "Arlington (VT)", "Bronx", "Broome", "Cattaraugus", "Cayuga",
            "Chautauqua", "Chemung", "Chenango", "Clinton", "Columbia", "Cortland", "Delaware", "Dutchess",
            "Duttonville (NJ)", "Erie", "Essex", "Franklin", "Fulton", "Genesee", "Greene", "Hamilton", "Herkimer",
            "Jefferson", "Kings", "Lackawaxen (PA)", "Lewis", "Livingston", "Madison", "Manchester Center (VT)",
            "Milanville (PA)", "Milford (PA)", "Monroe", "Montgomery", "Nassau", "New York", "Niagara",
            "North Adams (MA)", "North Bennington (VT)", "North East (PA)", "Oneida", "Onondaga", "Ontario", "Orange",
            "Orleans", "Osceola (PA)", "Oswego", "Otsego", "Pemberwick (CT)", "Pownal (VT)", "Putnam", "Queens",
            "Rensselaer", "Richmond", "Rockland", "Saint Lawrence", "Saratoga", "Sayre (PA)", "Schenectady",
            "Schoharie", "Schuyler", "Seneca", "Shohola (PA)", "St Lawrence", "St. Lawrence", "Stamford (CT)",
            "Steuben", "Suffolk", "Sullivan", "Tioga", "Tompkins", "Ulster", "unknown", "Upper Saddle River (NJ)",
            "Warren", "Washington", "Wayne", "Westchester", "Wharton (NJ)", "Williamstown (MA)", "Wyoming", "Yates")
ECOREGIONS_L4 = ("58a", "58aa", "58ab", "58ac", "58ad", "58ae", "58af", "58ag", "58b", "58e", "58i", "58j", "58x",
                 "58y", "58z", "59c", "59g", "59i", "60a", "60b", "60c", "60d", "60e", "60f", "61c", "62b", "62d",
                 "64b", "64e", "64g", "67j", "67k", "67l", "67m", "83a", "83b", "83c", "83d", "83e", "83f", "84a",
                 "84c", "unknown")
WATERBODY_CLASSES = ("A", "A-S", "A(T)", "A(TS)", "AA", "AA-S", "AA(T)", "AA(TS)", "B", "B(T)", "B(TS)", "C", "C(T)",
                     "C(TS)", "CT", "D", "SB", "SC", "SC / B", "SC / C", "SD / B", "unknown")
SITE = RuleSet("SITE", [
    *expand("col_exists", ["COUNTY", "ECOREGION_LEVEL_4", "HORIZONTAL_DATUM", "HORIZONTAL_METHOD", "HUC12", "LOCATION",
                           "LOCATION_TYPE", "MUNICIPALITY", "NUTRIENT_ECOREGION", "SITE_CODE", "SITE_DESCRIPTION",
                           "SUBBASIN", "WATERBODY_CLASS", "WATERBODY_CODE", "WATERSHED_ID_NUMBER", "WIPWL", "BASIN",
                           "DEC_REGION", "LATITUDE", "LONGITUDE"]),
    *expand("col_is_character", _SITE_CHAR),
    *expand("col_is_numeric", ["WATERBODY_ID", "DEC_REGION", "LATITUDE", "LONGITUDE"]),
    _len("ECOREGION_LEVEL_4", 4),
    Rule("col_vals_expr", ("SUBBASIN",), expr="char_length(SUBBASIN) = 4", step_id="SUBBASIN"),
    _len("WIPWL", 9), _len("HUC12", 12), _len("HORIZONTAL_DATUM", 20), _len("LOCATION", 20),
    _len("NUTRIENT_ECOREGION", 20), _len("WATERBODY_CLASS", 20), _len("COUNTY", 25), _len("HORIZONTAL_METHOD", 50),
    _len("LOCATION_TYPE", 50), _len("MUNICIPALITY", 50), _len("WATERBODY_CODE", 50), _len("SITE_CODE", 100),
    _len("WATERSHED_ID_NUMBER", 100), _len("SITE_DESCRIPTION", 100),
    *expand("col_vals_not_null", _SITE_CHAR),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("SITE_CODE",)),
    Rule("col_vals_in_set", ("COUNTY",), COUNTIES),
    Rule("col_vals_in_set", ("DEC_REGION",), tuple(range(1, 10))),
    Rule("col_vals_in_set", ("ECOREGION_LEVEL_4",), ECOREGIONS_L4),
    Rule("col_vals_in_set", ("HORIZONTAL_DATUM",), ("NAD83", "WGS84")),
    Rule("col_vals_in_set", ("HORIZONTAL_METHOD",), ("gps_unspecified", "gps_wide_area_augmentation_system",
                                                     "interpolation", "interpolation_map", "interpolation_other")),
    Rule("col_vals_in_set", ("LOCATION_TYPE",), ("centroid", "deep_hole", "inlet", "lake", "open_water", "other",
                                                 "outfall_number", "outlet", "public_water_supply_facility",
                                                 "river_mile", "shore", "shoreline")),
    Rule("col_vals_in_set", ("NUTRIENT_ECOREGION",), ("11", "14", "7", "8", "unknown")),
    Rule("col_vals_in_set", ("WATERBODY_CLASS",), WATERBODY_CLASSES),
])

# --- fixed values: SAMPLE -----------------------------------------------------------
_SAMPLE_CHAR = ["EVENT_ID", "SAMPLE_DELIVERY_GROUP", "REPLICATE", "SAMPLE_CREW", "SAMPLE_LAB", "SAMPLE_LOCATION",
                "SAMPLE_METHOD", "SAMPLE_METHOD_DESCRIPTION", "SAMPLE_METHOD_REFERENCE", "SAMPLE_NAME",
                "SAMPLE_ORGANIZATION", "SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_COMMENT"]
SAMPLE_LABS = ("ALS", "ALS_C", "ALSRNY", "AquatTOX Research", "CASKEL", "CASROCH", "CREL", "DOH",
               "Eurofins Frontier Global Sciences, LLC", "Hale Creek Field Station", "MRBP", "not_applicable",
               "NYDEC21_WQX", "PACEBTR", "PEERS", "SBK", "STLBUF", "SUNYESF", "TALBURL", "UFI", "unknown")
SAMPLE_ORGANIZATIONS = (
    "Canandaigua Lake Watershed Association", "Cayuga Lake Watershed Network", "Chautauqua Lake Association",
    "Citizens Statewide Lake Assessment Program (CSLAP)", "City of Albany Water Department",
    "County Department of Health (DOH)", "CSLAP", "dow_flhub", "dow_hrep", "dow_mohawk", "DOW_Mohawk",
    "DOW_RIBS_Region", "dow_smas", "DOW_SMAS", "DOW_SMAS_HISTORICAL", "Finger Lakes Institute", "Honeoye Lake",
    "Keuka Lake Association", "New York City Department of Environmental Protection", "New York City Parks",
    "New York State Office of Parks, Recreation and Historical Preservation", "New York State Department of Health",
    "NYSDEC", "NYSDEC Central Office", "NYSDEC Region 1", "NYSDEC Region 3", "NYSDEC Region 3A", "NYSDEC Region 3B",
    "NYSDEC Region 4", "NYSDEC Region 5", "NYSDEC Region 5A", "NYSDEC Region 6", "NYSDEC Region 6A",
    "NYSDEC Region 6B", "NYSDEC Region 7", "NYSDEC Region 8", "NYSDEC Region 8A", "NYSDEC Region 8B",
    "NYSDEC Region 9", "Other", "Otisco Lake Preservation Association", "Owasco Watershed Lake Association",
    "Parsons", "Parsons-GLC Contractor", "PEERS", "Public", "Seneca Lake Pure Waters Association",
    "Skaneateles Lake Association", "Stony Brook University", "SUNY College of Environmental Science and Forestry",
    "U.S. Geological Survey (USGS)", "unknown")
SAMPLE_TYPES = ("cdubia_toxicity", "chemistry", "cslap_field", "hab", "hab_field", "hab_report", "hab_status",
                "habitat_assessment_high_gradient", "habitat_assessment_low_gradient", "habitat_descriptions",
                "insitu_chemistry", "lci_field", "macroinvertebrate_abundance", "macroinvertebrate_metrics",
                "macroinvertebrate_survey_high_gradient", "macroinvertebrate_survey_low_gradient", "pebble_count",
                "user_perception", "water_column")
SAMPLE = RuleSet("SAMPLE", [
    Rule("col_count_match", values=(17,)),
    *expand("col_exists", ["EVENT_ID", "REPLICATE", "SAMPLE_CREW", "SAMPLE_DELIVERY_GROUP", "SAMPLE_LAB",
                           "SAMPLE_LOCATION", "SAMPLE_METHOD", "SAMPLE_METHOD_DESCRIPTION", "SAMPLE_METHOD_REFERENCE",
                           "SAMPLE_NAME", "SAMPLE_ORGANIZATION", "SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_COMMENT",
                           "SAMPLE_DEPTH_METERS", "SAMPLE_LATITUDE", "SAMPLE_LONGITUDE"]),
    *expand("col_is_character", _SAMPLE_CHAR),
    *expand("col_is_numeric", ["SAMPLE_DEPTH_METERS", "SAMPLE_LATITUDE", "SAMPLE_LONGITUDE"]),
    _len("EVENT_ID", 50), _len("SAMPLE_CREW", 100), _len("REPLICATE", 15), _len("SAMPLE_DELIVERY_GROUP", 50),
    _len("SAMPLE_LAB", 50), _len("SAMPLE_LOCATION", 50), _len("SAMPLE_METHOD", 50), _len("SAMPLE_SOURCE", 50),
    _len("SAMPLE_TYPE", 50), _len("SAMPLE_METHOD_REFERENCE", 100), _len("SAMPLE_NAME", 100),
    _len("SAMPLE_ORGANIZATION", 100), _len("SAMPLE_METHOD_DESCRIPTION", 200), _len("SAMPLE_COMMENT", 2000),
    *expand("col_vals_not_null", _SAMPLE_CHAR),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("EVENT_ID", "REPLICATE", "SAMPLE_CREW", "SAMPLE_DELIVERY_GROUP", "SAMPLE_LAB",
                           "SAMPLE_LOCATION", "SAMPLE_METHOD", "SAMPLE_METHOD_DESCRIPTION", "SAMPLE_NAME",
                           "SAMPLE_ORGANIZATION", "SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_DEPTH_METERS")),
    Rule("col_vals_between", ("SAMPLE_DEPTH_METERS",), (0, 190), na_pass=True),
    Rule("col_vals_between", ("SAMPLE_LATITUDE",), (40.5, 47.5), na_pass=True),
    Rule("col_vals_between", ("SAMPLE_LONGITUDE",), (-80.5, -37.0), na_pass=True),
    Rule("col_vals_in_set", ("SAMPLE_LAB",), SAMPLE_LABS),
    Rule("col_vals_in_set", ("SAMPLE_ORGANIZATION",), SAMPLE_ORGANIZATIONS),
    Rule("col_vals_in_set", ("SAMPLE_TYPE",), SAMPLE_TYPES),
])

# --- fixed values: RESULT ------------------------------------------------------------
# The source expects 46 columns and lists 45; the count is kept as rule data
# and reported, not enforced by stopping.
_RESULT_KEYS = ["EVENT_ID", "REPLICATE", "SAMPLE_LOCATION", "SAMPLE_METHOD", "SAMPLE_SOURCE", "SAMPLE_TYPE",
                "SAMPLE_DEPTH_METERS", "SAMPLE_CREW", "SAMPLE_NAME", "SAMPLE_LAB", "SAMPLE_ORGANIZATION",
                "SAMPLE_DELIVERY_GROUP", "SAMPLE_METHOD_DESCRIPTION", "MATRIX", "FRACTION", "METHOD_SPECIATION",
                "PARAMETER_NAME", "UNIT", "CASRN"]
_RESULT_COLS = ["ANALYSIS_DATETIME", "DETECT_FLAG", "DETECTION_LIMIT_UNIT", "DILUTION_FACTOR", "FINAL_VOLUME",
                "FINAL_VOLUME_UNIT", "LAB_ANALYTICAL_METHOD", "LAB_QUALIFIER", "LAB_SAMPLE_ID", "LAB_VALIDATION_LEVEL",
                "METHOD_DETECTION_LIMIT", "PREP_DATETIME", "PREP_METHOD", "QUALIFIER_SOURCE", "QUANTITATION_LIMIT",
                "REPORTABLE_RESULT", "REPORTING_DETECTION_LIMIT", "RESULT_CATEGORY", "RESULT_COMMENT",
                "RESULT_QUALIFIER", "RESULT_QUALIFIER_NOTE", "RESULT_TYPE_CODE", "RESULT_VALUE", "SUBSAMPLE_AMOUNT",
                "SUBSAMPLE_AMOUNT_UNIT", "TEST_TYPE"]
_RESULT_CHAR = ["EVENT_ID", "REPLICATE", "SAMPLE_LOCATION", "SAMPLE_METHOD", "SAMPLE_SOURCE", "SAMPLE_TYPE",
                "SAMPLE_CREW", "SAMPLE_NAME", "SAMPLE_LAB", "SAMPLE_ORGANIZATION", "SAMPLE_DELIVERY_GROUP",
                "SAMPLE_METHOD_DESCRIPTION", "MATRIX", "FRACTION", "METHOD_SPECIATION", "PARAMETER_NAME", "UNIT",
                "CASRN", "DETECT_FLAG", "DETECTION_LIMIT_UNIT", "FINAL_VOLUME_UNIT", "LAB_ANALYTICAL_METHOD",
                "LAB_QUALIFIER", "LAB_SAMPLE_ID", "LAB_VALIDATION_LEVEL", "PREP_METHOD", "QUALIFIER_SOURCE",
                "REPORTABLE_RESULT", "RESULT_CATEGORY", "RESULT_COMMENT", "RESULT_QUALIFIER_NOTE", "RESULT_TYPE_CODE",
                "SUBSAMPLE_AMOUNT_UNIT", "TEST_TYPE", "RESULT_QUALIFIER"]
RESULT = RuleSet("RESULT", [
    Rule("col_count_match", values=(46,)),
    *expand("col_exists", _RESULT_KEYS + _RESULT_COLS),
    *expand("col_is_character", _RESULT_CHAR),
    *expand("col_is_numeric", ["SAMPLE_DEPTH_METERS", "DILUTION_FACTOR", "FINAL_VOLUME", "METHOD_DETECTION_LIMIT",
                               "QUANTITATION_LIMIT", "REPORTING_DETECTION_LIMIT", "RESULT_VALUE", "SUBSAMPLE_AMOUNT"]),
    *expand("col_is_posix", ["ANALYSIS_DATETIME", "PREP_DATETIME"]),
    *expand("col_vals_not_null", _RESULT_CHAR),
    _len("RESULT_CATEGORY", 3000), _len("RESULT_COMMENT", 2000), _len("RESULT_QUALIFIER", 10),
    _len("RESULT_QUALIFIER_NOTE", 2000), _len("DETECT_FLAG", 50), _len("LAB_VALIDATION_LEVEL", 50),
    _len("PREP_METHOD", 50), _len("QUALIFIER_SOURCE", 50), _len("TEST_TYPE", 50), _len("DETECTION_LIMIT_UNIT", 25),
    _len("FINAL_VOLUME_UNIT", 25), _len("LAB_QUALIFIER", 25), _len("LAB_SAMPLE_ID", 25), _len("REPORTABLE_RESULT", 15),
    _len("RESULT_TYPE_CODE", 15), _len("SUBSAMPLE_AMOUNT_UNIT", 15),
    Rule("rows_distinct"),
    Rule("rows_distinct", tuple(_RESULT_KEYS)),
])

# --- fixed values: QUALITY_CONTROL --------------------------------------------------
# Expects 53 columns and lists 50; RESULT_CATEGORY is required not-null but
# not listed - kept as written, reported as failing.
_QC_KEYS = ["SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_NAME", "MATRIX", "FRACTION", "METHOD_SPECIATION",
            "PARAMETER_NAME", "UNIT", "CASRN"]
_QC_RESULT = ["ANALYSIS_DATETIME", "DETECT_FLAG", "DETECTION_LIMIT_UNIT", "DILUTION_FACTOR", "FINAL_VOLUME",
              "FINAL_VOLUME_UNIT", "LAB_ANALYTICAL_METHOD", "LAB_QUALIFIER", "LAB_SAMPLE_ID", "LAB_VALIDATION_LEVEL",
              "METHOD_DETECTION_LIMIT", "PREP_DATETIME", "PREP_METHOD", "QUALIFIER_SOURCE", "QUANTITATION_LIMIT",
              "REPORTABLE_RESULT", "REPORTING_DETECTION_LIMIT", "RESULT_COMMENT", "RESULT_QUALIFIER",
              "RESULT_QUALIFIER_NOTE", "RESULT_TYPE_CODE", "RESULT_VALUE", "SUBSAMPLE_AMOUNT", "SUBSAMPLE_AMOUNT_UNIT",
              "TEST_TYPE"]
_QC_QC = ["QC_DUP_ORIGINAL_CONCENTRATION", "QC_DUP_SPIKE_ADDED", "QC_DUP_SPIKE_MEASURED", "QC_DUP_SPIKE_RECOVERY",
          "QC_DUP_SPIKE_STATUS", "QC_LEVEL", "QC_ORIGINAL_CONCENTRATION", "QC_RPD", "QC_RPD_CL", "QC_RPD_STATUS",
          "QC_SPIKE_ADDED", "QC_SPIKE_LCL", "QC_SPIKE_MEASURED", "QC_SPIKE_RECOVERY", "QC_SPIKE_STATUS", "QC_SPIKE_UCL"]
_QC_CHAR = ["SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_NAME", "MATRIX", "FRACTION", "METHOD_SPECIATION", "PARAMETER_NAME",
            "UNIT", "CASRN", "DETECT_FLAG", "DETECTION_LIMIT_UNIT", "FINAL_VOLUME_UNIT", "LAB_ANALYTICAL_METHOD",
            "LAB_QUALIFIER", "LAB_SAMPLE_ID", "LAB_VALIDATION_LEVEL", "PREP_METHOD", "QUALIFIER_SOURCE",
            "REPORTABLE_RESULT", "RESULT_COMMENT", "RESULT_QUALIFIER_NOTE", "RESULT_TYPE_CODE", "SUBSAMPLE_AMOUNT_UNIT",
            "TEST_TYPE", "RESULT_QUALIFIER", "QC_DUP_SPIKE_STATUS", "QC_LEVEL", "QC_RPD_STATUS", "QC_SPIKE_STATUS"]
_QC_NUM = ["DILUTION_FACTOR", "FINAL_VOLUME", "METHOD_DETECTION_LIMIT", "QUANTITATION_LIMIT",
           "REPORTING_DETECTION_LIMIT", "RESULT_VALUE", "SUBSAMPLE_AMOUNT", "QC_DUP_ORIGINAL_CONCENTRATION",
           "QC_DUP_SPIKE_ADDED", "QC_DUP_SPIKE_MEASURED", "QC_DUP_SPIKE_RECOVERY", "QC_ORIGINAL_CONCENTRATION",
           "QC_RPD", "QC_RPD_CL", "QC_SPIKE_ADDED", "QC_SPIKE_LCL", "QC_SPIKE_MEASURED", "QC_SPIKE_RECOVERY",
           "QC_SPIKE_UCL"]
_QC_NOT_NULL = ["SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_NAME", "MATRIX", "FRACTION", "METHOD_SPECIATION",
                "PARAMETER_NAME", "UNIT", "CASRN", "DETECT_FLAG", "DETECTION_LIMIT_UNIT", "FINAL_VOLUME_UNIT",
                "LAB_ANALYTICAL_METHOD", "LAB_QUALIFIER", "LAB_SAMPLE_ID", "LAB_VALIDATION_LEVEL", "PREP_METHOD",
                "QUALIFIER_SOURCE", "REPORTABLE_RESULT", "RESULT_CATEGORY", "RESULT_COMMENT", "RESULT_QUALIFIER_NOTE",
                "RESULT_TYPE_CODE", "SUBSAMPLE_AMOUNT_UNIT", "TEST_TYPE", "RESULT_QUALIFIER"]
QUALITY_CONTROL = RuleSet("QUALITY_CONTROL", [
    Rule("col_count_match", values=(53,)),
    *expand("col_exists", _QC_KEYS + _QC_RESULT + _QC_QC),
    *expand("col_is_character", _QC_CHAR),
    *expand("col_is_numeric", _QC_NUM),
    *expand("col_is_posix", ["ANALYSIS_DATETIME", "PREP_DATETIME"]),
    *expand("col_vals_not_null", _QC_NOT_NULL),
    _len("RESULT_COMMENT", 2000), _len("RESULT_QUALIFIER_NOTE", 2000), _len("DETECT_FLAG", 50),
    _len("LAB_VALIDATION_LEVEL", 50), _len("PREP_METHOD", 50), _len("QUALIFIER_SOURCE", 50), _len("TEST_TYPE", 50),
    _len("DETECTION_LIMIT_UNIT", 25), _len("FINAL_VOLUME_UNIT", 25), _len("LAB_QUALIFIER", 25),
    _len("LAB_SAMPLE_ID", 25), _len("REPORTABLE_RESULT", 10), _len("RESULT_TYPE_CODE", 10),
    _len("SUBSAMPLE_AMOUNT_UNIT", 15), _len("QC_DUP_SPIKE_STATUS", 50), _len("QC_LEVEL", 50),
    _len("QC_RPD_STATUS", 50), _len("QC_SPIKE_STATUS", 50),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_NAME", "SAMPLE_DELIVERY_GROUP", "LAB_SAMPLE_ID",
                           "MATRIX", "FRACTION", "METHOD_SPECIATION", "PARAMETER_NAME", "UNIT", "CASRN")),
])


# --- fixed values: base-column presence sets (VAL-15) ---------------------------------
# Column-existence checks only.  These lists use EVENT_CODE where the full
# rule sets use EVENT_ID; both are kept as written.
BASE_COLUMNS = {
    "RESULT": ["ANALYSIS_DATETIME", "DETECT_FLAG", "DETECTION_LIMIT_UNIT", "DILUTION_FACTOR", "FINAL_VOLUME",
               "FINAL_VOLUME_UNIT", "LAB_ANALYTICAL_METHOD", "LAB_QUALIFIER", "LAB_SAMPLE_ID", "LAB_VALIDATION_LEVEL",
               "METHOD_DETECTION_LIMIT", "PREP_DATETIME", "PREP_METHOD", "QUALIFIER_SOURCE", "QUANTITATION_LIMIT",
               "REPORTABLE_RESULT", "REPORTING_DETECTION_LIMIT", "RESULT_CATEGORY", "RESULT_COMMENT",
               "RESULT_QUALIFIER", "RESULT_QUALIFIER_NOTE", "RESULT_TYPE_CODE", "RESULT_VALUE", "SUBSAMPLE_AMOUNT",
               "SUBSAMPLE_AMOUNT_UNIT", "TEST_TYPE", "EVENT_CODE", "REPLICATE", "SAMPLE_CREW",
               "SAMPLE_DELIVERY_GROUP", "SAMPLE_LAB", "SAMPLE_LOCATION", "SAMPLE_METHOD", "SAMPLE_METHOD_DESCRIPTION",
               "SAMPLE_NAME", "SAMPLE_ORGANIZATION", "SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_DEPTH_METERS",
               "PARAMETER_NAME", "CASRN", "FRACTION", "MATRIX", "METHOD_SPECIATION", "UNIT"],
    "PARAMETER": ["PARAMETER_NAME", "CASRN", "FRACTION", "MATRIX", "METHOD_SPECIATION", "UNIT"],
    "SAMPLE": ["EVENT_CODE", "REPLICATE", "SAMPLE_CREW", "SAMPLE_DELIVERY_GROUP", "SAMPLE_LAB", "SAMPLE_LOCATION",
               "SAMPLE_METHOD", "SAMPLE_METHOD_DESCRIPTION", "SAMPLE_METHOD_REFERENCE", "SAMPLE_NAME",
               "SAMPLE_ORGANIZATION", "SAMPLE_SOURCE", "SAMPLE_TYPE", "SAMPLE_COMMENT", "SAMPLE_DEPTH_METERS",
               "SAMPLE_LATITUDE", "SAMPLE_LONGITUDE"],
    "PROJECT": ["PROJECT", "PROJECT_TYPE", "PROJECT_DESCRIPTION"],
    "EVENT": ["EVENT_DATETIME", "EVENT_CODE", "PROJECT", "QAPP_ID", "SITE_CODE"],
    "SITE": ["COUNTY", "ECOREGION_LEVEL_4", "HORIZONTAL_DATUM", "HORIZONTAL_METHOD", "HUC12", "LOCATION",
             "LOCATION_TYPE", "MUNICIPALITY", "NUTRIENT_ECOREGION", "SITE_CODE", "SITE_DESCRIPTION", "SUBBASIN",
             "WATERBODY_CLASS", "WATERBODY_CODE", "WATERSHED_ID_NUMBER", "WIPWL", "BASIN", "DEC_REGION", "LATITUDE",
             "LONGITUDE"],
}


def base_column_rules(table: str) -> RuleSet:
    """Column-presence-only rule set of a table (VAL-15).  Tables without a
    separate list use the existence steps of their full rule set."""
    key = table.upper()
    if key in BASE_COLUMNS:
        cols = BASE_COLUMNS[key]
    elif key in RULE_SETS:
        cols = [c for r in RULE_SETS[key].rules if r.check == "col_exists" for c in r.columns]
    else:
        raise ValueError(f"no base-column rules for table {table!r}")
    return RuleSet(key, expand("col_exists", cols))


def event_rules(run_time: str) -> RuleSet:
    """EVENT rules with the range's upper bound fixed to the run time."""
    rules = [r if r.check != "col_vals_between" else Rule(r.check, r.columns, (r.values[0], run_time))
             for r in EVENT.rules]
    return RuleSet("EVENT", rules)


RULE_SETS = {rs.table: rs for rs in (WATERBODY, PROJECT, SITE, EVENT, SAMPLE_DELIVERY_GROUP, SAMPLE, RESULT,
                                     QUALITY_CONTROL, RESULT_QUALIFIER, PARAMETER, PARAMETER_NAME)}
