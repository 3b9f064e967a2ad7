"""Staging template columns (DOM-23).

FIXED VALUES: constant and typed-null columns added to the long metric rows
before they are split into the warehouse RESULT / PARAMETER / SAMPLE tables.
A value of ``None`` is a typed null of the given type.
"""

# --- fixed values: (column, value, type) in template order -----------------
RESULT_TEMPLATE = [
    ("CASRN", "not_applicable", "string"),
    ("FRACTION", "not_applicable", "string"),
    ("MATRIX", "not_applicable", "string"),
    ("METHOD_SPECIATION", "not_applicable", "string"),
    ("DETECT_FLAG", "not_applicable", "string"),
    ("DETECTION_LIMIT_UNIT", "not_applicable", "string"),
    ("FINAL_VOLUME_UNIT", "not_applicable", "string"),
    ("LAB_ANALYTICAL_METHOD", "not_applicable", "string"),
    ("ANALYSIS_DATETIME", None, "timestamp_ntz"),
    ("DILUTION_FACTOR", None, "double"),
    ("FINAL_VOLUME", None, "double"),
    ("LAB_QUALIFIER", "", "string"),
    ("LAB_SAMPLE_ID", "not_applicable", "string"),
    ("LAB_VALIDATION_LEVEL", "", "string"),
    ("METHOD_DETECTION_LIMIT", None, "double"),
    ("PREP_DATETIME", None, "timestamp_ntz"),
    ("PREP_METHOD", "not_applicable", "string"),
    ("QUALIFIER_SOURCE", "not_applicable", "string"),
    ("QUANTITATION_LIMIT", None, "double"),
    ("REPORTABLE_RESULT", "not_applicable", "string"),
    ("REPORTING_DETECTION_LIMIT", None, "double"),
    ("RESULT_COMMENT", "none", "string"),
    ("RESULT_QUALIFIER_NOTE", "not_applicable", "string"),
    ("RESULT_TYPE_CODE", "not_applicable", "string"),
    ("SUBSAMPLE_AMOUNT", None, "double"),
    ("SUBSAMPLE_AMOUNT_UNIT", "not_applicable", "string"),
    ("TEST_TYPE", "not_applicable", "string"),
]

SAMPLE_TEMPLATE = [
    ("SAMPLE_DELIVERY_GROUP", "not_applicable", "string"),
    ("SAMPLE_DEPTH_METERS", None, "double"),
    ("SAMPLE_LATITUDE", None, "double"),
    ("SAMPLE_LONGITUDE", None, "double"),
    ("SAMPLE_NAME", "unknown", "string"),
    ("SAMPLE_METHOD_REFERENCE", "SOP#216", "string"),
    ("SAMPLE_METHOD_DESCRIPTION", "kick_net", "string"),
    ("SAMPLE_LAB", "WAA", "string"),
    ("SAMPLE_COMMENT", "none", "string"),
]
