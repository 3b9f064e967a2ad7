"""Ordered text corrections.

FIXED VALUES.  Taxon-name cleaning rules, applied in this order to the
running value (order matters: the ``_complex`` -> ``_co`` -> ``_complex``
pair damages three names that the next three rules repair).  Each rule is
(pattern, replacement, literal).
"""

# --- fixed values: taxon name cleaning, in order ----------------------------
TAXON_CLEANING = [
    ("undetermined_", "", False),
    (r"_sp\.|_gr\.|_spp\.", "", False),
    (r"undet\._tubificidae_w/_cap\._setae", "tubificidae_with_cap_setae", False),
    (r"undet\._tubificidae_w/o_cap\._setae", "tubificidae_without_cap_setae", False),
    ("_complex", "_co", False),
    ("_co", "_complex", False),
    ("_complexlumella", "_columella", False),
    ("_complexrnutus", "_cornutus", False),
    ("_complexffmani", "_coffmani", False),
    ("/", "-", False),
    (r"_nr\.", "", False),
    (r"\?", "", False),
]

# --- fixed values: taxon corrections after cleaning (exact names, literal) --
TAXON_CORRECTIONS = [
    ("orthocladius_(euorthoclad.)_rivicola", "orthocladius_euorthocladius_rivicola", True),
    ("orthocladius_(symposiocladius)_lignicola", "orthocladius-symposiocladius_lignicola", True),
    ("drunella_complexrnutella", "drunella_cornutella", True),
    ("paraleptophlebia", "leptophlebia", True),
    ("lipiniella", "chironomidae", True),
    ("glossiphonia_complexmplanata", "glossiphonia_complanata", True),
]

# NA tokens of the typed CSV reader.
NA_TOKENS = ["", "NA", "N/A", "n/a", "-9999"]
