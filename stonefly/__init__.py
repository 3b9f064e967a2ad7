"""stonefly: Spark-native processing of benthic macroinvertebrate lab data.

Lab taxon counts are cleaned, checked against reference tables, scored per
sample (community metrics and 0-10 scores), reshaped to a long warehouse
layout and validated with declarative rules.  Every step is a lazy Spark
DataFrame plan built from built-in expressions; configuration (corrections,
score curves, thresholds, rule sets) lives in small tables under
``stonefly.config``.
"""

__version__ = "0.1.0"
