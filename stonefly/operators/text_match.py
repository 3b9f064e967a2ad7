"""Substring matching of a value set against several columns (FL-06).

``grepl(paste(names, collapse="|"), col)`` over many columns: which rows
contain any of a set of names.  The name set is data, so it becomes an index
of whole names by length and hash:

1. the lengths that occur among the names are one small value of the plan,
2. every distinct value of the columns is probed once, with its substrings of
   those lengths only, by hash; equal hashes are settled on the text itself,
3. one semi join on the values that matched gives the rows.

A name meets only the values that contain it, so no key gathers candidates
that don't match, and the table is read twice however many columns there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def name_index(names: DataFrame, name_col: str) -> DataFrame:
    """Distinct non-empty names with their hash and length."""
    return (names.select(F.col(name_col).cast("string").alias("_name")).filter(F.col("_name") != "").distinct()
            .select("_name", F.xxhash64("_name").alias("_hash"), F.char_length("_name").alias("_length")))


def values_containing_any(values: DataFrame, value_col: str, index: DataFrame) -> DataFrame:
    """Distinct values that contain some name of the index (literal, case-sensitive)."""
    lengths = index.agg(F.array_sort(F.collect_set("_length"))).scalar()  # as many as names are long, at most
    v = values.select(F.col(value_col).alias("_v")).filter(F.col("_v").isNotNull()).distinct().withColumn("_lengths", lengths)
    # only lengths that fit, and for each the places where it can start
    v = v.select("_v", F.explode("_lengths").alias("_length")).filter(F.col("_length") <= F.char_length("_v"))
    probes = v.select("_v", F.explode(F.sequence(F.lit(1), F.char_length("_v") - F.col("_length") + 1)).alias("_p"), "_length")
    probes = probes.select("_v", F.col("_v").substr(F.col("_p"), F.col("_length")).alias("_part"))
    probes = probes.withColumn("_hash", F.xxhash64("_part"))
    hits = probes.join(index.select("_hash", "_name"), (probes["_hash"] == index["_hash"]) & (probes["_part"] == index["_name"]), "left_semi")
    return hits.select("_v").distinct()


def rows_containing_any(df: DataFrame, cols: Sequence[str], names: DataFrame, name_col: str) -> DataFrame:
    """Distinct rows of ``df`` where some column in ``cols`` contains some
    value of ``names[name_col]`` (literal, case-sensitive).  Null values
    contain nothing, null and empty names are no names."""
    rows = df.distinct()
    apart = F.array_distinct(F.array_compact(F.array(*[F.col(c).cast("string") for c in cols])))
    value = "_v"
    while value in df.columns:
        value += "_"
    matched = values_containing_any(df.select(F.explode(apart).alias(value)), value, name_index(names, name_col))
    return (rows.withColumn(value, F.explode(apart)).join(matched.withColumnRenamed("_v", value), value, "left_semi")
            .select(*df.columns).distinct())
