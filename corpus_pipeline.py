"""Corpus pipeline: language id, quality rules, near-duplicate groups, repeated bytes, packing.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All
but the last return the columns of ``documents``. ``run`` applies them to ``documents``.

Nulls: a null text has no language and goes in the first stage. Repeated rows pass or go
together in the first two stages; of a group of near duplicates the row with the least
doc_id stays (rows without id come last), and of rows repeated whole one. Rows that share
an id, or lack it, are told apart by a 128-bit hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.llm import jaccard_tree, language_id, line_quality, packing, suffix_dedup
from stonefly.llm.common import run_dir, write_table
from stonefly.llm.tokens import word_tokenizer

#: A document goes when the best language has a probability below this.
MIN_SCORE = 0.5

#: No SQL: the first, fourth and fifth stages have none. Tested against brute force.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    model = language_id.train(spark, docs, ~language_id.held_out())
    found = language_id.predict(docs, model, keep=tuple(docs.columns))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-frequency rules keep."""
    rules = line_quality.line_frequency_rules(spark, docs, near_copies=True)
    rejected = rules.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("host").alias("_host"), F.col("content").alias("_content")).distinct()
    rejected = write_table(rejected, f"{run_dir(spark, 'quality-stage')}/rejected")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (line_quality.host_key("source") == F.col("_host")) & (line_quality.content_key("text") == F.col("_content"))
    return docs.join(rejected, same, "left_anti")


def row_name() -> Column:
    """A row's id and text's hash, in the ids' order and then the rows without id; only rows repeated whole share it."""
    d = F.col("doc_id").cast("long")
    number = F.lpad(F.hex(F.coalesce(d, F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.when(d.isNull(), "1").otherwise("0"), number, F.hex(line_quality.content_key("text")), F.when(F.col("text").isNull(), "0").otherwise("1"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id; one of rows repeated whole."""
    named = docs.withColumn("_row", row_name())
    groups = jaccard_tree.similar_documents(spark, named, id_col="_row")
    others = groups.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("_row")).distinct()
    others = write_table(others, f"{run_dir(spark, 'near-duplicate-stage')}/others")
    # both by the row's name: the texts are shuffled once
    return named.dropDuplicates(["_row"]).join(others, "_row", "left_anti").select(*docs.columns)


def repeated_bytes_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeat earlier ones; a document of which nothing is left goes."""
    # without the text as it was, which would be shuffled a second time
    kept = suffix_dedup.remove_repeats(spark, docs, keep=tuple(c for c in docs.columns if c != "text"), with_text=True)
    kept = kept.filter((F.col("n_bytes") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    text = F.col("kept_text")
    return kept.select(*(text.alias(c) if c == "text" else F.char_length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return packing.pack_documents(spark, docs, word_tokenizer(), end_id=1, capacity=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_bytes", repeated_bytes_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    folder = run_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
