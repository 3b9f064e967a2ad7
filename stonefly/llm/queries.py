"""Registered queries of the training-data operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stonefly.llm import fill_in_middle, hidden_markov, jaccard_tree, language_id, line_quality, nbest, packing, paragraph_dedup, suffix_dedup, token_files, tree_kmeans, vptree, warc
from stonefly.llm.tokens import piece_model, word_tokenizer

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, _table(spark, sf_dir, "documents"), word_tokenizer(), end_id=1, capacity=4096)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"), length=100)


def op3_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.nbest_segmentations(_table(spark, sf_dir, "documents"), piece_model(), n=3)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(spark, _table(spark, sf_dir, "pages")).drop("url")


def op5_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"), k=10, factor=1.0, every=100)


def op6_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.remove_paragraphs(spark, _table(spark, sf_dir, "documents"), min_words=1, least_run=20)


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_frequency_rules(spark, _table(spark, sf_dir, "documents")).drop("content", "host")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(spark, _table(spark, sf_dir, "documents"), word_tokenizer(), end_id=2)


def op9_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tree.similar_documents(spark, _table(spark, sf_dir, "documents"), words=5, percent=80)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, _table(spark, sf_dir, "documents"))


def op11_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.hidden_markov_scores(spark, _table(spark, sf_dir, "documents"))


def op12_centroid_tree_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_kmeans.cluster_report(spark, _table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, size=64)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_nbest_segmentation": op3_nbest_segmentation,
        "op4_warc": op4_warc,
        "op5_vantage_point_trees": op5_vantage_point_trees,
        "op6_paragraph_minhash": op6_paragraph_minhash,
        "op7_line_frequency": op7_line_frequency,
        "op8_token_files": op8_token_files,
        "op9_signature_tree_join": op9_signature_tree_join,
        "op10_language_id": op10_language_id,
        "op11_hidden_markov": op11_hidden_markov,
        "op12_centroid_tree_kmeans": op12_centroid_tree_kmeans,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_suffix_array_dedup": suffix_dedup.SQL, "op4_warc": warc.SQL, "op5_vantage_point_trees": vptree.SQL, "op7_line_frequency": line_quality.SQL, "op9_signature_tree_join": jaccard_tree.SQL, "op12_centroid_tree_kmeans": tree_kmeans.SQL, "op13_fill_in_middle": fill_in_middle.SQL}
