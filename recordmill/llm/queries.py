"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import (
    decontamination, embeddings, filter_audit, kneser_ney, language, main_text, merkle, neighbours, packing, quality, simhash,
    substrings, toxicity,
)
from recordmill.llm.training import text_crc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = text_crc() % 3 == 1
    w = quality.train(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return _scored(quality.score_column(docs, w), held_out)


def packed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = text_crc() % 5 == 0
    langs, table = language.train(docs, ~held_out)
    return language.predict(docs, langs, table).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages", "proportions")


def language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = text_crc() % 5 == 1
    model = kneser_ney.train(docs, ~held_out)
    return kneser_ney.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = text_crc() % 5 == 0
    machine = toxicity.train(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return _scored(toxicity.score_column(docs, machine), held_out)


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.train(pages)).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(_table(spark, sf_dir, "documents"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"))


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_embedding_near_dedup": embedding_groups,
    "op2_benchmark_decontamination": benchmark_overlaps,
    "op3_simhash_near_dedup": simhash_groups,
    "op4_quality_classifier": quality_scores,
    "op5_packing": packed_pieces,
    "op6_language_id": languages,
    "op7_lm_scoring": language_model_scores,
    "op8_toxicity": toxicity_scores,
    "op9_html_extraction": page_texts,
    "op10_substring_dedup": repeated_passages,
    "op11_nearest_neighbours": nearest_vectors,
    "op12_filter_audit": filter_interactions,
    "op13_merkle_manifest": dataset_manifest,
}

#: DuckDB SQL for those that SQL can express.
ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": embeddings.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
