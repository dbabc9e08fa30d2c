"""A training corpus from raw documents, as stages that each call one operator.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import decontamination, packing, quality, simhash, substrings
from recordmill.staging import stage


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    w = quality.train(docs, labels, F.lit(True))
    if not w.any():  # nothing to learn from: nothing is rejected
        return docs
    own = "_quality"
    while own.lower() in (c.lower() for c in docs.columns):
        own = f"_{own}"
    return quality.score_column(docs, w, own).where(F.col(own) >= 0.5).drop(own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.remove_passages(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: The trained, hashed and tokenized stages have no SQL counterpart; tests compare each by itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
