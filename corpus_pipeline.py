"""From documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fusion_spark.llm import exact_dedup, near_dedup, packing, pii, store, toxicity
from fusion_spark.llm.labels import fold

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, labels, fold(3) != 1))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the row with the largest doc_id stays."""
    return exact_dedup.keep_one_of_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the largest doc_id stays."""
    return near_dedup.keep_one_of_likes(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts becomes the name of its kind; ``n_chars`` follows the text."""
    return pii.mask(docs).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document with their sequence and offset."""
    return packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("PII", mask_pii),
    ("packing", pack),
]

# Learned scores, sketches and token ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each over the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store.stored(stage(spark, docs, sf_dir))
    return docs
