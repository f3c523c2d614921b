"""The corpus pipeline: stages applied to the documents one after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelgrove.llm import langid, ngram_join, packing, pii
from reelgrove.session import shared_dir, ship_package

# A text goes if more of its letters are in scripts that no learned language is written in.
MOST_FOREIGN = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language; the model is learnt from their own labels.

    Documents without a language (``und``: no text, no letter) go, and those whose letters are
    mostly in scripts that no learned language uses; one that mixes several languages stays.
    ``lang`` becomes the predicted language where it was NULL. Where no document has a label
    nothing is learnt, and all documents with a letter stay as they are.
    """
    ship_package(spark)
    model = langid.learn(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, model).where(
        (F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_foreign") <= MOST_FOREIGN)
    )
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of every class of near copies."""
    ship_package(spark)
    return ngram_join.one_per_class(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in all texts; ``n_chars`` follows the new text."""
    ship_package(spark)
    masked = pii.pseudonymise(docs, pii.key_of(spark)).withColumn("n_chars", F.char_length("text").cast("bigint"))
    return masked.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
