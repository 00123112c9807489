"""A corpus made ready for training, stage by stage, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, language, mixing, secrets, simhash
from tidemark.workspace import freeze

#: A document in which no language holds half of the letters is rejected, like one without letters.
LEAST_SHARE = 0.5
#: Words of a shingle, and bits in which the fingerprints of near copies may differ.
SHINGLE, RADIUS = 3, 3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go; the others stay as they are."""
    model = language.fit_on_folds(docs)
    return language.keep_labelled(docs, model, LEAST_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return simhash.keep_one_each(docs, shingle=SHINGLE, radius=RADIUS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; every document stays."""
    return secrets.redact_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and the digest of what they decode to, beside the id, language and source."""
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe", tokenize),
]

#: Learned labels, fingerprints and byte pairs are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
