"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bm25,
    bpe,
    katz,
    language,
    lattice,
    licenses,
    mask_search,
    mixing,
    secrets,
    simhash,
    token_files,
    url_rules,
    whitening,
)
from tidemark.workspace import scratch_path

#: Host, path and verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BYTE_BPE, WORD_BPE, END_ID = "byte_bpe_50k.json", "word_bpe_49k.json", 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vector_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest(bpe.decode(bpe.encode(docs, path).select("doc_id", "ids"), path))


def token_file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_BPE), END_ID)
    return token_files.digest(token_files.read_token_files(spark, folder))


def secret_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secret_spans(_table(spark, sf_dir, "documents")))


def text_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(_table(spark, sf_dir, "documents"))


def nearest_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bm25.top_k(docs, F.coalesce(docs["doc_id"] % 50 == 0, F.lit(False)))


def license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.license_spans(_table(spark, sf_dir, "documents")))


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(_table(spark, sf_dir, "documents")))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = language.predict(docs, language.fit_on_folds(docs))
    return labelled.select("doc_id", language.held_out(labelled["doc_id"]).alias("held_out"), "lang_pred", "score")


def judged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, url_rules.RULE))


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.top_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_lattice": vector_groups,
    "op2_simhash": simhash_groups,
    "op3_bpe": bpe_digests,
    "op4_token_files": token_file_digests,
    "op5_katz": text_scores,
    "op6_bm25": nearest_texts,
    "op7_licenses": license_digests,
    "op8_mixing": mixed_sources,
    "op9_language": languages,
    "op10_secrets": secret_digests,
    "op11_url_filters": judged_pages,
    "op12_mask_search": ranked_documents,
    "op13_whitening": whitened_vectors,
}
