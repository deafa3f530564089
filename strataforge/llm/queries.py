"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binary_search, bpe, exact_dedup, langid, lm_scoring, mixing, ngram_join, oracles, pii, quality, secrets

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return bpe.digests(bpe.encode_decode(docs, TOKENIZER)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_texts(_documents(spark, sf_dir))
    return scored.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_pii(_documents(spark, sf_dir)))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = langid.classify(docs.select("doc_id", "text"), langid.learn(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "lang_rejected")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_secrets(_documents(spark, sf_dir)))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.rate_quality(_documents(spark, sf_dir), labels.where("quality = 1 AND toxic = 0").select("doc_id"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(_documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_documents(spark, sf_dir))


def op10_binary_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = binary_search.codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return binary_search.top_k(codes, codes.where("id % 50 = 0"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_secrets": op5_secrets,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality": op7_quality,
    "op8_ngram_join": op8_ngram_join,
    "op9_mixing": op9_mixing,
    "op10_binary_search": op10_binary_search,
}

ORACLES = {
    "op2_lm_scoring": oracles.LM,
    "op5_secrets": oracles.SECRETS,
    "op6_exact_dedup": oracles.EXACT,
    "op8_ngram_join": oracles.JOIN,
    "op10_binary_search": oracles.SEARCH,
}
