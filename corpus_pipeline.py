"""Corpus pipeline: language ID, exact dedup, near dedup, source mixing, tokenization.

Each stage takes (spark, docs, sf_dir) and returns the rows that stay; run() writes every stage to the
shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.llm import bpe, exact_dedup, langid, mixing, ngram_join
from strataforge.llm.queries import TOKENIZER
from strataforge.llm.store import free, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin; those without letters or with a narrow margin go."""
    found = langid.classify(docs, langid.learn(docs))
    return found.where(~F.col("lang_rejected")).select(*docs.columns)


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with a number that tells rows apart, as ids may be null or occur twice.

    A stage scans its docs twice, and a row has the same number in both scans because docs are a table read from files: partition and place in it.
    """
    return docs.withColumn("_place", F.monotonically_increasing_id())


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the largest doc_id; null texts are empty ones, and of rows that all have null ids one stays."""
    rows = _numbered(docs)
    kept = exact_dedup.exact_dedup(rows, place="_place").where("kept").select(F.col("place").alias("_place"))
    return rows.join(kept, "_place", "left_semi").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row, with the smallest doc_id; rows with null doc_id take no part in links and stay."""
    rows = _numbered(docs)
    found = ngram_join.link_components(rows, place="_place")
    first = found.where("doc_id IS NOT NULL").groupBy("component_id").agg(F.min(F.struct("doc_id", "place")).alias("first")).select(F.col("first.place").alias("_place"))
    kept = first.unionByName(found.where("doc_id IS NULL").select(F.col("place").alias("_place")))
    return rows.join(kept, "_place", "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, as often as it takes them: null and repeated doc_ids like others, null sources as one source; those without a word have no size and go."""
    rows = _numbered(docs)
    copies = mixing.mix_sources(rows, place="_place").where("copies > 0").select(F.col("place").alias("_place"), F.col("copies").cast("int").alias("copies"))
    return rows.join(copies, "_place").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document of the mix; a null text is an empty one."""
    return bpe.digests(bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER)).select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("language ID", language_id), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mix), ("BPE", tokenize)]

#: Compression, components and byte pairs are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name))
        free(*before)
        before = [docs]  # read by the next stage alone
    return docs
