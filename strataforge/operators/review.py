"""Second opinions: choosing what to review, merging reviews into provenance and flags, and their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.collections import appended, set_default
from .fixed import UNDECIDED

LEAST_CONFIDENCE = 0.8
PROVENANCE = "struct<coordinates_source:string,deposit_type_verified:boolean,extraction_pipeline:string,confidence_tier:string>"


def skip_reason(df: DataFrame, least: float = LEAST_CONFIDENCE) -> Column:
    """Why a record isn't reviewed: no type, too little confidence, not a deposit paper; null if it is."""
    return (
        F.when(F.coalesce("deposit_type", F.lit("")) == "", "no_type")
        .when(F.coalesce("deposit_type_conf", F.lit(0.0)) < least, "low_confidence")
        .when(F.coalesce("deposit_class", F.lit("")) != "mineral_deposit", "not_deposit")
    )


def decides_nothing(c: Column) -> Column:
    return F.coalesce(c, F.lit("None")).isin(*UNDECIDED)


def merge_reviews(df: DataFrame, reviews: DataFrame, abstracts: DataFrame) -> DataFrame:
    """df with _provenance and _gate_flags brought up to date.

    reviews: (paper_id, result struct<consistent, issues, suggested_type, ...>); abstracts: (paper_id, consistent, abstract_type). One row an id.
    """
    kinds = dict(df.dtypes)
    rows = df
    if "_provenance" not in kinds:
        rows = rows.withColumn("_provenance", F.lit(None).cast(PROVENANCE))
    if "_gate_flags" not in kinds:
        rows = rows.withColumn("_gate_flags", F.lit(None).cast("array<string>"))
    rows = rows.join(reviews.select("paper_id", F.col("result").alias("_r")), "paper_id", "left")
    rows = rows.join(abstracts.select("paper_id", F.col("consistent").alias("_c"), F.col("abstract_type").alias("_a")), "paper_id", "left")
    given, agreed = F.col("_r").isNotNull(), F.coalesce("_r.consistent", F.lit(False))
    hint = F.col("_r.suggested_type")
    opposed = given & ~agreed & ~decides_nothing(hint)
    flags = appended(
        "_gate_flags",
        F.when(given & ~agreed & decides_nothing(hint), F.lit("FLAG:p2_insufficient_abstract")),
        F.when(opposed, F.concat(F.lit("FLAG:adversarial_fail:"), F.left(F.coalesce("_r.issues", F.lit("")), F.lit(80)))),
        F.when(opposed & ~hint.eqNullSafe(F.col("deposit_type")), F.concat(F.lit("FLAG:p2_suggests:"), hint)),
        F.when(F.col("_c") == F.lit(False), F.concat(F.lit("FLAG:metamorphic_inconsistency:"), F.coalesce("_a", F.lit("None")))),
    )
    blank = F.from_json(F.lit("{}"), PROVENANCE)
    verified = set_default("_provenance", blank, "deposit_type_verified", F.lit(True))
    return rows.withColumn("_opposed", opposed).withColumn("_gate_flags", F.when(F.size(flags) > 0, flags).otherwise(F.col("_gate_flags"))).withColumn("_provenance", F.when(given & agreed, verified).otherwise(F.col("_provenance"))).drop("_r", "_c", "_a")


def flagged(merged: DataFrame) -> DataFrame:
    """(paper_id, reason): an entry for each objection."""
    reasons = F.array_compact(F.array(F.when(F.col("_opposed"), F.lit("p2_fail")), F.when(F.exists(F.coalesce("_gate_flags", F.array().cast("array<string>")), lambda f: f.startswith("FLAG:metamorphic_inconsistency")), F.lit("p7_inconsistent"))))
    return merged.select("paper_id", F.explode(reasons).alias("reason"))


def review_counts(reviews: DataFrame) -> DataFrame:
    """One row: agreed, opposed, undecided and no result."""
    r = F.col("result")
    ok, unsure = F.coalesce(r["consistent"], F.lit(False)), decides_nothing(r["suggested_type"])
    return reviews.agg(F.count_if(r.isNotNull() & ok).alias("p2_pass"), F.count_if(r.isNotNull() & ~ok & ~unsure).alias("p2_fail"), F.count_if(r.isNotNull() & ~ok & unsure).alias("p2_insufficient"), F.count_if(r.isNull()).alias("p2_error"))


def abstract_counts(abstracts: DataFrame) -> DataFrame:
    return abstracts.agg(F.count_if(F.col("consistent")).alias("p7_consistent"), F.count_if(~F.col("consistent")).alias("p7_inconsistent"))
