"""De-duplication by content with a keeper policy, and by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.collections import canonical_json, canonical_raw

COPY_SUFFIX = r"\(\d+\)$"


def content_hash(df: DataFrame, leave_out=("paper_id",)) -> Column:
    """MD5 of a typed record's canonical JSON, without ids and columns that start with _."""
    return F.md5(canonical_json(df, leave_out))


def raw_content_hash(raw: Column | str, leave_out=("paper_id",)) -> Column:
    """MD5 of raw JSON text by content: key order doesn't matter, absent and null keys differ."""
    return F.md5(canonical_raw(raw, leave_out))


def mark_duplicates(df: DataFrame, by: Column, id_col: str = "paper_id", order: str = "_ord") -> DataFrame:
    """df with _hash, _copies and _keep: of each hash the row kept is the first whose id has no copy suffix, else the first.

    The keeper is aggregated before the shuffle and joined back; where many rows share a content, Spark's skew handling splits their side of the join.
    """
    hashed = df.withColumn("_hash", F.coalesce(by, F.lit("")))
    rank = F.struct(F.col(id_col).rlike(COPY_SUFFIX).cast("int").alias("suffixed"), F.col(order).alias("ord"))
    best = hashed.groupBy("_hash").agg(F.min(rank).alias("_best"), F.count("*").alias("_copies"))
    return hashed.join(best, "_hash").withColumn("_keep", F.col(order) == F.col("_best.ord")).drop("_best")


def unique_rows(marked: DataFrame) -> DataFrame:
    return marked.where("_keep").drop("_hash", "_copies", "_keep")


def removed_rows(marked: DataFrame) -> DataFrame:
    return marked.where(~F.col("_keep"))


def duplicate_groups(marked: DataFrame, id_col: str = "paper_id", order: str = "_ord") -> DataFrame:
    """One row a group of more than one: hash, kept id, removed ids (suffixed ones first, each in order), count."""
    gone = F.struct((~F.col(id_col).rlike(COPY_SUFFIX)).cast("int").alias("plain"), F.col(order).alias("ord"), F.col(id_col).alias("id"))
    removed = F.transform(F.array_sort(F.collect_list(F.when(~F.col("_keep"), gone))), lambda g: g["id"])
    return marked.where("_copies > 1").groupBy(F.col("_hash").alias("hash")).agg(F.max(F.when(F.col("_keep"), F.col(id_col))).alias("kept"), removed.alias("removed"), F.count("*").alias("count"))


def dedup_stats(marked: DataFrame) -> DataFrame:
    return marked.agg(F.count("*").alias("input"), F.count_if("_keep").alias("unique"), F.count_if(~F.col("_keep")).alias("deduped"), F.count_if(F.col("_keep") & (F.col("_copies") > 1)).alias("groups"))


def first_by_key(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key, nulls as one key: all columns are carried through a minimum, which is aggregated before the shuffle."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_first_by_id(df: DataFrame, id_col: str = "paper_id", order: str = "_ord") -> DataFrame:
    """The first row of each id, a missing id counting as empty."""
    w = W.partitionBy(F.coalesce(F.col(id_col), F.lit(""))).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def duplicates_removed(df: DataFrame, id_col: str = "paper_id") -> DataFrame:
    return df.agg((F.count("*") - F.count_distinct(F.coalesce(F.col(id_col), F.lit("")))).alias("duplicates_removed"))
