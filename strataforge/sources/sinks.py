"""Sinks: JSON arrays, reports, lines, Parquet, a file a record, checklists; manifests of what is done."""

from __future__ import annotations

import hashlib
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_name


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def json_array(df: DataFrame, order: str = "_ord") -> DataFrame:
    """Lines of one JSON array in order: an opening line, a record a line, a closing line. Sorted by ranges, never gathered."""
    body = df.select(F.col(order).cast("double").alias("_o"), F.to_json(F.struct(*[c for c in df.columns if c != order]), {"ignoreNullFields": "false"}).alias("value"))
    last = body.agg(F.max("_o").alias("_last"))
    body = body.crossJoin(F.broadcast(last)).select("_o", F.when(F.col("_o") == F.col("_last"), F.col("value")).otherwise(F.concat("value", F.lit(","))).alias("value"))
    spark = df.sparkSession
    ends = spark.createDataFrame([(float("-inf"), "["), (float("inf"), "]")], "_o double, value string")
    return body.unionByName(ends).orderBy("_o").select("value")


def write_json_array(df: DataFrame, path: str, order: str = "_ord") -> None:
    """Text files that, taken in order of name, are one JSON array."""
    json_array(df, order).write.mode("overwrite").text(path)


def write_report(row: DataFrame, path: str) -> None:
    """A report is one row, so one file."""
    row.coalesce(1).write.mode("overwrite").json(path)


def write_per_record(df: DataFrame, path: str, id_col: str = "paper_id", text: str = "text") -> None:
    """A folder a record, named safely after its id."""
    df.select(safe_name(id_col).alias("name"), F.col(text).alias("value")).write.mode("overwrite").partitionBy("name").text(path, lineSep="\0")


def safe_path(folder: str, record_id: str, extension: str = ".json") -> str:
    """The path for a record's file; raises if it would leave the folder."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    name = spark.createDataFrame([(record_id,)], "id string").select(safe_name("id")).first()[0]
    name = name if name.endswith(extension) else name + extension
    root = posixpath.normpath(folder)
    out = posixpath.normpath(posixpath.join(root, name))
    if not out.startswith(root + "/"):
        raise ValueError(f"{record_id!r} leads out of {folder}")
    return out


def prompt_hash(prompt: str) -> str:
    """The first 16 hex digits of a prompt's SHA-256."""
    return hashlib.sha256(prompt.encode()).hexdigest()[:16]


MANIFEST = "prompt_hash string, paper_id string, decision string"


def done_ids(spark: SparkSession, path: str, current: str) -> DataFrame:
    """Ids that the manifest has for the current prompt; empty where it has none."""
    try:
        rows = spark.read.schema(MANIFEST).json(path)
    except Exception as e:  # no manifest yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], MANIFEST)
    return rows.where(F.col("prompt_hash") == current).select("paper_id").distinct()


def add_done(ids: DataFrame, path: str, current: str, decision: str = "extracted") -> None:
    """Append ids; earlier ones are never rewritten, so a rerun loses nothing."""
    ids.select(F.lit(current).alias("prompt_hash"), "paper_id", F.lit(decision).alias("decision")).write.mode("append").json(path)


def upgrade_manifest(spark: SparkSession, legacy: str, path: str, current: str) -> None:
    """A bare list of ids, or an object with prompt_hash and ids, as lines of a manifest."""
    text = spark.read.text(legacy, wholetext=True)
    bare = F.from_json("value", "array<string>")
    kept = F.from_json("value", "prompt_hash string, ids array<string>")
    rows = text.select(F.when(F.ltrim("value").startswith("["), F.struct(F.lit(current).alias("prompt_hash"), bare.alias("ids"))).otherwise(kept).alias("m"))
    rows.select("m.prompt_hash", F.explode("m.ids").alias("paper_id"), F.lit("extracted").alias("decision")).write.mode("append").json(path)
