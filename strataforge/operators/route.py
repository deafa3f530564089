"""Triage into buckets, proof that no record got lost, and their reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .records import drop_prefixed

BUCKETS = ("trusted", "review", "quarantine")


def bucket(df: DataFrame, compat: bool = False) -> Column:
    """pass to trusted, warn to review, fail to quarantine, anything else to review, nothing to trusted.

    compat: look at _gate_result alone, which the gate of this library doesn't write.
    """
    names = ["_gate_result"] if compat else ["_gate_result", "_gate_status"]
    given = [F.col(n) for n in names if n in df.columns]
    status = F.coalesce(*given, F.lit("pass"))
    return F.when(status == "pass", "trusted").when(status == "fail", "quarantine").otherwise("review")


def triage(df: DataFrame, compat: bool = False) -> DataFrame:
    """df with bucket, without the gate's columns."""
    return drop_prefixed(df.withColumn("bucket", bucket(df, compat)), "_gate_")


def split_accepting_warnings(df: DataFrame) -> DataFrame:
    """The extractor's own split: everything but fail is trusted."""
    return df.withColumn("bucket", F.when(F.coalesce("_gate_status", F.lit("")) == "fail", "quarantine").otherwise("trusted"))


def triage_stats(routed: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("bucket") == b) for b in BUCKETS]
    return routed.agg(F.count("*").alias("input"), *[c.alias(b) for b, c in zip(BUCKETS, counts, strict=True)], reduce(lambda x, y: x + y, counts).alias("output"))


def write_buckets(routed: DataFrame, path: str) -> None:
    routed.write.mode("overwrite").partitionBy("bucket").json(path)


def id_differences(before: DataFrame, after: DataFrame, id_col: str = "paper_id") -> DataFrame:
    """Ids of one side only: rows (paper_id, side) with side missing or extra; null is an id."""
    sides = before.select(F.col(id_col).alias("paper_id"), F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(F.col(id_col).alias("paper_id"), F.lit(0).alias("b"), F.lit(1).alias("a")))
    # one shuffle for both differences, aggregated before it
    both = sides.groupBy("paper_id").agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return both.where("a <> b").select("paper_id", F.when(F.col("b") == 1, "missing").otherwise("extra").alias("side"))


def reconcile(before: DataFrame, routed: DataFrame, removed: DataFrame, id_col: str = "paper_id", listed: int | None = None) -> DataFrame:
    """One row: whether the distinct ids agree, counts, missing and extra ids (all, or the first few), and whether rows agree too."""
    after = routed.select(id_col).unionByName(removed.select(id_col))
    gone = id_differences(before, after, id_col)
    if listed is not None:
        from pyspark.sql.window import Window as W

        gone = gone.withColumn("_n", F.row_number().over(W.partitionBy("side").orderBy("paper_id"))).withColumn("paper_id", F.when(F.col("_n") <= listed, F.col("paper_id")))

    def ids(side: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("paper_id")))).alias(side)

    lost = gone.agg(ids("missing"), ids("extra"), F.count_if(F.col("side") == "missing").alias("n_missing"), F.count_if(F.col("side") == "extra").alias("n_extra"))
    counts = before.agg(F.count("*").alias("input"))
    stats = routed.agg(*[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS])
    dedup = removed.agg(F.count("*").alias("deduped"))
    output = after.agg(F.count_distinct(id_col).alias("output"), F.count("*").alias("rows_out"))
    # five tables of one row each
    row = reduce(lambda x, y: x.crossJoin(F.broadcast(y)), [counts, stats, dedup, output, lost])
    return row.select(((F.col("n_missing") == 0) & (F.col("n_extra") == 0)).alias("reconciled"), "input", *BUCKETS, "deduped", "output", "missing", "extra", (F.col("input") == F.col("rows_out")).alias("rows_reconciled"))


def exit_code(reconciled: DataFrame) -> int:
    """0 if the one row says that all is there, else 1."""
    return 0 if reconciled.select("reconciled").first()[0] else 1
