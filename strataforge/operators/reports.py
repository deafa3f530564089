"""Histograms and usage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Dollars a million tokens, in and out.
PRICES = (0.14, 0.28)


def histogram(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(column, n), most first, ties by value; top: only that many."""
    out = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return out if top is None else out.limit(top)


def array_histogram(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    return histogram(df.select(F.explode(column).alias(column)), column, top)


def usage(df: DataFrame, tokens_in: str = "tokens.input", tokens_out: str = "tokens.output", corpus: int | None = None, prices=PRICES) -> DataFrame:
    """One row: calls, tokens, means, cost, cost a record and of a corpus of that many records."""
    i, o = F.coalesce(F.sum(tokens_in), F.lit(0)), F.coalesce(F.sum(tokens_out), F.lit(0))
    cost = (i * prices[0] + o * prices[1]) / 1_000_000
    n = F.count("*")
    each = F.when(n > 0, cost / n).otherwise(F.lit(0.0))
    out = df.agg(n.alias("api_calls"), i.alias("prompt_tokens"), o.alias("completion_tokens"), (i + o).alias("total_tokens"), cost.alias("cost"), each.alias("cost_per_record"))
    return out if corpus is None else out.withColumn("projected_cost", F.col("cost_per_record") * corpus)


def survey_rows(df: DataFrame) -> DataFrame:
    """Sites of a mineral survey's table that have a place, a commodity, a producing status and a name."""
    name = F.trim(F.coalesce("site_name", F.lit("")))
    ok = F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("dev_stat").isin("Producer", "Past Producer") & F.col("commod1").isNotNull() & ~F.lower(name).isin("", "nan")
    rows = df.where(ok)
    return rows.select(name.alias("name"), F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"), F.coalesce("country", F.lit("")).alias("country"), F.coalesce("dep_type", F.lit("")).alias("type"), F.col("commod1").alias("commodity"))
