"""Fill rates, validity of values, and the decision whether a batch may go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.collections import truthy_field
from .fixed import FILL_THRESHOLDS

MOST_TONNAGE = 100_000
WARNED_SHARE = 0.2
EXIT_CODES = {"CONTINUE": 0, "STOP": 1, "CAUTION": 2}


def fill_rates(df: DataFrame, fields) -> DataFrame:
    """(field, filled, total, rate): one pass over the rows, then one row a field."""
    one = df.agg(F.count("*").alias("total"), *[F.count_if(truthy_field(df, f)).alias(f"n{k}") for k, f in enumerate(fields)])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n{k}").alias("filled")) for k, f in enumerate(fields)])
    out = one.select("total", F.inline(pairs))
    return out.select("field", "filled", "total", F.when(F.col("total") > 0, F.col("filled") / F.col("total")).otherwise(F.lit(0.0)).alias("rate"))


def against_thresholds(rates: DataFrame, thresholds=FILL_THRESHOLDS) -> DataFrame:
    limits = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
    return rates.withColumn("threshold", limits[F.col("field")]).withColumn("ok", F.col("rate") >= F.col("threshold"))


def graded(rates: DataFrame, good: float = 0.8, fair: float = 0.5) -> DataFrame:
    return rates.withColumn("grade", F.when(F.col("rate") >= good, "good").when(F.col("rate") >= fair, "fair").otherwise("poor"))


def mean_fill(rates: DataFrame) -> DataFrame:
    return rates.agg(F.sum("filled").alias("filled"), F.avg("rate").alias("mean_rate"))


def verdict(mean_rate: Column, deploy: float = 0.7, tune: float = 0.5) -> Column:
    return F.when(mean_rate >= deploy, "deploy").when(mean_rate >= tune, "tune").otherwise("redesign")


def record_errors(df: DataFrame) -> Column:
    """Impossible values of a record: coordinates out of range (0 counts as not given), negative grades, percentages above 100."""
    lat, lon = F.col("coordinates.latitude"), F.col("coordinates.longitude")
    grades = F.map_entries(F.coalesce("deposit_scale.grade", F.create_map().cast("map<string,double>")))
    bad = F.flatten(F.transform(grades, lambda e: F.array_compact(F.array(F.when(e["value"] < 0, F.concat(F.lit("negative grade "), e["key"])), F.when(e["key"].contains("percent") & (e["value"] > 100), F.concat(F.lit("above 100 % "), e["key"]))))))
    place = F.array_compact(F.array(F.when((lat != 0) & ~lat.between(-90, 90), F.lit("latitude out of range")), F.when((lon != 0) & ~lon.between(-180, 180), F.lit("longitude out of range"))))
    return F.concat(place, bad)


def record_warnings(df: DataFrame) -> Column:
    t = F.col("deposit_scale.tonnage.value")
    return F.array_compact(F.array(F.when((t < 0) | (t > MOST_TONNAGE), F.lit("unusual tonnage"))))


def decide(errors: Column, warnings: Column, total: Column) -> Column:
    return F.when(errors > 0, "STOP").when(warnings > total * WARNED_SHARE, "CAUTION").otherwise("CONTINUE")


def monitor(df: DataFrame, thresholds=FILL_THRESHOLDS) -> DataFrame:
    """One row: total, errors, warnings (of records and of fill rates) and decision."""
    one = df.withColumn("_e", F.size(record_errors(df))).withColumn("_w", F.size(record_warnings(df)))
    rates = {f: F.count_if(truthy_field(df, f)) / F.count("*") for f in thresholds}
    low = sum((F.when(F.coalesce(r, F.lit(0.0)) < thresholds[f], 1).otherwise(0) for f, r in rates.items()), F.lit(0))
    out = one.agg(F.count("*").alias("total"), F.coalesce(F.sum("_e"), F.lit(0)).alias("errors"), (F.coalesce(F.sum("_w"), F.lit(0)) + low).alias("warnings"))
    return out.withColumn("decision", decide(F.col("errors"), F.col("warnings"), F.col("total")))


def first_errors(df: DataFrame, n: int = 5, order: str = "_ord") -> DataFrame:
    return df.select(order, F.explode(record_errors(df)).alias("error")).orderBy(order, "error").limit(n)


def exit_code(decision: DataFrame) -> int:
    return EXIT_CODES[decision.select("decision").first()[0]]
