"""Command line: the pipelines over files. Exit codes: 0 good, 1 failed or stop, 2 caution."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import dedup, dimensions, enrich, gate, monitor, qa, records, reports, route, score, validate
from .sources import readers, sinks


def process(spark: SparkSession, source: str, out: str) -> int:
    """De-dup by raw content, triage, prove that nothing got lost; writes records by bucket and three reports."""
    raw = records.with_ordinal(readers.read_raw_records(spark, source), "_file", "_pos")
    rows = raw.select("_ord", "raw", F.get_json_object("raw", "$.paper_id").alias("paper_id"), F.get_json_object("raw", "$._gate_result").alias("_gate_result"), F.get_json_object("raw", "$._gate_status").alias("_gate_status"))
    # several outputs read it: written once, so that its ordinals are the same for all
    dedup.mark_duplicates(rows, dedup.raw_content_hash("raw")).write.mode("overwrite").parquet(f"{out}/_marked")
    marked = spark.read.parquet(f"{out}/_marked")
    rows = marked
    routed = route.triage(dedup.unique_rows(marked))
    sinks.write_lines(dedup.duplicate_groups(marked), f"{out}/duplicate_groups")
    sinks.write_report(dedup.dedup_stats(marked), f"{out}/dedup_report")
    routed.select("bucket", F.col("raw").alias("value")).write.mode("overwrite").partitionBy("bucket").text(f"{out}/records")
    sinks.write_report(route.triage_stats(routed), f"{out}/triage_stats")
    report = route.reconcile(rows, routed, dedup.removed_rows(marked))
    sinks.write_report(report, f"{out}/reconcile_report")
    return 0 if spark.read.json(f"{out}/reconcile_report").first()["reconciled"] else 1


def gate_records(spark: SparkSession, source: str, out: str) -> int:
    gated = gate.gate(records.with_legacy(readers.read_records(spark, source)))
    sinks.write_lines(gated, f"{out}/gated")
    sinks.write_report(gate.gate_report(gated), f"{out}/gate_report")
    sinks.write_lines(gate.flag_histogram(gated), f"{out}/flags")
    return 0


def postprocess(spark: SparkSession, source: str, out: str, belts: str | None = None, deposits: str | None = None) -> int:
    """Clean, place by deposits and belts, note provenance. Belts and deposits: files of larger tables."""
    rows = readers.read_records(spark, source)
    known = dimensions.curated(spark)
    if deposits:
        more = lookup_more(spark, deposits)
        known = known.unionByName(more.withColumn("ord", F.col("ord") + 100_000).select(known.columns))
    belt = dimensions.from_file(spark, belts, "belts") if belts else dimensions.alias_belts(spark).select("ord", "name", "lat", "lon")
    done = enrich.postprocess(rows, known, dimensions.trusted(spark), belt)
    sinks.write_lines(done, f"{out}/records")
    sinks.write_report(enrich.coverage(spark.read.schema(done.schema).json(f"{out}/records")), f"{out}/coverage")
    return 0


def lookup_more(spark: SparkSession, deposits: str):
    from .operators.lookup import trusted_entries

    return trusted_entries(dimensions.from_file(spark, deposits, "deposits"), dimensions.trusted(spark), dimensions.curated(spark))


def monitor_batch(spark: SparkSession, source: str, out: str) -> int:
    rows = readers.read_records(spark, source)
    sinks.write_lines(monitor.against_thresholds(monitor.fill_rates(rows, list(monitor.FILL_THRESHOLDS))), f"{out}/fill_rates")
    sinks.write_report(monitor.monitor(rows), f"{out}/decision")
    return monitor.exit_code(spark.read.json(f"{out}/decision"))


def validate_places(spark: SparkSession, source: str, out: str) -> int:
    checked = validate.validate(readers.read_records(spark, source))
    sinks.write_lines(checked.select("paper_id", "coordinates", "countries", "validation"), f"{out}/validation")
    sinks.write_report(validate.validation_stats(checked), f"{out}/stats")
    return 0


def evaluate(spark: SparkSession, source: str, out: str, deposits: str, strict: bool = False) -> int:
    rows, known = readers.read_records(spark, source), dimensions.from_file(spark, deposits, "deposits")
    sinks.write_report(score.evaluation(score.match_references(rows, known)), f"{out}/evaluation")
    results = score.regression(rows, known, strict)
    sinks.write_lines(results, f"{out}/regression")
    sinks.write_report(score.regression_report(results), f"{out}/regression_report")
    score.check_lines(rows).write.mode("overwrite").text(f"{out}/checklist")
    return 0


def questions(spark: SparkSession, source: str, out: str, least: int = 2) -> int:
    rows = records.with_legacy(readers.read_records(spark, source))
    made = qa.expand(rows, least_fields=least)
    sinks.write_lines(made, f"{out}/qa")
    sinks.write_lines(qa.dimension_counts(made), f"{out}/dimensions")
    return 0


def survey(spark: SparkSession, source: str, out: str) -> int:
    """A mineral survey's CSV, fetched beforehand, as a table of deposits with histograms."""
    sites = reports.survey_rows(readers.read_csv(spark, source, "site_name string, latitude string, longitude string, country string, dep_type string, commod1 string, dev_stat string"))
    sinks.write_lines(sites, f"{out}/deposits")
    for column in ("country", "commodity", "type"):
        sinks.write_lines(reports.histogram(sites, column, 20), f"{out}/top_{column}")
    return 0


COMMANDS = {"process": process, "gate": gate_records, "postprocess": postprocess, "monitor": monitor_batch, "validate": validate_places, "evaluate": evaluate, "questions": questions, "survey": survey}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strataforge", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("source")
    parser.add_argument("out")
    parser.add_argument("--belts")
    parser.add_argument("--deposits")
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--min-fields", type=int, default=2)
    given = parser.parse_args(args)
    more = {"postprocess": {"belts": given.belts, "deposits": given.deposits}, "evaluate": {"deposits": given.deposits, "strict": given.strict}, "questions": {"least": given.min_fields}}
    spark = SparkSession.builder.appName("strataforge").getOrCreate()
    return COMMANDS[given.command](spark, given.source, given.out, **more.get(given.command, {}))


if __name__ == "__main__":
    sys.exit(main())
