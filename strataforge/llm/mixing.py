"""Operator 9: weighted fair queueing of sources up to a total budget.

Every document gets a place in a shuffle of its source (a keyed hash of doc_id) and a virtual finish
time: the source's cumulative tokens up to and including it, divided by the source's target.  Later
passes over a source continue where the pass before ended, up to three passes.  All copies are sorted
by virtual finish time over range partitions and the longest prefix within the total budget is taken.

No running sum puts a source, or all rows, into one task: rows are range-sorted into partitions, partitions are summed first, and a row
adds its place within its partition to its partition's start.  Sources are ranked the same way, and their targets found by a few sums over
the table of sources, so that there may be as many sources as documents.

Null texts have size 0; null sources are one source, last in order.  Rows with null doc_id are mixed like others, shuffled by their
texts.  Rows that share a doc_id follow each other by a hash of their texts; only rows equal in id, source and text tie, and which of these
is taken more often makes no difference to the rows returned.  So reruns agree however the input is partitioned.  An empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .store import pick, staged

WEIGHTS = (5, 2, 1)
MOST = 3
PART_ROWS = 100_000


def _running(df: DataFrame, value: str, out: str, order: list[str], rows: int, name: str, lane: list[str] | None = None) -> DataFrame:
    """df with out: the sum of value up to and including each row in order, by lane (the first columns of order) if one is given."""
    lane = lane or []
    ranged = staged(df.repartitionByRange(max(1, math.ceil(rows / PART_ROWS)), *order).withColumn("part", F.spark_partition_id()), name)
    sums = ranged.groupBy("part", *lane).agg(F.sum(value).alias("in_part"))
    # of all lanes together there are at most as many rows as partitions and lanes
    starts = sums.select("part", *lane, F.coalesce(F.sum("in_part").over(W.partitionBy(*lane).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    within = F.sum(value).over(W.partitionBy("part", *lane).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return ranged.withColumn("within", within).join(starts, ["part", *lane]).withColumn(out, F.col("start") + F.col("within")).drop("part", "start", "within")


def _targets(sources: DataFrame, most: int) -> tuple[DataFrame, int]:
    """sources(weight, source_size, ...) with target, and the sum of all targets.

    Shares of the whole by weight, none above most times its size, the excess reshared: the share of a unit of weight rises until no further
    source is full, which takes a sum over the sources each time.
    """
    total, weight = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    unit, full = total / weight if weight else 0.0, -1
    while True:
        over = F.col("weight") * F.lit(float(unit)) > most * F.col("source_size")
        now, capped, free_weight = sources.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, most * F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if now == full or not free_weight:
            break
        full, unit = now, (total - capped) / free_weight
    target = F.when(over, (most * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.lit(float(unit)))
    return sources.withColumn("target", target.cast("double")), int(total if free_weight else capped)


def mix_sources(docs: DataFrame, weights=WEIGHTS, seed: int = 17, most: int = MOST, budget: float | None = None, text: str = "text", key: str = "doc_id", source: str = "source", place: str | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, copies. place: a column that tells rows apart, given back as place."""
    more = ["place"] if place else []
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = staged(
        pick(docs, doc_id=key, source=source, text=text, **({"place": place} if place else {}))
        .select(*more, F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), F.xxhash64(F.lit(seed), "text").alias("digest"))
        .withColumn("key", F.xxhash64(F.lit(seed), F.coalesce("doc_id", "digest")))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("lane", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))),
        "sizes",
    )
    n = rows.count()
    sources = rows.groupBy("lane").agg(F.sum("size").alias("source_size")).withColumns({"last": F.col("lane") == "-", "one": F.lit(1)})
    ranked = _running(sources, "one", "rank", ["last", "lane"], sources.count(), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources, whole = _targets(staged(ranked.select("lane", "source_size", weight.alias("weight")), "ranked"), most)
    lanes = staged(sources.select("lane", "source_size", "target"), "lanes")
    budget = whole if budget is None else budget
    placed = _running(rows.select("row", "doc_id", "digest", "size", "key", "lane"), "size", "cum", ["lane", "key", "doc_id", "digest", "row"], n, "placed", ["lane"]).join(lanes, "lane")
    copies = placed.where(F.col("size") > 0).select("row", "doc_id", "digest", "size", "source_size", "target", "cum", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("copy"))
    timed = copies.select("row", "doc_id", "digest", "size", "copy", ((F.col("cum") + (F.col("copy") - 1) * F.col("source_size")) / F.col("target")).alias("finish"))
    used = _running(timed, "size", "total", ["finish", "doc_id", "digest", "copy", "row"], most * n, "timed")
    taken = staged(used.where(F.col("total") <= F.lit(float(budget))).groupBy("row").agg(F.sum("size").alias("taken"), F.count("*").alias("copies")), "taken")
    return rows.join(lanes, "lane").join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "source", F.coalesce("copies", F.lit(0).cast("long")).alias("copies"), *more)
