"""Operator 10: exact top-k search of binary codes by incremental multi-index hashing.

Codes of 64 bits (the signs of an embedding) are cut into segments, and the index has a row (segment, value, code) for each.  A search
probes all values within radius 0, 1, 2, ... of its own segments; after radius r in every segment, each code nearer than
segments * (r + 1) has been seen, so a search ends as soon as k ids are verified below that bound: nothing else can come before.

Index and probes meet in an equi-join on (segment, value), so a task holds some values' part of both and neither the whole index nor all
queries.  A round probes one radius for the queries that are still open; a pair is verified once, at the first of the segments in
which it is nearest, and is a candidate if it isn't farther than the k-th so far; the best k codes of a query are kept between rounds.  Equal codes are one entry, and equal
queries one search, however many rows have them.  There are about 64 / log2(codes) segments, so that a value has about one code.

Distance ties are broken by id; a query row finds itself at distance 0.  Null vectors, vectors of other
than 64 places and rows with null ids are left out of index and queries; null places count as negative.
Fewer than k rows give fewer results; repeated ids are rows of their own in the index, repeated query rows are one query.  Further columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .store import free, pick, staged

BITS = 64
SALTS = 64
PART_PROBES = 1_000_000
TOP = 10


def codes(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Rows (id, code): bit b is set where place b of the vector is positive."""
    df, v = pick(df, key=key, vector=vector), F.col("vector")
    bits = [F.when(F.coalesce(F.get(v, F.lit(b)) > 0, F.lit(False)), F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for b in range(64)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return df.where(F.col("key").isNotNull() & v.isNotNull() & (F.size(v) == 64)).select(F.col("key").cast("long").alias("id"), total.alias("code"))


def segments(n: int) -> int:
    """How many segments to cut codes into: 2, 4 or 8."""
    return min((2, 4, 8), key=lambda s: abs(s - BITS / max(1.0, math.log2(max(2, n)))))


def _part(code: Column, s: int, width: int) -> Column:
    return F.shiftrightunsigned(code, s * width).bitwiseAND((1 << width) - 1)


def _entries(base: DataFrame, k: int) -> DataFrame:
    """Rows (code, ids): each code's k smallest ids, which is all that ties by id can need. A code's rows are cut in parts first."""
    salted = base.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for by in (["code", "salt"], ["code"]):
        salted = salted.withColumn("nth", F.row_number().over(W.partitionBy(*by).orderBy("id"))).where(F.col("nth") <= k)
    return salted.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _probes(open_: DataFrame, radius: int, count: int, width: int) -> DataFrame:
    """(asked, within, seg, value): every value that differs from the query's segment in radius bits."""
    rows = open_.select("asked", "within", F.lit(0).cast("long").alias("mask"), F.lit(-1).alias("top"))
    for left in range(radius, 0, -1):
        rows = rows.select("asked", "within", "mask", F.explode(F.sequence(F.col("top") + 1, F.lit(width - left))).alias("top")).select("asked", "within", (F.col("mask") + F.expr("shiftleft(1L, top)")).alias("mask"), "top")
    parts = F.array(*[F.struct(F.lit(s).alias("seg"), _part(F.col("asked"), s, width).bitwiseXOR(F.col("mask")).alias("value")) for s in range(count)])
    return rows.select("asked", "within", F.explode(parts).alias("p")).select("asked", "within", "p.seg", "p.value")


def top_k(base: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """base and queries: rows (id, code). Rows (query_id, rank, id, distance), ranks from 1."""
    spark = base.sparkSession
    base = staged(base, "codes")
    entries = staged(_entries(base, k), "entries")
    n, ids = entries.agg(F.count("*"), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    k, count = min(k, ids), segments(n)
    width = BITS // count
    parts = F.array(*[F.struct(F.lit(s).alias("seg"), _part(F.col("code"), s, width).alias("value")) for s in range(count)])
    index = entries.select("code", F.col("ids")[0].alias("least"), F.size("ids").alias("held"), F.explode(parts).alias("p")).select("p.seg", "p.value", "code", "least", "held")
    asked = staged(queries.select(F.col("id").alias("query_id"), F.col("code").alias("asked")).distinct(), "asked")
    open_ = staged(asked.select("asked", F.lit(BITS).alias("within")).distinct(), "open")
    best = staged(spark.createDataFrame([], "asked long, code long, least long, held int, distance int"), "best")
    done, radius, apart = [], 0, F.col("asked").bitwiseXOR(F.col("code"))
    near = [F.bit_count(_part(apart, s, width)) for s in range(count)]
    first = F.coalesce(*[F.when(x == F.least(*near), F.lit(s)) for s, x in enumerate(near)])
    while k and radius <= width and not open_.isEmpty():
        probes = open_.count() * count * math.comb(width, radius)
        dealt = open_.repartition(max(1, math.ceil(probes / PART_PROBES)), "asked")
        # sorted at any size: what a query's explosion comes to can't be told from the table it begins with
        pairs = _probes(dealt, radius, count, width).join(index.hint("merge"), ["seg", "value"])
        found = pairs.where((F.least(*near) == radius) & (first == F.col("seg")) & (F.bit_count(apart) <= F.col("within"))).select("asked", "code", "least", "held", F.bit_count(apart).alias("distance"))
        nth = F.row_number().over(W.partitionBy("asked").orderBy("distance", "least"))
        kept = staged(best.unionByName(found).withColumn("nth", nth).where(F.col("nth") <= k).drop("nth"), "best")
        settled = staged(kept.where(F.col("distance") < count * (radius + 1)).groupBy("asked").agg(F.sum("held").alias("held")).where((F.col("held") >= k) | F.lit(radius == width)).select("asked"), "settled")
        done.append(staged(kept.join(settled, "asked", "left_semi"), "done"))
        before, best = [best, open_, kept], staged(kept.join(settled, "asked", "left_anti"), "best")
        limits = best.groupBy("asked").agg(F.when(F.sum("held") >= k, F.max("distance")).otherwise(BITS).alias("within"))
        open_ = staged(open_.join(settled, "asked", "left_anti").select("asked").join(limits, "asked", "left").select("asked", F.coalesce("within", F.lit(BITS)).alias("within")), "open")
        free(*before, settled)
        radius += 1
    found = best.where("false") if not done else done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    rows = found.join(entries, "code").select("asked", "distance", F.explode("ids").alias("id"))
    rank = F.row_number().over(W.partitionBy("asked").orderBy("distance", "id")).cast("long")
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= k)
    return asked.join(rows, "asked").select("query_id", "rank", "id", "distance")
