"""Queries over the driver tables: content hashes, monitoring, evaluation against catalogues and picks of records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, enrich, lookup, monitor, records, score
from ..streaming import ingest
from .base import register, table
from .matching import _DEPOSITS, _PAPERS, _papers

_K = "(props ->> '$.k')::BIGINT"


@register(f"SELECT event_id, event_id = min(event_id) OVER (PARTITION BY {_K} % 7, event_type) AS kept, count(*) OVER (PARTITION BY {_K} % 7, event_type) AS copies FROM events")
def content_hash_raw(spark, d):
    """Raw JSON records with keys in either order, ids and underscored keys left out, grouped by their canonical content."""
    k, kind = (F.get_json_object("props", "$.k").cast("long") % 7).cast("string"), F.concat(F.lit('"'), "event_type", F.lit('"'))
    one = F.concat(F.lit('{"paper_id": "'), F.col("event_id").cast("string"), F.lit('", "k": '), k, F.lit(', "t": '), kind, F.lit("}"))
    two = F.concat(F.lit('{"t": '), kind, F.lit(', "_at": '), F.col("event_id").cast("string"), F.lit(', "k": '), k, F.lit("}"))
    rows = table(spark, d, "events").select(F.col("event_id").cast("string").alias("paper_id"), F.col("event_id").alias("_ord"), F.when(F.col("event_id") % 2 == 0, one).otherwise(two).alias("raw"))
    marked = dedup.mark_duplicates(rows, dedup.raw_content_hash("raw"))
    return marked.select(F.col("_ord").alias("event_id"), F.col("_keep").alias("kept"), F.col("_copies").alias("copies"))


@register("""SELECT c_custkey, c_custkey = min(c_custkey) OVER w AS kept, count(*) OVER w AS copies FROM customer
    WINDOW w AS (PARTITION BY c_nationkey, c_mktsegment, c_custkey % 2)""")
def content_hash_typed(spark, d):
    rows = table(spark, d, "customer")
    rows = rows.select(F.col("c_custkey").alias("_ord"), F.col("c_name").alias("paper_id"), "c_nationkey", "c_mktsegment", F.struct((F.col("c_custkey") % 2).alias("odd")).alias("inner"))
    marked = dedup.mark_duplicates(rows, dedup.content_hash(rows))
    return marked.select(F.col("_ord").alias("c_custkey"), F.col("_keep").alias("kept"), F.col("_copies").alias("copies"))


def _monitored(spark, d, shift: float):
    place = enrich.place(F.col("c_nationkey") * 4.0 + shift, F.lit(10.0), "x", F.lit("s"), F.lit(0.5), "model")
    scale = F.struct(F.create_map(F.lit("cu_percent"), F.col("c_acctbal") / 100).alias("grade"), F.struct((F.col("c_custkey") * 100.0).alias("value")).alias("tonnage"))
    some = F.when(F.col("c_custkey") % 10 > 0, F.array(F.lit("x")))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("_ord"), place.alias("coordinates"), scale.alias("deposit_scale"), F.lit("g").alias("geochemistry"), some.alias("minerals"), F.array(F.lit("Cu")).alias("commodities"))


@register("""SELECT *, CASE WHEN errors > 0 THEN 'STOP' WHEN warnings > total * 0.2 THEN 'CAUTION' ELSE 'CONTINUE' END AS decision FROM (
    SELECT count(*) AS total, (count(*) FILTER (c_nationkey * 4.0 + 20 > 90) + count(*) FILTER (c_acctbal < 0) + count(*) FILTER (c_acctbal / 100 > 100))::BIGINT AS errors,
        (count(*) FILTER (c_custkey * 100.0 > 100000) + CASE WHEN count(*) FILTER (c_custkey % 10 > 0) / count(*) < 0.95 THEN 1 ELSE 0 END)::BIGINT AS warnings FROM customer)""")
def monitor_batch(spark, d):
    out = monitor.monitor(_monitored(spark, d, 20.0))
    return out.select("total", F.col("errors").cast("long").alias("errors"), F.col("warnings").cast("long").alias("warnings"), "decision")


@register("""WITH f AS (SELECT unnest(['text', 'lang', 'quality', 'toxic']) AS field, unnest([count(*) FILTER (text <> ''), count(*) FILTER (lang <> ''), count(*) FILTER (quality <> 0), count(*) FILTER (toxic <> 0)]) / count(*) AS rate
        FROM documents LEFT JOIN labels USING (doc_id))
    SELECT field, CASE WHEN rate >= 0.8 THEN 'good' WHEN rate >= 0.5 THEN 'fair' ELSE 'poor' END AS grade, (SELECT CASE WHEN avg(rate) >= 0.7 THEN 'deploy' WHEN avg(rate) >= 0.5 THEN 'tune' ELSE 'redesign' END FROM f) AS verdict FROM f""")
def fill_grades(spark, d):
    rates = monitor.fill_rates(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), ["text", "lang", "quality", "toxic"])
    told = monitor.mean_fill(rates).select(monitor.verdict(F.col("mean_rate")).alias("verdict"))
    return monitor.graded(rates).crossJoin(F.broadcast(told)).select("field", "grade", "verdict")  # told: one row


@register(f"""WITH p AS ({_PAPERS}) SELECT id, name FROM (
    SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM p JOIN (VALUES {', '.join(map(str, _DEPOSITS))}) v(ord, name, country)
        ON contains(text, name) AND (land IS NULL OR contains(country, land) OR contains(land, country))) WHERE rn = 1""")
def famous_match(spark, d):
    dim = spark.createDataFrame(_DEPOSITS, "ord int, name string, country string")
    out = lookup.named_in(_papers(spark, d), F.lower("text"), lookup.claimed_countries("countries"), dim)
    return out.select(F.col("_ord").alias("id"), F.col("hit.name").alias("name"))


_CATALOGUE = ((0, "Bushveld Complex", "VMS"), (1, "Carlin", "SMS"), (2, "Sudbury", "SKARN-FE"), (3, "Nowhere", "VMS"), (4, "Untyped", ""))
_NAMES = ("Bushveld Complex", "carlin trend", "Sudbury", "unknown place", "")


def _typed(spark, d):
    """suppliers as typed records that refer to a deposit."""
    k = F.col("s_suppkey")
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (k % len(_NAMES) + 1).cast("int"))
    kind = F.when(k % 3 == 0, "VMS").when(k % 3 == 1, "SMS").otherwise("SKARN-FE")
    return table(spark, d, "supplier").select(k.alias("_ord"), F.col("s_name").alias("paper_id"), kind.alias("deposit_type"), F.lit("").alias("metallogenic_belt"), F.array(F.struct(name.alias("name"))).alias("reference_deposits"))


_TYPED = f"SELECT s_suppkey AS k, {list(_NAMES)}[(s_suppkey % {len(_NAMES)} + 1)::INT] AS ref, CASE s_suppkey % 3 WHEN 0 THEN 'VMS' WHEN 1 THEN 'SMS' ELSE 'SKARN-FE' END AS kind FROM supplier"
_SCORED = "CASE WHEN kind = '' OR type = '' THEN 0.0 WHEN kind = type THEN 1.0 WHEN kind IN ('VMS', 'SMS') AND type IN ('VMS', 'SMS') THEN 0.5 ELSE 0.0 END::DOUBLE"


@register(f"""WITH r AS ({_TYPED}), f AS (SELECT * FROM (VALUES {', '.join(map(str, _CATALOGUE))}) v(ord, name, type)),
    h AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY upper(name) <> upper(ref), ord) AS rn FROM r JOIN f ON ref <> '' AND (contains(upper(name), upper(ref)) OR contains(upper(ref), upper(name))))
    SELECT k AS s_suppkey, name AS famous_name, {_SCORED} AS score FROM h WHERE rn = 1""")
def reference_match(spark, d):
    famous = spark.createDataFrame(_CATALOGUE, "ord int, name string, type string")
    return score.match_references(_typed(spark, d), famous).select(F.col("_ord").alias("s_suppkey"), "famous_name", "score")


@register(f"""WITH r AS ({_TYPED}), f AS (SELECT * FROM (VALUES {', '.join(map(str, _CATALOGUE))}) v(ord, name, type) WHERE type <> ''),
    e AS (SELECT name, k, kind, type FROM f JOIN r ON upper(ref) = upper(name)),
    n AS (SELECT DISTINCT f.name, first_value(upper(r.ref)) OVER (PARTITION BY f.name ORDER BY r.at, upper(r.ref)) AS ref FROM f JOIN (SELECT ref, min(k) AS at FROM r WHERE ref <> '' GROUP BY ref) r
        ON contains(upper(r.ref), upper(f.name)) OR contains(upper(f.name), upper(r.ref)) WHERE f.name NOT IN (SELECT name FROM e)),
    a AS (SELECT * FROM e UNION ALL SELECT f.name, k, kind, type FROM n JOIN f USING (name) JOIN r ON upper(r.ref) = n.ref),
    b AS (SELECT name, max({_SCORED}) AS score, count(*) AS matched FROM a GROUP BY name)
    SELECT f.name AS deposit, b.score, CASE WHEN b.name IS NULL THEN 'not_found' WHEN b.score >= 0.5 THEN 'PASS' ELSE 'FAIL' END AS status, coalesce(matched, 0) AS matched_papers FROM f LEFT JOIN b USING (name)""")
def regression_whole(spark, d):
    """The regression run over records and catalogue, from the name index to the status of each entry."""
    famous = spark.createDataFrame(_CATALOGUE, "ord int, name string, type string")
    return score.regression(_typed(spark, d), famous).select("deposit", "score", "status", "matched_papers")


@register("SELECT p_partkey FROM part WHERE p_type = (SELECT min(p_type) FROM part) ORDER BY p_partkey LIMIT 20")
def class_head(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("deposit_class"))
    first = parts.agg(F.min("deposit_class")).first()[0]
    return records.head_of_class(parts, first, 20, order="p_partkey").select("p_partkey")


@register("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = (SELECT min(o_orderpriority) FROM orders))")
def id_subset(spark, d):
    orders = table(spark, d, "orders")
    least = orders.agg(F.min("o_orderpriority")).first()[0]
    asked = orders.where(F.col("o_orderpriority") == least).select(F.col("o_custkey").alias("c_custkey"))
    return records.only_ids(table(spark, d, "customer"), asked, "c_custkey").select("c_custkey", "c_name")


@register("SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 1 AND contains(lower(n_name), 'nation_1')")
def pick_by_type_country(spark, d):
    named = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    dim = named.select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 1, "VMS").otherwise("SKARN").alias("type"), F.col("n_name").alias("country"))
    return records.pick_entries(dim, "vms", "NATION_1").select("s_suppkey")


@register("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def window_counts(spark, d):
    """The streaming window operator on a finite table, where no row is late."""
    return ingest.windowed_counts(table(spark, d, "events"), "ts", "event_type").select("start", "event_type", "n")


@register("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 OR c_nationkey IS NULL THEN 'none' WHEN c_nationkey / 24.0 >= 0.9 THEN 'precise' WHEN c_nationkey / 24.0 >= 0.7 THEN 'usable' ELSE 'coarse' END AS slice FROM customer""")
def coordinate_slices(spark, d):
    place = enrich.place(F.lit(1.0), F.lit(1.0), "x", F.lit("s"), F.col("c_nationkey") / 24.0, "model")
    rows = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, place).alias("coordinates"))
    return records.coordinate_slices(rows).select("c_custkey", F.col("coordinate_slice").alias("slice"))


@register("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE (text <> '')::INT + (coalesce(quality, 0) <> 0)::INT + (coalesce(toxic, 0) <> 0)::INT + (coalesce(source, '') <> '')::INT >= 3")
def populated_fields(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return records.populated(rows, ["text", "quality", "toxic", "source"], 3).select("doc_id")
