"""Queries over the driver tables: de-dup, gate, triage, reconciliation, monitoring, text and collection functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import collections as fc
from ..functions import text as ft
from ..operators import dedup, gate, monitor, records, reports, route
from .base import register, table


def _records(spark: SparkSession, d: str) -> DataFrame:
    """documents as records: every third id carries a copy suffix, doc_id is the ordinal."""
    return table(spark, d, "documents").select(
        F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 0, "(1)").otherwise("")).alias("paper_id"), "text", F.col("doc_id").alias("_ord")
    )


_RECORDS = "SELECT source || '-' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '(1)' ELSE '' END AS paper_id, text, doc_id AS ord FROM documents"
_KEPT = f"""
    WITH r AS ({_RECORDS}), k AS (
        SELECT *, md5(text) AS hash, count(*) OVER (PARTITION BY text) AS copies,
               row_number() OVER (PARTITION BY text ORDER BY regexp_matches(paper_id, '\\(\\d+\\)$')::INT, ord) AS rn
        FROM r
    )"""


def _marked(spark: SparkSession, d: str) -> DataFrame:
    return dedup.mark_duplicates(_records(spark, d), F.md5("text"))


@register(f"{_KEPT} SELECT paper_id, hash, copies FROM k WHERE rn = 1")
def dedup_keeper(spark, d):
    return _marked(spark, d).where("_keep").select("paper_id", F.col("_hash").alias("hash"), F.col("_copies").alias("copies"))


@register(f"""{_KEPT} SELECT hash, max(CASE WHEN rn = 1 THEN paper_id END) AS kept,
    string_agg(CASE WHEN rn > 1 THEN paper_id END, ',' ORDER BY NOT regexp_matches(paper_id, '\\(\\d+\\)$'), ord) AS removed, count(*) AS count
    FROM k WHERE copies > 1 GROUP BY hash""")
def dedup_report(spark, d):
    return dedup.duplicate_groups(_marked(spark, d)).withColumn("removed", F.array_join("removed", ","))


@register(f"{_KEPT} SELECT count(*) AS input, count(*) FILTER (rn = 1) AS \"unique\", count(*) FILTER (rn > 1) AS deduped, count(*) FILTER (rn = 1 AND copies > 1) AS groups FROM k")
def dedup_stats(spark, d):
    return dedup.dedup_stats(_marked(spark, d))


@register("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
        FROM lineitem) WHERE rn = 1""")
def dedup_first_by_key(spark, d):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return dedup.first_by_key(table(spark, d, "lineitem").select(*cols), cols[:2], cols[2:])


@register("SELECT count(*) - count(DISTINCT coalesce(source, '')) AS duplicates_removed FROM documents")
def dedup_counter(spark, d):
    return dedup.duplicates_removed(table(spark, d, "documents"), "source")


@register("SELECT doc_id, substr(md5(source || '::' || doc_id), 1, 12) AS short, sha256(text) AS digest, substr(sha256(text), 1, 16) AS prompt FROM documents")
def content_id(spark, d):
    digest = F.sha2("text", 256)
    return table(spark, d, "documents").select("doc_id", ft.short_id("source", F.col("doc_id").cast("string")).alias("short"), digest.alias("digest"), ft.head(digest, 16).alias("prompt"))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """documents with a gate status from their labels: none where there is no label."""
    docs, labels = table(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("h")), table(spark, d, "labels")
    status = F.when(F.col("toxic") == 1, "fail").when(F.col("quality") == 0, "warn").when(F.col("quality") == 1, "pass")
    return docs.join(labels, "doc_id", "left").select(F.col("doc_id").cast("string").alias("paper_id"), F.col("doc_id").alias("_ord"), "h", status.alias("_gate_status"))


_STATUS = "CASE WHEN toxic = 1 THEN 'fail' WHEN quality = 0 THEN 'warn' WHEN quality = 1 THEN 'pass' END"
_BUCKET = f"CASE coalesce({_STATUS}, 'pass') WHEN 'pass' THEN 'trusted' WHEN 'fail' THEN 'quarantine' ELSE 'review' END"


@register(f"SELECT {_BUCKET} AS bucket, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def triage_buckets(spark, d):
    return route.triage(_labelled(spark, d)).groupBy("bucket").agg(F.count("*").alias("n"))


@register(f"""SELECT count(*) AS input, count(*) FILTER (b = 'trusted') AS trusted, count(*) FILTER (b = 'review') AS review,
    count(*) FILTER (b = 'quarantine') AS quarantine, count(*) AS output FROM (SELECT {_BUCKET} AS b FROM documents LEFT JOIN labels USING (doc_id))""")
def triage_stats(spark, d):
    return route.triage_stats(route.triage(_labelled(spark, d)))


@register("""SELECT CASE coalesce(lang, 'pass') WHEN 'pass' THEN 'trusted' WHEN 'warn' THEN 'review' WHEN 'fail' THEN 'quarantine' ELSE 'review' END AS bucket,
    count(*) AS n FROM documents GROUP BY 1""")
def triage_unknown_to_review(spark, d):
    return route.triage(table(spark, d, "documents").withColumn("_gate_result", F.col("lang"))).groupBy("bucket").agg(F.count("*").alias("n"))


@register(f"SELECT CASE WHEN {_STATUS} = 'fail' THEN 'quarantine' ELSE 'trusted' END AS bucket, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def split_accepting_warnings(spark, d):
    return route.split_accepting_warnings(_labelled(spark, d)).groupBy("bucket").agg(F.count("*").alias("n"))


@register(f"""
    WITH r AS (SELECT doc_id::VARCHAR AS paper_id, {_BUCKET} AS bucket, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents LEFT JOIN labels USING (doc_id)),
         kept AS (SELECT * FROM r WHERE rn = 1), out AS (SELECT paper_id FROM kept UNION ALL SELECT paper_id FROM r WHERE rn > 1)
    SELECT (SELECT count(*) FROM (SELECT paper_id FROM r EXCEPT SELECT paper_id FROM out)) + (SELECT count(*) FROM (SELECT paper_id FROM out EXCEPT SELECT paper_id FROM r)) = 0 AS reconciled,
        (SELECT count(*) FROM r) AS input, (SELECT count(*) FROM kept WHERE bucket = 'trusted') AS trusted, (SELECT count(*) FROM kept WHERE bucket = 'review') AS review,
        (SELECT count(*) FROM kept WHERE bucket = 'quarantine') AS quarantine, (SELECT count(*) FROM r WHERE rn > 1) AS deduped,
        (SELECT count(DISTINCT paper_id) FROM out) AS output, '' AS missing, '' AS extra, (SELECT count(*) FROM r) = (SELECT count(*) FROM out) AS rows_reconciled""")
def reconcile(spark, d):
    rows = _labelled(spark, d)
    marked = dedup.mark_duplicates(rows, F.col("h"))
    routed = route.triage(dedup.unique_rows(marked))
    out = route.reconcile(rows, routed, dedup.removed_rows(marked))
    return out.withColumn("missing", F.array_join("missing", ",")).withColumn("extra", F.array_join("extra", ","))


@register("""SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'extra' END AS side, count(*) AS n
    FROM (SELECT doc_id FROM documents) d FULL JOIN (SELECT doc_id + 7 AS doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL GROUP BY 1""")
def id_differences(spark, d):
    after = table(spark, d, "labels").select((F.col("doc_id") + 7).alias("paper_id"))
    return route.id_differences(table(spark, d, "documents").select(F.col("doc_id").alias("paper_id")), after).groupBy("side").agg(F.count("*").alias("n"))


def _gate_input(spark: SparkSession, d: str) -> DataFrame:
    """customers as records whose values fall inside and outside the gate's bounds."""
    c = table(spark, d, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.when(key % 50 == 0, "  ").otherwise(F.concat(F.lit("C"), key.cast("string"))).alias("paper_id"), key.alias("_ord"),
        F.when(F.col("c_mktsegment") == "BUILDING", "mineral_deposit").when(F.col("c_mktsegment") == "MACHINERY", F.lit(None)).otherwise(F.lower("c_mktsegment")).alias("deposit_class"),
        F.when(key % 11 == 0, "abc").otherwise((F.col("c_nationkey") * 5).cast("string")).alias("coord_lat"),
        F.when(key % 13 == 0, "200").otherwise("10").alias("coord_lon"),
        F.when(key % 4 == 0, "SKARN").alias("deposit_type"), F.round(F.col("c_nationkey") / 20, 2).alias("deposit_type_conf"),
        F.when(key % 8 == 0, F.lit("null")).otherwise("belt").alias("metallogenic_belt"),
    )


_GATE = """
    WITH g AS (
        SELECT c_custkey, c_custkey % 50 = 0 AS blank,
            CASE WHEN c_mktsegment = 'BUILDING' THEN 'mineral_deposit' WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE lower(c_mktsegment) END AS class,
            CASE WHEN c_custkey % 11 = 0 THEN 'abc' ELSE (c_nationkey * 5)::VARCHAR END AS lat, CASE WHEN c_custkey % 13 = 0 THEN '200' ELSE '10' END AS lon,
            CASE WHEN c_custkey % 4 = 0 THEN 'SKARN' END AS type, round(c_nationkey / 20.0, 2) AS conf, c_custkey % 8 = 0 AS empty
        FROM customer
    ), f AS (
        SELECT c_custkey, CASE WHEN blank THEN ['FAIL:no_paper_id'] ELSE list_filter([
            CASE WHEN class NOT IN ('mineral_deposit','structural_tectonic','geochemical_petrology','methodological','energy','none') THEN 'WARN:unknown_deposit_class=' || class END,
            CASE WHEN try_cast(lat AS DOUBLE) IS NULL THEN 'FAIL:lat_not_numeric=' || lat WHEN NOT try_cast(lat AS DOUBLE) BETWEEN -90 AND 90 THEN 'FAIL:lat_out_of_range=' || try_cast(lat AS DOUBLE) END,
            CASE WHEN NOT try_cast(lon AS DOUBLE) BETWEEN -180 AND 180 THEN 'FAIL:lon_out_of_range=' || try_cast(lon AS DOUBLE) END,
            CASE WHEN NOT conf BETWEEN 0 AND 1 THEN 'WARN:conf_out_of_range=' || conf WHEN conf < 0.5 AND type IS NOT NULL THEN 'FLAG:low_confidence' END,
            CASE WHEN type IS NOT NULL AND empty THEN 'FLAG:deposit_type_but_no_details' END], lambda x: x IS NOT NULL) END AS flags
        FROM g
    ), s AS (SELECT *, CASE WHEN len(list_filter(flags, lambda x: starts_with(x, 'FAIL:'))) > 0 THEN 'fail' WHEN len(flags) > 0 THEN 'warn' ELSE 'pass' END AS status FROM f)"""


@register(f"{_GATE} SELECT c_custkey AS row, array_to_string(flags, '|') AS flags, status FROM s")
def gate_rules(spark, d):
    g = gate.gate(_gate_input(spark, d), dedup=False)
    return g.select(F.col("_ord").alias("row"), F.array_join("_gate_flags", "|").alias("flags"), F.col("_gate_status").alias("status"))


@register(f"{_GATE} SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM s) GROUP BY flag")
def gate_flag_histogram(spark, d):
    return gate.flag_histogram(gate.gate(_gate_input(spark, d), dedup=False))


@register(f"{_GATE} SELECT count(*) AS total, count(*) FILTER (status = 'pass') AS passed, count(*) FILTER (status = 'warn') AS warned, count(*) FILTER (status = 'fail') AS failed, round(count(*) FILTER (status = 'pass') / count(*), 4) AS pass_rate FROM s")
def gate_pass_rate(spark, d):
    return gate.gate_report(gate.gate(_gate_input(spark, d), dedup=False))


@register("""SELECT c_custkey, try_cast(substr(c_name, 10) AS DOUBLE) AS number, substr(c_name, 1, 3) IS NOT NULL AND try_cast(substr(c_name, 1, 3) AS DOUBLE) IS NULL AS failed FROM customer""")
def safe_cast_flags(spark, d):
    return table(spark, d, "customer").select("c_custkey", ft.number(F.substring("c_name", 10, 100)).alias("number"), ft.not_number(F.substring("c_name", 1, 3)).alias("failed"))


@register("""SELECT f.field, f.filled::BIGINT AS filled, f.total, round(f.filled / f.total, 4) AS rate FROM (
    SELECT unnest(['text', 'source', 'quality', 'toxic']) AS field, unnest([count(*) FILTER (text <> ''), count(*) FILTER (source <> ''), count(*) FILTER (quality <> 0), count(*) FILTER (toxic <> 0)]) AS filled, count(*) AS total
    FROM documents LEFT JOIN labels USING (doc_id)) f""")
def fill_rates(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return monitor.fill_rates(rows, ["text", "source", "quality", "toxic"]).withColumn("rate", F.round("rate", 4))


@register("""SELECT count(*) AS total, count(*) FILTER (value < 0) AS errors, count(*) FILTER (value > 150) AS warnings,
    CASE WHEN count(*) FILTER (value < 0) > 0 THEN 'STOP' WHEN count(*) FILTER (value > 150) > count(*) * 0.2 THEN 'CAUTION' ELSE 'CONTINUE' END AS decision, event_type FROM events GROUP BY event_type""")
def monitor_decision(spark, d):
    e, w = F.count_if(F.col("value") < 0), F.count_if(F.col("value") > 150)
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("total"), e.alias("errors"), w.alias("warnings"), monitor.decide(e, w, F.count("*")).alias("decision"))


@register("SELECT event_type, count(*) FILTER (value IS NOT NULL AND NOT value BETWEEN 10 AND 90) AS outside, count(*) FILTER (value BETWEEN 10 AND 90) AS inside FROM events GROUP BY event_type")
def validity_range(spark, d):
    bad = gate.out_of_range(F.col("value"), (10.0, 90.0))
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(bad).alias("outside"), F.count_if(F.col("value").between(10, 90)).alias("inside"))


@register("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def prefix_drop_projection(spark, d):
    return records.drop_prefixed(records.drop_prefixed(table(spark, d, "lineitem"), "l_ship"), "l_return").drop("l_linestatus")


@register("""SELECT doc_id, md5(substr(CASE WHEN strpos(text, ' the ') > 1 THEN substr(text, 1, strpos(text, ' the ') - 1) WHEN strpos(text, ' der ') > 1 THEN substr(text, 1, strpos(text, ' der ') - 1) ELSE text END, 1, 1500)) AS listed,
    md5(substr(substr(text, 1, (least(CASE WHEN strpos(text, ' the ') > 1 THEN strpos(text, ' the ') ELSE 1000000000 END, CASE WHEN strpos(text, ' der ') > 1 THEN strpos(text, ' der ') ELSE 1000000000 END) - 1)), 1, 1500)) AS earliest FROM documents""")
def head_truncate(spark, d):
    marks = (" the ", " der ")
    return table(spark, d, "documents").select("doc_id", F.md5(ft.head(ft.cut_at_first_listed("text", marks), 1500)).alias("listed"), F.md5(ft.head(ft.cut_at_earliest("text", marks), 1500)).alias("earliest"))


@register("SELECT doc_id, md5(lower(translate(text, '–—‒', '---'))) AS folded, md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS squeezed FROM documents")
def text_normalise(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(ft.fold_dashes("text")).alias("folded"), F.md5(ft.squeeze("text")).alias("squeezed"))


@register("""SELECT page_id, substr(regexp_replace(CASE WHEN upper(split_part(s, '.', 1)) IN ('CON', 'PRN', 'AUX', 'NUL') THEN 'file_' || s ELSE s END, '[^A-Za-z0-9_\\-. ]', '_', 'g'), 1, 200) AS name
    FROM (SELECT page_id, replace(replace(replace(url, '../', ''), '/', '_'), '\\', '_') AS s FROM pages)""")
def sanitize_path(spark, d):
    return table(spark, d, "pages").select("page_id", ft.safe_name("url").alias("name"))


@register("""SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '[\\s\\-_/\\.\\(\\),;:]+'), lambda w: length(w) >= 5 AND w NOT IN ('these', 'there', 'under')))::BIGINT AS n FROM documents""")
def tokenise_filter(spark, d):
    from ..operators.lookup import long_words

    return table(spark, d, "documents").select("doc_id", F.size(long_words(F.lower("text"), 5, ["these", "there", "under"])).cast("long").alias("n"))


@register("""WITH w AS (SELECT item_id, regexp_split_to_array(lower(text), '[\\s\\-_/\\.\\(\\),;:]+') AS t FROM benchmark),
    g AS (SELECT unnest(list_transform(range(1, len(t) + 1), lambda i: array_to_string(t[i:i], ' '))) AS gram FROM w
          UNION ALL SELECT unnest(list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i + 1], ' '))) FROM w
          UNION ALL SELECT unnest(list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' '))) FROM w)
    SELECT gram, count(*) AS n FROM g GROUP BY gram""")
def ngram_index(spark, d):
    grams = table(spark, d, "benchmark").select(F.explode(fc.ngrams(ft.split_words(F.lower("text")))).alias("gram"))
    return grams.groupBy("gram").agg(F.count("*").alias("n"))


@register("""SELECT doc_id, array_to_string(t[1:3], ', ') AS first, coalesce(t[2], 'none') AS second, t[len(t)] AS last, len(t)::BIGINT AS n,
    len(list_filter(t, lambda x: contains(lower(x), 'ing')))::BIGINT AS ing, len(list_filter(t, lambda x: contains(x, '%'))) > 0 AS any_mark, len(list_filter(t, lambda x: length(x) < 1)) = 0 AS all_full
    FROM (SELECT doc_id, regexp_split_to_array(text, ' ') AS t FROM documents)""")
def array_ops(spark, d):
    t = F.split("text", " ")
    return table(spark, d, "documents").select(
        "doc_id", fc.join_first(t, 3).alias("first"), fc.item(t, 2, "none").alias("second"), fc.item(t, -1).alias("last"), F.size(t).cast("long").alias("n"),
        F.size(fc.with_any(t, ["ing"])).cast("long").alias("ing"), F.exists(t, lambda x: F.contains(x, F.lit("%"))).alias("any_mark"), F.forall(t, lambda x: F.length(x) >= 1).alias("all_full"),
    )


@register("SELECT vec_id, round(list_min(embedding)::DOUBLE, 4) AS low, round(list_max(embedding)::DOUBLE, 4) AS high FROM embeddings")
def array_span(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(F.array_min("embedding").cast("double"), 4).alias("low"), F.round(F.array_max("embedding").cast("double"), 4).alias("high"))


@register("SELECT event_id, CASE WHEN event_id % 5 > 0 THEN (props ->> '$.k')::BIGINT END AS k FROM events WHERE event_id % 5 = 0 OR (props ->> '$.k')::BIGINT >= 50")
def json_extract_filter(spark, d):
    """Objects in the midst of prose, every fifth of them cut off."""
    said = F.concat(F.lit("Here it is: "), F.when(F.col("event_id") % 5 == 0, F.translate("props", "}", "")).otherwise(F.col("props")), F.lit(" (end)"))
    return table(spark, d, "events").select("event_id", fc.parse_loose(said, "k long")["k"].alias("k")).where("k >= 50 OR k IS NULL")


@register("SELECT event_type, count(*) FILTER ((props ->> '$.k')::DOUBLE > 90) AS above, count(*) FILTER ((props ->> '$.k')::DOUBLE < 5) AS below FROM events GROUP BY event_type")
def map_value_checks(spark, d):
    values = F.map_values(F.from_json("props", "map<string,double>"))
    rows = table(spark, d, "events").withColumns({"hi": F.exists(values, lambda v: v > 90), "lo": F.exists(values, lambda v: v < 5)})
    return rows.groupBy("event_type").agg(F.count_if("hi").alias("above"), F.count_if("lo").alias("below"))


@register("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(url, '([^/\\\\]*)$', 1) AS base, md5(regexp_replace(html, '<script>[^<]*</script>', '<!-- SCRIPT -->', 'g')) AS wrapped FROM pages")
def html_blocks(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), ft.base_name("url").alias("base"), F.md5(F.regexp_replace("html", "<script>[^<]*</script>", "<!-- SCRIPT -->")).alias("wrapped"))


@register("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 500)::BIGINT AS batch FROM orders")
def batch_ids(spark, d):
    from ..sources.readers import batch_of

    rows = records.with_ordinal(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return rows.select("o_orderkey", batch_of().cast("long").alias("batch"))


@register("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def hist_top20(spark, d):
    return reports.histogram(table(spark, d, "orders"), "o_orderpriority", 20)


@register("""SELECT count(*) AS api_calls, sum(user_id)::BIGINT AS prompt_tokens, sum(event_id)::BIGINT AS completion_tokens, (sum(user_id) + sum(event_id))::BIGINT AS total_tokens,
    round((sum(user_id) * 0.14 + sum(event_id) * 0.28) / 1000000, 4) AS cost, round((sum(user_id) * 0.14 + sum(event_id) * 0.28) / 1000000 / count(*), 4) AS cost_per_record,
    round((sum(user_id) * 0.14 + sum(event_id) * 0.28) / 1000000 / count(*) * 1244, 4) AS projected_cost FROM events""")
def usage_totals(spark, d):
    out = reports.usage(table(spark, d, "events"), "user_id", "event_id", 1244)
    return out.withColumns({c: F.round(c, 4) for c in ("cost", "cost_per_record", "projected_cost")})


@register("SELECT doc_id, text <> '' AS text_given, coalesce(quality <> 0, false) AS quality_given, coalesce(label, 'none') AS label FROM (SELECT doc_id, text, quality, CASE WHEN toxic = 1 THEN 'toxic' END AS label FROM documents LEFT JOIN labels USING (doc_id))")
def truthiness(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", fc.truthy_field(rows, "text").alias("text_given"), fc.truthy_field(rows, "quality").alias("quality_given"), F.coalesce(F.when(F.col("toxic") == 1, "toxic"), F.lit("none")).alias("label"))


@register("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, grouping(l_returnflag, l_linestatus)::INT AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def star_rollup(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.grouping_id().cast("int").alias("level"))


@register("SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def daily_windows(spark, d):
    return table(spark, d, "events").groupBy("event_type", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select("event_type", F.col("w.start").alias("day"), "n", "total")


@register("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def events_stream_dedupe(spark, d):
    """The batch twin of the stream that drops repeats: the first event of each user and type."""
    return dedup.first_by_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])
