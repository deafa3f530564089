"""Queries over the driver tables: lookups, enrichment, scoring, figures and templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, enrich, figures, lookup, qa, review, score, validate
from ..sources.readers import not_done, prefer_enhanced
from .base import register, table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("_ord"), "text")


def _items(spark: SparkSession, d: str) -> DataFrame:
    """benchmark items as a dimension."""
    return table(spark, d, "benchmark").select(F.col("item_id").alias("ord"), F.col("text").alias("name"))


@register("SELECT doc_id, min(item_id) AS item_id FROM documents d JOIN benchmark b ON contains(lower(translate(d.text, '–—‒', '---')), lower(translate(b.text, '–—‒', '---'))) GROUP BY doc_id")
def lookup_first_contains(spark, d):
    from ..functions.text import fold_dashes

    return lookup.first_contained(_texts(spark, d), fold_dashes("text"), _items(spark, d)).select(F.col("_ord").alias("doc_id"), F.col("hit.ord").alias("item_id"))


@register("""WITH t AS (SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS x FROM documents), b AS (SELECT item_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS k FROM benchmark)
    SELECT doc_id, item_id FROM (SELECT doc_id, item_id, row_number() OVER (PARTITION BY doc_id ORDER BY x = k DESC, length(k) DESC, item_id) AS rn FROM t JOIN b ON contains(x, k)) WHERE rn = 1""")
def lookup_longest_contains(spark, d):
    return lookup.longest_contained(_texts(spark, d), F.col("text"), _items(spark, d), key="name", either=False).select(F.col("_ord").alias("doc_id"), F.col("hit.ord").alias("item_id"))


@register("""WITH t AS (SELECT p_partkey AS id, lower(p_name) AS x FROM part WHERE p_name <> ''), e AS (SELECT t.id, min(b.id) AS ord FROM t JOIN t b ON t.x = b.x GROUP BY t.id),
    r AS (SELECT * FROM t WHERE id NOT IN (SELECT id FROM e)), c AS (SELECT r.id, min(b.id) AS ord FROM r JOIN t b ON contains(r.x, b.x) OR contains(b.x, r.x) GROUP BY r.id)
    SELECT id, ord, true AS exact FROM e UNION ALL SELECT id, ord, false FROM c""")
def lookup_exact_or_contains(spark, d):
    parts = table(spark, d, "part")
    dim = parts.select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"))
    rows = parts.select(F.col("p_partkey").alias("_ord"), "p_name")
    return lookup.exact_or_contained(rows, F.col("p_name"), dim).select(F.col("_ord").alias("id"), F.col("hit.ord").alias("ord"), "exact")


@register("""WITH t AS (SELECT doc_id, unnest(regexp_split_to_array(text, ' ')) AS w, generate_subscripts(regexp_split_to_array(text, ' '), 1) AS pos FROM documents),
    k AS (SELECT unnest(['the', 'der', 'de', 'la', 'thing', 'ung']) AS w)
    SELECT doc_id, arg_min(w, pos) AS word FROM t JOIN k USING (w) GROUP BY doc_id""")
def array_first_lookup(spark, d):
    words = spark.createDataFrame([(w,) for w in ("the", "der", "de", "la", "thing", "ung")], "word string")
    rows = _texts(spark, d).select("_ord", F.split("text", " ").alias("words"))
    return lookup.first_of_array(rows, "words", words, "word").select(F.col("_ord").alias("doc_id"), F.col("hit.word").alias("word"))


_BOXES = ((0, "low", 1, 10, 900, 20000), (1, "middle", 8, 30, 10000, 50000), (2, "high", 25, 50, 40000, 110000))


@register(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, string_agg(b.name, ',' ORDER BY b.ord) AS boxes
    FROM lineitem JOIN (VALUES {', '.join(map(str, _BOXES))}) b(ord, name, q0, q1, p0, p1) ON l_quantity BETWEEN q0 AND q1 AND l_extendedprice BETWEEN p0 AND p1 GROUP BY ALL""")
def range_join_box(spark, d):
    boxes = spark.createDataFrame([(o, n, *map(float, b)) for o, n, *b in _BOXES], "ord int, country string, lat_lo double, lat_hi double, lon_lo double, lon_hi double")
    rows = table(spark, d, "lineitem").withColumn("_ord", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    out = lookup.boxes_around(rows, F.col("l_quantity"), F.col("l_extendedprice"), boxes)
    return out.select("_ord.*", F.array_join("countries", ",").alias("boxes"))


_CIRCLES = ((0, "a", 0.0, 0.0, 800.0), (1, "b", 10.0, 20.0, 1200.0), (2, "c", 20.0, 60.0, 2000.0))


@register(f"""SELECT c_custkey, name, round(sqrt(pow((y - lat) * 111, 2) + pow((x - lon) * 111 * 0.8, 2)), 3) AS km
    FROM (SELECT c_custkey, c_nationkey::DOUBLE AS y, c_acctbal / 100 AS x FROM customer), (VALUES {', '.join(map(str, _CIRCLES))}) c(ord, name, lat, lon, radius_km)
    WHERE sqrt(pow((y - lat) * 111, 2) + pow((x - lon) * 111 * 0.8, 2)) <= radius_km""")
def radius_join(spark, d):
    circles = spark.createDataFrame(_CIRCLES, "ord int, name string, lat double, lon double, radius_km double")
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("y"), (F.col("c_acctbal") / 100).alias("x"))
    return lookup.within_radius(rows, F.col("y"), F.col("x"), circles).select("c_custkey", "name", F.round("distance_km", 3).alias("km"))


_RINGS = ((0, "square", ((0, 0), (40, 0), (40, 12), (0, 12))), (1, "notch", ((0, 12), (60, 12), (60, 24), (30, 14), (0, 24))))


def _crossings(ring) -> str:
    edges = zip(ring, (*ring[1:], ring[0]), strict=True)
    return " + ".join(f"((({ay} > y) <> ({by} > y)) AND x < ({bx} - {ax}) * (y - {ay}) / nullif({by} - {ay}, 0)::DOUBLE + {ax})::INT" for (ax, ay), (bx, by) in edges)


@register(f"""SELECT c_custkey, CASE WHEN ({_crossings(_RINGS[0][2])}) % 2 = 1 THEN 'square' ELSE 'notch' END AS shape
    FROM (SELECT c_custkey, c_nationkey + 0.5 AS y, c_acctbal / 100 AS x FROM customer)
    WHERE coalesce(({_crossings(_RINGS[0][2])}) % 2 = 1, false) OR coalesce(({_crossings(_RINGS[1][2])}) % 2 = 1, false)""")
def polygon_join(spark, d):
    rings = [(o, n, [(float(x), float(y)) for x, y in r]) for o, n, r in _RINGS]
    shapes = spark.createDataFrame(rings, "ord int, country string, ring array<struct<lon:double,lat:double>>")
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("_ord"), (F.col("c_nationkey") + 0.5).alias("y"), (F.col("c_acctbal") / 100).alias("x"))
    return lookup.containing_polygon(rows, F.col("y"), F.col("x"), shapes).select(F.col("_ord").alias("c_custkey"), F.col("country").alias("shape"))


_DEPOSITS = ((0, "bushveld complex", "south africa"), (1, "carlin trend", "usa"), (2, "olympic dam", "australia"), (3, "sudbury basin", ""))
_TRUST = ("bushveld", "carlin", "sudbury")


def _papers(spark: SparkSession, d: str) -> DataFrame:
    """parts as papers that name deposits."""
    k = F.col("p_partkey")
    text = F.when(k % 7 == 0, "geology of the bushveld complex").when(k % 7 == 1, "carlin_trend revisited").when(k % 7 == 2, "the olympic-dam ore").when(k % 7 == 3, "around sudbury").otherwise(F.col("p_name"))
    land = F.when(k % 2 == 0, F.array(F.lit("South Africa"))).when(k % 3 == 0, F.array(F.lit("Australia"))).otherwise(F.array().cast("array<string>"))
    return table(spark, d, "part").select(k.alias("_ord"), text.alias("text"), land.alias("countries"))


_PAPERS = """SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN 'geology of the bushveld complex' WHEN 1 THEN 'carlin_trend revisited' WHEN 2 THEN 'the olympic-dam ore' WHEN 3 THEN 'around sudbury' ELSE lower(p_name) END AS text,
    CASE WHEN p_partkey % 2 = 0 THEN 'south africa' WHEN p_partkey % 3 = 0 THEN 'australia' END AS land FROM part"""


@register(f"""WITH p AS ({_PAPERS}), dim AS (SELECT * FROM (VALUES {', '.join(map(str, _DEPOSITS))}) v(ord, name, country)),
    idx AS (SELECT ord, name, country, name AS phrase FROM dim UNION SELECT ord, name, country, w FROM (SELECT *, unnest(string_split(name, ' ')) AS w FROM dim) WHERE length(w) >= 5 AND w NOT IN ('complex', 'basin')),
    tok AS (SELECT id, land, list_filter(regexp_split_to_array(text, '[\\s\\-_/\\.\\(\\),;:]+'), lambda w: length(w) >= 5 AND w NOT IN ('complex', 'basin')) AS t FROM p),
    gram AS (SELECT id, land, unnest(t) AS phrase FROM tok UNION SELECT id, land, unnest(list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i + 1], ' '))) FROM tok
        UNION SELECT p.id, p.land, k.w FROM p JOIN (SELECT unnest({list(_TRUST)}) AS w) k ON contains(p.text, k.w)),
    s AS (SELECT id, name, phrase, length(phrase) / length(name) + CASE WHEN phrase = name THEN 0.3 ELSE 0 END AS score, ord FROM gram JOIN idx USING (phrase)
        WHERE CASE WHEN land IS NOT NULL THEN contains(country, land) OR contains(land, country) ELSE phrase IN {_TRUST} END)
    SELECT id, name, phrase, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, length(phrase) DESC, phrase DESC, ord) AS rn FROM s) WHERE rn = 1 AND score >= 0.5""")
def ngram_match_top1(spark, d):
    dim = spark.createDataFrame(_DEPOSITS, "ord int, name string, country string")
    trust = spark.createDataFrame([(w,) for w in _TRUST], "keyword string")
    rows = _papers(spark, d)
    out = lookup.match_phrases(rows, F.lower("text"), lookup.claimed_countries("countries"), dim, trust, least=0.5)
    return out.select(F.col("_ord").alias("id"), F.col("hit.name").alias("name"), "phrase", F.round("score", 4).alias("score"))


@register(f"""WITH p AS ({_PAPERS}), w AS (SELECT DISTINCT id, land, w FROM (SELECT id, land, unnest(string_split(replace(replace(text, '_', ' '), '-', ' '), ' ')) AS w FROM p) WHERE length(w) > 4),
    s AS (SELECT id, name, length(w) / length(name) AS score, ord FROM w JOIN (VALUES {', '.join(map(str, _DEPOSITS))}) v(ord, name, country) ON (contains(name, w) OR contains(w, name)) AND (land IS NULL OR country = '' OR contains(country, land) OR contains(land, country)))
    SELECT id, name, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, ord) AS rn FROM s) WHERE rn = 1 AND score > 0.4""")
def ratio_match_top1(spark, d):
    dim = spark.createDataFrame(_DEPOSITS, "ord int, name string, country string")
    words = F.filter(F.split(F.lower(F.translate("text", "_-", "  ")), " "), lambda w: F.length(w) > 4)
    out = lookup.match_ratio(_papers(spark, d), words, lookup.claimed_countries("countries"), dim)
    return out.select(F.col("_ord").alias("id"), F.col("hit.name").alias("name"), F.round("score", 4).alias("score"))


@register("""SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey % 5 = n_regionkey
    WHERE contains(lower(n_name), 'nation_' || (s_nationkey % 10)) OR contains('nation_' || (s_nationkey % 10), lower(n_name))""")
def country_gate_join(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    claimed = F.array(F.concat(F.lit("nation_"), (F.col("s_nationkey") % 10).cast("string")))
    return s.join(F.broadcast(n), F.col("s_nationkey") % 5 == F.col("n_regionkey")).where(lookup.country_fits(claimed, F.col("n_name"))).select("s_suppkey", "n_name")


@register("SELECT p_partkey FROM part WHERE (contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'old')) AND p_name NOT IN (SELECT p_name FROM part WHERE p_partkey <= 5)")
def semi_keyword(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"))
    words = spark.createDataFrame([("bolt",), ("old",)], "keyword string")
    return lookup.trusted_entries(parts, words, parts.where("p_partkey <= 5")).select("p_partkey")


@register("""SELECT name, CASE WHEN o IS NULL THEN b ELSE o END AS lat, row_number() OVER (ORDER BY o IS NOT NULL AND b IS NULL, ord) - 1 AS ord FROM (
    SELECT coalesce(x.name, y.name) AS name, x.lat AS b, y.lat AS o, coalesce(x.ord, y.ord) AS ord
    FROM (SELECT n_name AS name, n_nationkey AS ord, n_regionkey::DOUBLE AS lat FROM nation) x FULL JOIN (SELECT 'NATION_' || (n_nationkey + 20) AS name, n_nationkey AS ord, 99.0 AS lat FROM nation WHERE n_nationkey < 8) y ON x.name = y.name)""")
def overlay_dimension(spark, d):
    n = table(spark, d, "nation")
    base = n.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("ord"), F.col("n_regionkey").cast("double").alias("lat"))
    over = n.where("n_nationkey < 8").select(F.concat(F.lit("NATION_"), (F.col("n_nationkey") + 20).cast("string")).alias("name"), F.col("n_nationkey").alias("ord"), F.lit(99.0).alias("lat"))
    return lookup.overlay(base, over).select("name", "lat", F.col("ord").cast("long").alias("ord"))


@register("""SELECT doc_id, CASE WHEN d.n_chars > 5000 THEN 'given' WHEN b.item_id IS NOT NULL THEN 'belt' ELSE 'none' END AS tier, CASE WHEN d.n_chars > 5000 THEN 1.0 WHEN b.item_id IS NOT NULL THEN b.item_id::DOUBLE END AS latitude
    FROM documents d LEFT JOIN (SELECT doc_id, min(item_id) AS item_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text)) GROUP BY doc_id) b USING (doc_id)""")
def enrich_cascade(spark, d):
    belts = table(spark, d, "benchmark").select(F.col("item_id").alias("ord"), F.col("text").alias("name"), F.col("item_id").cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    given = enrich.place(F.lit(1.0), F.lit(1.0), "x", F.lit("given"), F.lit(0.9), "given")
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("_ord"), F.col("text").alias("metallogenic_belt"), F.lit(None).cast("string").alias("tectonic_setting"), F.when(F.col("n_chars") > 5000, given).alias("coordinates"))
    out = enrich.tier_belt(rows, belts)
    return out.select(F.col("_ord").alias("doc_id"), F.coalesce("coordinates.extraction_method", F.lit("none")).alias("tier"), F.col("coordinates.latitude").alias("latitude"))


@register("""SELECT c_custkey, CASE WHEN c_nationkey / 20.0 >= 0.8 AND coalesce(conf, 0) >= 0.8 THEN 'high' WHEN c_nationkey / 20.0 >= 0.6 OR coalesce(conf, 0) >= 0.6 THEN 'medium' ELSE 'low' END AS tier, CASE WHEN conf IS NULL THEN 'none' ELSE 'llm_extracted' END AS source
    FROM (SELECT *, CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 10) / 10.0 END AS conf FROM customer)""")
def provenance_tier(spark, d):
    place = enrich.place(F.lit(1.0), F.lit(1.0), "x", F.lit("s"), (F.col("c_custkey") % 10) / 10, "model")
    rows = table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") / 20).alias("deposit_type_conf"), F.when(F.col("c_custkey") % 3 > 0, place).alias("coordinates"))
    return enrich.with_provenance(rows).select("c_custkey", F.col("_provenance.confidence_tier").alias("tier"), F.col("_provenance.coordinates_source").alias("source"))


@register("SELECT count(*) AS total, count(conf) AS coords_total, round(count(conf) / count(*), 4) AS coords_rate FROM (SELECT CASE WHEN c_custkey % 3 > 0 THEN 1 END AS conf FROM customer)")
def coverage(spark, d):
    place = enrich.place(F.lit(1.0), F.lit(1.0), "x", F.lit("s"), F.lit(0.5), "model")
    return enrich.coverage(table(spark, d, "customer").select(F.when(F.col("c_custkey") % 3 > 0, place).alias("coordinates"))).withColumn("coords_rate", F.round("coords_rate", 4))


@register("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti_resume(spark, d):
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return not_done(table(spark, d, "orders").select("o_orderkey"), done, "o_orderkey")


@register("SELECT doc_id, coalesce('label-' || quality, source) AS path, md5(CASE WHEN quality IS NULL THEN text ELSE 'better' END) AS text FROM documents LEFT JOIN labels USING (doc_id)")
def left_prefer(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("paper_id"), F.col("source").alias("path"), "text")
    better = table(spark, d, "labels").select(F.col("doc_id").alias("paper_id"), F.concat(F.lit("label-"), F.col("quality").cast("string")).alias("path"), F.lit("better").alias("text"))
    return prefer_enhanced(rows, better).select(F.col("paper_id").alias("doc_id"), "path", F.md5("text").alias("text"))


_CODES = ("PORPHYRY-CU", "PORPHYRY CU", "SKARN-FE", "VMS", "SMS", "OTHER-X", "LS-EPITH", "EPITHERMAL-AU", "")


def _code(c) -> F.Column:
    return F.element_at(F.array(*map(F.lit, _CODES)), (c % len(_CODES) + 1).cast("int"))


@register(f"""WITH c AS (SELECT p_partkey, {list(_CODES)}[(p_partkey % {len(_CODES)} + 1)::INT] AS p, {list(_CODES)}[(p_size % {len(_CODES)} + 1)::INT] AS e FROM part),
    n AS (SELECT *, CASE p WHEN 'PORPHYRY CU' THEN 'PORPHYRY-CU' WHEN 'LS-EPITH' THEN 'EPITHERMAL-LS' ELSE p END AS pn, CASE e WHEN 'PORPHYRY CU' THEN 'PORPHYRY-CU' WHEN 'LS-EPITH' THEN 'EPITHERMAL-LS' ELSE e END AS en FROM c),
    f AS (SELECT *, CASE WHEN pn = 'SMS' THEN 'VMS' WHEN starts_with(pn, 'EPITHERMAL') THEN 'EPITHERMAL' ELSE pn END AS pf, CASE WHEN en = 'SMS' THEN 'VMS' WHEN starts_with(en, 'EPITHERMAL') THEN 'EPITHERMAL' ELSE en END AS ef FROM n)
    SELECT p_partkey, p AS predicted, e AS expected, CASE WHEN p = '' OR e = '' THEN 0.0 WHEN pn = en THEN 1.0 WHEN pf = ef THEN 0.5 ELSE 0.0 END::DOUBLE AS score FROM f""")
def family_score(spark, d):
    p, e = _code(F.col("p_partkey")), _code(F.col("p_size"))
    return table(spark, d, "part").select("p_partkey", p.alias("predicted"), e.alias("expected"), score.score_match(p, e).alias("score"))


@register("""SELECT count(*) AS n, round(avg(best), 4) AS mean_score, count(*) FILTER (best = 1) AS exact, count(*) FILTER (best = 0.5) AS family, count(*) FILTER (best = 0) AS wrong
    FROM (SELECT l_orderkey, max(CASE l_linenumber % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 ELSE 0.0 END) AS best FROM lineitem GROUP BY 1)""")
def eval_best(spark, d):
    s = F.when(F.col("l_linenumber") % 3 == 0, 1.0).when(F.col("l_linenumber") % 3 == 1, 0.5).otherwise(0.0)
    return score.evaluation(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("_ord"), s.alias("score"))).withColumn("mean_score", F.round("mean_score", 4))


@register("SELECT split_part(p_type, '-', 1) AS prefix, count(*) AS total, count(*) FILTER (p_size >= 25) AS passed FROM part GROUP BY 1")
def regression_by_prefix(spark, d):
    rows = table(spark, d, "part").select(F.col("p_type").alias("expected"), F.when(F.col("p_size") >= 25, "PASS").otherwise("FAIL").alias("status"))
    return score.pass_by_prefix(rows)


@register("""SELECT count(*) AS total, count(*) FILTER (s IN ('PASS', 'FAIL')) AS testable, count(*) FILTER (s = 'not_found') AS not_found, count(*) FILTER (s = 'PASS') AS passed, count(*) FILTER (s = 'FAIL') AS failed,
    round(count(*) FILTER (s = 'PASS') / count(*) FILTER (s IN ('PASS', 'FAIL')), 3) AS pass_rate FROM (SELECT CASE WHEN p_size < 5 THEN 'not_found' WHEN p_size >= 25 THEN 'PASS' ELSE 'FAIL' END AS s FROM part)""")
def regression_report(spark, d):
    status = F.when(F.col("p_size") < 5, "not_found").when(F.col("p_size") >= 25, "PASS").otherwise("FAIL")
    return score.regression_report(table(spark, d, "part").select(status.alias("status")))


@register("""SELECT doc_id, CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 AND quality = 0 THEN 'FLAG:p2_insufficient_abstract' WHEN toxic = 1 THEN 'FLAG:adversarial_fail:bad|FLAG:p2_suggests:SKARN' END AS flags, coalesce(toxic = 0, false) AS verified FROM documents LEFT JOIN labels USING (doc_id)""")
def review_merge(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("paper_id"), F.lit("VMS").alias("deposit_type"))
    hint = F.when(F.col("quality") == 1, "SKARN")
    reviews = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("paper_id"), F.struct((F.col("toxic") == 0).alias("consistent"), F.lit("bad").alias("issues"), hint.alias("suggested_type")).alias("result"))
    none = spark.createDataFrame([], "paper_id string, consistent boolean, abstract_type string")
    out = review.merge_reviews(rows, reviews, none)
    return out.select("doc_id", F.array_join("_gate_flags", "|").alias("flags"), F.coalesce("_provenance.deposit_type_verified", F.lit(False)).alias("verified"))


@register("""SELECT c_custkey, round(c_nationkey * 5 - 40.0, 2)::DOUBLE AS lat, CASE WHEN NOT lat BETWEEN -90 AND 90 THEN 1 ELSE 0 END + CASE WHEN lat BETWEEN 18 AND 54 AND lon BETWEEN 73 AND 135 OR NOT known THEN 0 WHEN inside THEN 1 ELSE 0 END AS n_errors
    FROM (SELECT *, EXISTS (SELECT 1 FROM (VALUES (-44,-10,113,154),(18,54,73,135),(25,49,-125,-66),(42,83,-141,-52),(-34,5,-74,-35),(41,82,19,180),(-35,-22,16,33),(-18,0,-81,-68),(-56,-17,-76,-66),(49,55,14,24),(25,40,44,64),(36,42,26,45),(14,33,-118,-86),(-55,-22,-73,-53),(41,55,47,87),(42,52,88,120),(8,35,68,97),(22,32,25,37),(16,32,34,56),(60,70,20,32),(55,69,11,24),(58,71,4,31),(60,84,-73,-12),(-3,-1,29,31),(-13,5,12,31)) b(a0,a1,o0,o1) WHERE lat BETWEEN a0 AND a1 AND lon BETWEEN o0 AND o1) AS inside
        FROM (SELECT c_custkey, c_nationkey, c_nationkey * 5 - 40.0 AS lat, (c_custkey % 36) * 10 - 175.0 AS lon, true AS known FROM customer))""")
def validate_boxes(spark, d):
    lat, lon = F.col("c_nationkey") * 5 - 40.0, (F.col("c_custkey") % 36) * 10 - 175.0
    place = enrich.place(lat, lon, "x", F.lit("s"), F.lit(0.5), "model")
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("_ord"), place.alias("coordinates"), F.array(F.lit("China")).alias("countries"), F.lit("").alias("metallogenic_belt"))
    out = validate.validate(rows)
    return out.select(F.col("_ord").alias("c_custkey"), F.round("coordinates.latitude", 2).alias("lat"), F.size("validation.errors").alias("n_errors"))


@register("""WITH r AS (SELECT s_suppkey, s_name, p_name, p_type FROM supplier JOIN part ON s_suppkey = p_partkey)
    SELECT 'qa_' || substr(md5(s_name || '::' || dim || '::' || t), 1, 12) AS id, s_name AS paper_id, t AS template FROM (
        SELECT s_name, 'structural_control' AS dim, 'qa_structural_spatial' AS t FROM r
        UNION ALL SELECT s_name, 'structural_control', 'qa_structural_regional_context' FROM r
        UNION ALL SELECT s_name, 'structural_control', 'qa_structural_hierarchy' FROM r
        UNION ALL SELECT s_name, 'spatial_location', 'qa_location_belt' FROM r WHERE length(s_name || ' ' || p_name) >= 20
        UNION ALL SELECT s_name, 'spatial_location', 'qa_spatial_significance' FROM r WHERE length(s_name || ' ' || p_name) >= 20)""")
def template_expand(spark, d):
    rows = table(spark, d, "supplier").join(table(spark, d, "part"), F.col("s_suppkey") == F.col("p_partkey"))
    none = F.array().cast("array<string>")
    rows = rows.select(F.col("s_name").alias("paper_id"), F.col("p_type").alias("deposit_type"), F.concat_ws(" ", "s_name", "p_name").alias("metallogenic_belt"), F.lit("").alias("tectonic_setting"), F.array(F.lit("fault"), F.lit("fold")).alias("structural_controls"), *[none.alias(c) for c in ("host_rocks", "alteration", "minerals_mentioned", "commodities", "ages_ma")])
    return qa.expand(rows).select("id", "paper_id", "template")


def _questions(spark: SparkSession) -> DataFrame:
    rows = [("1", "a.jpg", "What is the trend?", "NW-SE trending faults", "c"), ("2", "b.jpg", "What lies above?", "The upper unit overlies the lower-cretaceous unit.", "c"), ("3", "c.jpg", "What is trending?", "N-S", "c"), ("4", "d.jpg", "Where is it?", "East of the fault", "c")]
    return spark.createDataFrame(rows, "id string, image string, question string, answer string, caption string")


@register("""SELECT * FROM (VALUES ('1', 'gold', 'What is the strike direction?', 'SE-NW trending faults'), ('2', 'gold', 'What underlies the The Upper Unit?', 'The The Lower-Cretaceous Unit underlies the The Upper Unit.'),
    ('3', 'gold', 'What is trending?', 'S-N'), ('1', 'silver', 'Which geological features lie along the NW-SE direction?', 'Faults lie along the NW-SE direction.'), ('3', 'silver', 'Which geological features lie along the N-S direction?', 'Features lie along the N-S direction.'))
    v(original_id, tier, question, answer)""")
def gold_silver(spark, d):
    return figures.augment(_questions(spark), silver=True).where("tier <> 'original'").select("original_id", "tier", "question", "answer")


@register("""SELECT page_id, CASE WHEN regexp_matches(lower(t), 'table|icon|diagram|logo') THEN 'junk' WHEN regexp_matches(lower(t || ' ' || u), 'location map|regional map') THEN 'geo_map' WHEN regexp_matches(lower(t || ' ' || u), 'profile|cross section|cross-section') THEN 'cross_section' WHEN regexp_matches(lower(t || ' ' || u), 'gravity map') THEN 'geophys_map' ELSE 'junk' END AS category
    FROM (SELECT page_id, ['Location map', 'table', 'Seismic profile', 'Gravity map', 'photo'][(page_id % 5 + 1)::INT] AS t, CASE WHEN page_id % 3 = 0 THEN 'with a cross section' ELSE '' END AS u FROM pages)""")
def figure_classify(spark, d):
    k = F.col("page_id")
    kind = F.element_at(F.array(*map(F.lit, ("Location map", "table", "Seismic profile", "Gravity map", "photo"))), (k % 5 + 1).cast("int"))
    caption = F.when(k % 3 == 0, "with a cross section").otherwise("")
    return table(spark, d, "pages").select("page_id", figures.figure_class(kind, caption).alias("category"))


@register("""SELECT doc_id, replace('a ![](images/x.jpg) b ![c](images/y.jpg)', '![](images/x.jpg)', CASE WHEN doc_id % 2 = 0 THEN '<!-- FIGURE: x.jpg -->' || chr(10) || source || chr(10) || '<!-- /FIGURE -->' ELSE '![](images/x.jpg)' END) AS text FROM documents""")
def inject_descriptions(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), "doc_id", "source")
    results = docs.where("doc_id % 2 = 0").select("paper_id", F.lit("x.jpg").alias("image_basename"), F.lit("image").alias("task"), F.lit("ok").alias("status"), F.concat(F.lit("```json\n"), "source", F.lit("\n```")).alias("output"), F.lit(0).alias("block_idx"))
    rows = docs.select("paper_id", "doc_id", F.lit("a ![](images/x.jpg) b ![c](images/y.jpg)").alias("text"))
    return figures.inject_descriptions(rows, results).select("doc_id", "text")


@register("SELECT doc_id, regexp_matches(lower(text), 'strike|dip|depth|zone|where|belt|region|between|border|contact|domain|extent|extend|position|location|located|spatial|direction|arrangement|distribution|boundary|relative to|east of|west of|north of|south of|relationship|adjacent|proximal|distal|corridor') AS spatial FROM documents")
def spatial_filter(spark, d):
    return table(spark, d, "documents").select("doc_id", figures.is_spatial("text").alias("spatial"))


@register("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT min(c_custkey) FROM customer GROUP BY c_nationkey, c_mktsegment)")
def keep_first(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", F.concat_ws("/", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("k"))
    return dedup.keep_first_by_id(rows, "k", "c_custkey").select("c_custkey", "c_name")
