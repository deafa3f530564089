"""Queries over the driver tables: record views, projections, validation by polygons and places, reviews, figures and question texts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import collections as fc
from ..functions import text as ft
from ..operators import enrich, figures, gate, monitor, qa, records, reports, review, score, validate
from .base import register, table

_LIST = "array<string>"


def _pick(k, values) -> F.Column:
    """The value whose turn it is by a number."""
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


@register("SELECT CASE WHEN s_suppkey % 3 > 0 THEN 'in-' || s_name ELSE s_name END AS paper_id, CASE WHEN s_suppkey % 3 > 0 THEN 'VMS' ELSE 'SKARN' END AS deposit_type, CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END AS conf, s_nationkey AS note FROM supplier")
def unwrap_envelope(spark, d):
    """Records with and without an envelope; the record's own type counts where it has none."""
    inner = F.struct(F.concat(F.lit("in-"), "s_name").alias("paper_id"), F.lit("VMS").alias("deposit_type"), F.col("s_acctbal").alias("conf"))
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("paper_id"), F.lit("SKARN").alias("deposit_type"), F.when(F.col("s_suppkey") % 3 > 0, inner).alias("extracted"), F.lit(1).alias("tokens"), F.col("s_nationkey").alias("note"))
    return records.unwrap(rows).select("paper_id", "deposit_type", "conf", "note")


@register("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN (c_nationkey * 2.0)::DOUBLE END AS lat, CASE WHEN c_custkey % 4 = 0 THEN 'gold,quartz' ELSE 'gold' END AS minerals, 'Cu,Au,Ag' AS commodities, (c_nationkey + 1)::DOUBLE AS age FROM customer""")
def legacy_view(spark, d):
    """The older flat columns, derived from the current nested ones."""
    none = F.lit(None).cast(_LIST)
    place = enrich.place(F.col("c_nationkey") * 2, F.lit(1.0), "x", F.lit("s"), F.lit(0.5), "model")
    minerals = F.struct(F.array(F.lit("gold")).alias("ore_minerals"), F.when(F.col("c_custkey") % 4 == 0, F.array(F.lit("quartz"))).alias("gangue_minerals"), none.alias("alteration_minerals"))
    metals = F.struct(F.array(F.lit("Cu"), F.lit("Au")).alias("primary"), none.alias("byproduct"), F.array(F.lit("Ag")).alias("trace"))
    ages = F.array(F.struct((F.col("c_nationkey") + 1).cast("double").alias("age_ma")))
    rows = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, place).alias("coordinates"), minerals.alias("minerals"), metals.alias("commodities"), ages.alias("ages"))
    out = records.with_legacy(rows)
    return out.select("c_custkey", F.col("coord_lat").cast("double").alias("lat"), F.array_join("minerals_mentioned", ",").alias("minerals"), F.array_join("commodities", ",").alias("commodities"), F.col("ages_ma")[0].alias("age"))


@register("""SELECT md5('- [ ] ' || source || ' | ' || CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'null' END || ' | ' || CASE doc_id % 4 WHEN 0 THEN '0.00' WHEN 1 THEN '0.25' WHEN 2 THEN '0.50' ELSE '0.75' END || ' | ' || substr(text, 1, 300)) AS line FROM documents""")
def checklist_lines(spark, d):
    """A checklist line a record, the evidence cut short."""
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(F.col("source").alias("paper_id"), F.when(k % 2 == 0, F.col("lang")).alias("deposit_type"), F.when(k % 4 > 0, (k % 4) / 4).alias("deposit_type_conf"), F.col("text").alias("deposit_type_evidence"))
    return score.check_lines(rows).select(F.md5("line").alias("line"))


@register("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'no_type' WHEN p_size / 50.0 < 0.8 THEN 'low_confidence' WHEN p_partkey % 3 = 0 THEN 'not_deposit' ELSE 'reviewed' END AS reason FROM part""")
def skip_reasons(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select("p_partkey", F.when(k % 4 > 0, F.col("p_type")).alias("deposit_type"), (F.col("p_size") / 50).alias("deposit_type_conf"), F.when(k % 3 > 0, "mineral_deposit").alias("deposit_class"))
    return rows.select("p_partkey", F.coalesce(review.skip_reason(rows), F.lit("reviewed")).alias("reason"))


@register("""SELECT c_name AS name, c_custkey::DOUBLE AS lat, coalesce(CASE WHEN c_nationkey > 3 THEN c_mktsegment END, '') AS country, 'Cu' AS commodity FROM customer
    WHERE c_custkey % 5 > 0 AND c_custkey % 3 < 2 AND c_nationkey % 4 > 0 AND c_custkey % 7 NOT IN (0, 1)""")
def survey_sites(spark, d):
    """Sites of a survey with place, commodity, producing status and a name that is neither blank nor nan."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        F.when(k % 7 == 0, " ").when(k % 7 == 1, "NaN").otherwise(F.concat(F.lit(" "), "c_name")).alias("site_name"), F.when(k % 5 > 0, k).alias("latitude"), F.lit(2.0).alias("longitude"),
        _pick(k, ("Producer", "Past Producer", "Prospect")).alias("dev_stat"), F.when(F.col("c_nationkey") % 4 > 0, "Cu").alias("commod1"), F.when(F.col("c_nationkey") > 3, F.col("c_mktsegment")).alias("country"), F.lit(None).cast("string").alias("dep_type"),
    )
    return reports.survey_rows(rows).select("name", "lat", "country", "commodity")


_KINDS = ("Location map", "Thin section", "Seismic profile", "Gravity map", "photo")


def _vision(spark, d):
    """pages as results of a vision model: every fifth a table, every seventh failed, descriptions in prose and fences."""
    k = F.col("page_id")
    told = F.concat(F.lit('Sure:\n```json\n{"figure_type": "'), _pick(k, _KINDS), F.lit('", "title_or_caption": "Figure '), k.cast("string"), F.lit(' of the district", "legend": ["fault"]}\n```'))
    return table(spark, d, "pages").select(
        F.concat(F.lit("p"), (k % 50).cast("string")).alias("paper_id"), F.concat(F.lit("images/"), k.cast("string"), F.lit(".jpg")).alias("image_path"), F.when(k % 11 == 0, "table").otherwise("image").alias("task"), F.when(k % 7 == 0, "error: late").otherwise("ok").alias("status"), told.alias("output"),
    )


@register("""SELECT category, count(*) AS n FROM (SELECT ['geo_map', 'junk', 'cross_section', 'geophys_map', 'junk'][(page_id % 5 + 1)::INT] AS category FROM pages WHERE page_id % 11 > 0 AND page_id % 7 > 0) GROUP BY 1
    UNION ALL SELECT 'table_excluded', count(*) FROM pages WHERE page_id % 11 = 0""")
def figure_categories(spark, d):
    return figures.category_counts(_vision(spark, d))


@register("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 2 ELSE 0 END AS n_body_refs, md5(CASE WHEN page_id % 2 = 0 THEN c || chr(10) || substr('(body) see ' || url || chr(10) || '(body) end', 1, 1500) ELSE c END) AS truth
    FROM (SELECT page_id, url, 'Figure ' || page_id || ' of the district' AS c FROM pages WHERE page_id % 11 > 0 AND page_id % 7 > 0) WHERE length(c) > 24 OR page_id % 2 = 0""")
def figure_truth(spark, d):
    """Figures with body lines that speak of them, and the ground truth of captions and lines; those with neither go."""
    shown = figures.classify_figures(_vision(spark, d))
    refs = table(spark, d, "pages").where("page_id % 2 = 0").select(F.col("page_id").cast("string").alias("image_id"), F.array(F.concat(F.lit("see "), "url"), F.lit("end")).alias("lines"))
    out = figures.attach_references(shown, refs).where(figures.has_caption(24))
    return out.select(F.col("image_id").cast("long").alias("page_id"), "n_body_refs", F.md5("full_groundtruth").alias("truth"))


_ASKED = ("What is the trend?", "What lies above?", "Where is it?")
_TOLD = ("NW-SE trending faults", "The upper unit overlies the lower unit.", "East of the fault")


def _asked(spark, d):
    k = F.col("page_id")
    return table(spark, d, "pages").select(k.cast("string").alias("id"), F.col("url").alias("image"), _pick(k, _ASKED).alias("question"), _pick(k, _TOLD).alias("answer"), F.lit("c").alias("caption"))


@register("SELECT n AS original, gold, silver, n + gold + silver AS total FROM (SELECT count(*) AS n, count(*) FILTER (page_id % 3 < 2) AS gold, count(*) FILTER (page_id % 3 = 0) AS silver FROM pages)")
def tier_totals(spark, d):
    return figures.tier_counts(figures.augment(_asked(spark, d), silver=True)).select("original", "gold", "silver", "total")


@register("SELECT page_id::VARCHAR AS id, CASE WHEN page_id % 4 > 0 THEN url END AS image, page_id % 4 = 0 AS blind FROM pages")
def guessable_demoted(spark, d):
    """Questions that a model answers without the image become questions of text; the others keep theirs."""
    qs = _asked(spark, d).withColumn("tier", F.lit("original"))
    guessed = table(spark, d, "pages").where("page_id % 2 = 0").select(F.col("page_id").cast("string").alias("id"), (F.col("page_id") % 4 == 0).alias("guessed"))
    kept, text = figures.demote_guessable(qs, guessed)
    return kept.select("id", "image", F.lit(False).alias("blind")).unionByName(text.select("id", F.lit(None).cast("string").alias("image"), F.col("blind_test").alias("blind")))


@register("SELECT doc_id, (contains(lower(text), 'stone') OR contains(lower(text), 'the ')) AND (contains(lower(text), 'er') OR contains(lang, 'er')) AS hit FROM documents")
def topic_records(spark, d):
    """Any of the words and any of the kinds anywhere in a record."""
    rows = table(spark, d, "documents").select("doc_id", "text", "lang")
    return rows.select("doc_id", score.on_topic(rows.select("text", "lang"), ("Stone", "the "), ("er",)).alias("hit"))


@register("SELECT s_suppkey, s_suppkey % 4 = 1 OR s_suppkey % 4 = 2 AS given FROM supplier")
def geochemistry_pruned(spark, d):
    """Geochemistry that holds nothing in any part becomes null: absent, enriched, isotopes, empty."""
    k = F.col("s_suppkey") % 4
    traces = F.struct(F.when(k == 1, F.array(F.lit("Rb"))).otherwise(F.array().cast(_LIST)).alias("enriched"), F.array().cast(_LIST).alias("depleted"))
    isotopes = F.when(k == 2, F.create_map(F.lit("d18O"), F.lit("5"))).cast("map<string,string>")
    chem = F.struct(traces.alias("trace_elements"), isotopes.alias("isotopes"), F.lit(None).cast("map<string,string>").alias("fluid_inclusion"), F.lit("p. 3").alias("citation"))
    rows = table(spark, d, "supplier").select("s_suppkey", F.when(k > 0, chem).alias("geochemistry"))
    return records.prune_geochemistry(rows).select("s_suppkey", F.col("geochemistry").isNotNull().alias("given"))


@register("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 AND s_nationkey > 0 THEN s_nationkey::DOUBLE WHEN s_suppkey % 2 = 0 THEN 50.0 END AS lat, CASE WHEN s_suppkey % 3 = 0 AND s_nationkey > 0 THEN 0.7 WHEN s_suppkey % 2 = 0 THEN 0.5 END::DOUBLE AS conf FROM supplier""")
def extracted_places(spark, d):
    """Coordinates extracted afterwards replace earlier ones; zero isn't one."""
    old = enrich.place(F.lit(50.0), F.lit(1.0), "x", F.lit("s"), F.lit(0.5), "model")
    rows = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("paper_id"), F.when(F.col("s_suppkey") % 2 == 0, old).alias("coordinates"))
    new = table(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_name").alias("paper_id"), F.col("s_nationkey").cast("double").alias("latitude"), F.lit(7.0).alias("longitude"), F.lit("y").alias("precision"), F.lit("t").alias("source"), F.lit(None).cast("double").alias("confidence"))
    return enrich.tier_extracted(rows, new).select("s_suppkey", F.col("coordinates.latitude").alias("lat"), F.col("coordinates.confidence").alias("conf"))


@register("""WITH m AS (SELECT p_partkey, p_name FROM part), k AS (SELECT p_partkey, p_name, CASE WHEN contains(lower(p_name), 'bolt') THEN 10.0 WHEN contains(lower(p_name), 'nut') THEN 20.0 WHEN p_partkey % 2 = 0 THEN p_partkey::DOUBLE END AS lat FROM m)
    SELECT p_partkey, lat::DOUBLE AS lat FROM k WHERE lat IS NOT NULL""")
def belts_expanded(spark, d):
    """Places for names that a dimension lacks: from one that it holds by containment, else geocoded ones."""
    parts = table(spark, d, "part")
    missing = parts.select(F.col("p_partkey").alias("ord"), F.concat_ws("#", "p_name", F.col("p_partkey").cast("string")).alias("name"))
    known = spark.createDataFrame([(0, "bolt", 10.0, 0.0), (1, "nut", 20.0, 0.0)], "ord int, name string, lat double, lon double")
    coded = parts.where("p_partkey % 2 = 0").select(F.concat_ws("#", "p_name", F.col("p_partkey").cast("string")).alias("name"), F.col("p_partkey").cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    return enrich.expand_belts(missing, known, coded).select(F.col("ord").alias("p_partkey"), "lat")


@register("SELECT c_name AS paper_id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'MISSING_FIELD' END AS reason FROM customer WHERE c_custkey % 3 < 2")
def null_type_reasons(spark, d):
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.col("c_name").alias("paper_id"), F.when(k % 3 == 0, "").when(k % 3 == 2, "VMS").alias("deposit_type"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("deposit_type_null_reason"))
    return score.null_reasons(rows)


def _placed(spark, d):
    """customers as records with places; every tenth has none."""
    k = F.col("c_custkey")
    place = enrich.place(F.col("c_nationkey") * 4 - 20, (k % 30) * 4, F.lit("x"), F.lit("s"), F.lit(0.5), "model")
    return table(spark, d, "customer").select(k.alias("_ord"), F.when(k % 10 > 0, place).alias("coordinates"), F.array(_pick(k, ("Eastland", "usa", "Nowhere"))).alias("countries"), F.when(k % 6 == 0, "North Belt").otherwise("").alias("metallogenic_belt"))


_RINGS = ((0, "Eastland", [(0.0, 0.0), (60.0, 0.0), (60.0, 40.0), (0.0, 40.0)]), (1, "United States", [(60.0, -30.0), (130.0, -30.0), (130.0, 40.0), (60.0, 40.0)]))
_SPOTS = "SELECT c_custkey AS k, c_nationkey * 4 - 20 AS lat, (c_custkey % 30) * 4 AS lon, ['Eastland', 'usa', 'Nowhere'][(c_custkey % 3 + 1)::INT] AS said, c_custkey % 6 = 0 AS north, c_custkey % 10 > 0 AS given FROM customer"
_INSIDE = "CASE WHEN lat >= 0 AND lat < 40 AND lon < 60 THEN 'Eastland' WHEN lat < 40 AND lon >= 60 THEN 'United States' END"


@register(f"""SELECT k AS c_custkey, (given AND land IS NOT NULL AND NOT fits)::INT AS n_errors, CASE WHEN NOT given THEN 1 ELSE (land IS NULL)::INT + (north AND lat < 0)::INT END AS n_warnings, CASE WHEN given AND fits THEN 'confirmed in ' || land WHEN given AND land IS NOT NULL THEN 'check or correct the coordinates' ELSE '' END AS told
    FROM (SELECT *, coalesce(land = said OR (land = 'United States' AND said = 'usa'), false) AS fits FROM (SELECT *, {_INSIDE} AS land FROM ({_SPOTS})))""")
def validate_polygons(spark, d):
    """Places against polygons of the claimed country, names of one country being the same."""
    ring = "ord int, country string, ring array<struct<lon:double,lat:double>>"
    out = validate.validate(_placed(spark, d), "polygons", polygons=spark.createDataFrame(list(_RINGS), ring))
    return out.select(F.col("_ord").alias("c_custkey"), F.size("validation.errors").alias("n_errors"), F.size("validation.warnings").alias("n_warnings"), F.array_join("validation.suggestions", ";").alias("told"))


@register(f"""SELECT count(*) AS total, count(*) FILTER (NOT wrong) AS valid, count(*) FILTER (wrong) AS has_errors, count(*) FILTER (NOT given OR (north AND lat < 0)) AS has_warnings
    FROM (SELECT *, given AND lat % 8 = 0 AND NOT (said = 'usa' OR said = 'Nowhere' AND lat % 16 = 0) AS wrong FROM ({_SPOTS}))""")
def validate_places(spark, d):
    """Places against a table of places that were looked up, and the counts of what that says."""
    rows = _placed(spark, d)
    spots = rows.select(F.col("coordinates.latitude").alias("lat2"), F.col("coordinates.longitude").alias("lon2"), "countries").where("lat2 % 8 = 0")
    found = spots.select("lat2", "lon2").distinct().select("lat2", "lon2", F.lit("United States of America").alias("country"))
    with_nowhere = rows.withColumn("countries", F.when((F.col("countries")[0] == "Nowhere") & (F.col("coordinates.latitude") % 16 == 0), F.array(F.lit("Nowhere"), F.lit("united states"))).otherwise(F.col("countries")))
    return validate.validation_stats(validate.validate(with_nowhere, "places", places=found))


_TEXTS = tuple(t for t in qa.TEMPLATES if isinstance(t.answer, str))
_ROCKS, _STRUCTS, _ALTERED = ("granite", "shale", "basalt", "tuff", "marble", "slate", "gneiss"), ("fault", "fold", "shear zone"), ("potassic", "phyllic", "propylitic")
_MINERALS, _METALS, _AGES = ("gold", "pyrite", "quartz", "galena", "calcite"), ("Cu", "Au", "Mo"), ("120", "95", "88")
_CODES = ("PORPHYRY-CU-MO", "VMS", "SKARN", "", "OTHER")
_SIZES = {"rocks": ("host_rocks", _ROCKS, 5), "structs": ("structural_controls", _STRUCTS, 4), "alt": ("alteration", _ALTERED, 4), "mins": ("minerals_mentioned", _MINERALS, 6), "comms": ("commodities", _METALS, 4), "ages": ("ages_ma", _AGES, 3)}


def _rich(spark, d):
    """parts as records whose lists hold from none to all of their values."""
    k = F.col("p_partkey")
    lists = [F.slice(F.array(*map(F.lit, values)), 1, (k % n).cast("int")).alias(name) for name, values, n in _SIZES.values()]
    belt = F.when(k % 3 == 0, "Belt").when(k % 3 == 1, "Great Northern Metal Belt").otherwise("")
    return table(spark, d, "part").select(F.concat("p_name", F.lit("/"), k.cast("string")).alias("paper_id"), _pick(k, _CODES).alias("deposit_type"), belt.alias("metallogenic_belt"), F.when(k % 4 > 0, _pick(k, ("arc", "rift"))).otherwise("").alias("tectonic_setting"), *lists)


_RICH = (
    f"SELECT p_name || '/' || p_partkey AS paper_id, {list(_CODES)}[(p_partkey % {len(_CODES)} + 1)::INT] AS type, CASE p_partkey % 3 WHEN 0 THEN 'Belt' WHEN 1 THEN 'Great Northern Metal Belt' ELSE '' END AS belt, "
    + "CASE WHEN p_partkey % 4 > 0 THEN ['arc', 'rift'][(p_partkey % 2 + 1)::INT] ELSE '' END AS tectonic, "
    + ", ".join(f"{list(values)}[1:(p_partkey % {n})::INT] AS {short}" for short, (_, values, n) in _SIZES.items())
    + " FROM part"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _coded(codes: dict, default: str) -> str:
    """SQL for the text of a record's type."""
    known = {**codes, **{new: codes[old] for new, old in qa.CURRENT.items() if old in codes}}
    return "CASE type " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in known.items()) + f" ELSE {default} END"


def _slot_sql(slot: str) -> str:
    """SQL for what stands between a template's braces: a field, an item [k], a part [a:b], with |default."""
    slot, _, default = slot.partition("|")
    name, _, place = slot.rstrip("]").partition("[")
    if name in ("dep", "fluid", "trap"):
        codes, rest = {"dep": (qa.LABELS, "coalesce(nullif(type, ''), 'deposit')"), "fluid": (qa.FLUIDS, "'hydrothermal fluids'"), "trap": (qa.TRAPS, "'These structures fix where ore lies and what shape it has.'")}[name]
        return _coded(codes, rest)
    if name == "an":
        return f"CASE WHEN lower({default}[1]) IN ('a', 'e', 'i', 'o', 'u') THEN 'an' ELSE 'a' END"
    if not place:
        return name if name in ("belt", "tectonic", "type") else f"array_to_string({name}, ', ')"
    if ":" in place:
        low, high = place.split(":")
        part = f"array_to_string({name}[{int(low or 0) + 1}:{high or f'len({name})'}], ', ')"
        return f"coalesce(nullif({part}, ''), {_quoted(default)})" if default else part
    k = int(place)
    return f"coalesce({name}[{k + 1 if k >= 0 else k}], {_quoted(default)})"


def _text_sql(template: str) -> str:
    pieces = re.split(r"\{([^}]*)\}", template)
    return " || ".join(_slot_sql(p) if k % 2 else _quoted(p) for k, p in enumerate(pieces) if p)


_EXTRA = {"qa_location_belt": "length(belt) >= 20", "qa_spatial_significance": "length(belt) >= 20", "qa_belt_metal_endowment": "length(belt) >= 20", "qa_structural_hierarchy": "len(structs) >= 2", "qa_alteration_zoning": "len(alt) >= 3"}


def _template_sql(t) -> str:
    given = [f"{f} <> ''" if f in ("belt", "tectonic", "type") else f"len({f}) > 0" for f in t.fields.split()]
    more = [f"len({f}) >= {n}" for f, n in t.least.items()] + ([_EXTRA[t.name]] if t.when is not None else [])
    return f"SELECT paper_id, '{t.dimension}' AS dimension, '{t.name}' AS template, {_text_sql(t.question)} AS question, {_text_sql(t.answer)} AS answer FROM r WHERE {' AND '.join(given + more)}"


_EXPANDED = f"WITH r AS ({_RICH}), q AS (" + " UNION ALL ".join(map(_template_sql, _TEXTS)) + ")"


@register(f"{_EXPANDED} SELECT 'qa_' || substr(md5(paper_id || '::' || dimension || '::' || template), 1, 12) AS id, paper_id, template, question, answer FROM q")
def template_texts(spark, d):
    """Questions and answers in full, of every template whose answer is a text, in every dimension."""
    return qa.expand(_rich(spark, d), _TEXTS, {t.dimension for t in _TEXTS}).select("id", "paper_id", "template", "question", "answer")


@register(f"{_EXPANDED} SELECT dimension, count(*) AS n FROM q GROUP BY dimension")
def questions_by_dimension(spark, d):
    return qa.dimension_counts(qa.expand(_rich(spark, d), _TEXTS, {t.dimension for t in _TEXTS}))


def _reviews(spark, d):
    k = F.col("c_custkey")
    result = F.struct((k % 4 == 1).alias("consistent"), F.lit("odd").alias("issues"), F.when(k % 4 == 2, "SKARN").when(k % 4 == 3, "unknown").alias("suggested_type"))
    return table(spark, d, "customer").select(F.col("c_name").alias("paper_id"), F.when(k % 4 > 0, result).alias("result"))


@register("SELECT count(*) FILTER (c_custkey % 4 = 1) AS p2_pass, count(*) FILTER (c_custkey % 4 = 2) AS p2_fail, count(*) FILTER (c_custkey % 4 = 3) AS p2_insufficient, count(*) FILTER (c_custkey % 4 = 0) AS p2_error, count(*) FILTER (c_custkey % 3 = 0) AS p7_inconsistent, count(*) FILTER (c_custkey % 3 > 0) AS p7_consistent FROM customer")
def review_totals(spark, d):
    abstracts = table(spark, d, "customer").select((F.col("c_custkey") % 3 > 0).alias("consistent"))
    return review.review_counts(_reviews(spark, d)).crossJoin(F.broadcast(review.abstract_counts(abstracts)))  # one row each


@register("SELECT c_name AS paper_id, 'p2_fail' AS reason FROM customer WHERE c_custkey % 4 = 2 UNION ALL SELECT c_name, 'p7_inconsistent' FROM customer WHERE c_custkey % 3 = 0")
def review_objections(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_name").alias("paper_id"), F.lit("VMS").alias("deposit_type"))
    abstracts = table(spark, d, "customer").select(F.col("c_name").alias("paper_id"), (F.col("c_custkey") % 3 > 0).alias("consistent"), F.lit("MVT").alias("abstract_type"))
    return review.flagged(review.merge_reviews(rows, _reviews(spark, d), abstracts))


@register("""SELECT doc_id, array_to_string(list_sort(list_filter([CASE WHEN regexp_matches(lower(text), 'stone|rock') THEN 'solid' END, CASE WHEN regexp_matches(lower(text), 'the|der') THEN 'article' END, CASE WHEN contains(lower(text), 'zz') THEN 'buzz' END], lambda x: x IS NOT NULL)), ',') AS groups FROM documents""")
def word_groups(spark, d):
    """Sorted names of the groups whose words occur in any item of a list."""
    groups = {"solid": ("stone", "rock"), "article": ("the", "der"), "buzz": ("zz",)}
    return table(spark, d, "documents").select("doc_id", F.array_join(fc.categories(F.split("text", " "), groups), ",").alias("groups"))


@register("""SELECT c_custkey, concat_ws(';', CASE WHEN c_nationkey * 5 > 90 THEN 'latitude out of range' END, CASE WHEN c_acctbal < 0 THEN 'negative grade cu_percent' END, CASE WHEN c_acctbal / 50 > 100 THEN 'above 100 % cu_percent' END) AS errors, (c_custkey * 100.0 > 100000)::INT AS warnings FROM customer""")
def record_checks(spark, d):
    """What is impossible or unusual in each record, by name."""
    place = enrich.place(F.col("c_nationkey") * 5, F.lit(10.0), "x", F.lit("s"), F.lit(0.5), "model")
    scale = F.struct(F.create_map(F.lit("cu_percent"), F.col("c_acctbal") / 50).alias("grade"), F.struct((F.col("c_custkey") * 100.0).alias("value")).alias("tonnage"))
    rows = table(spark, d, "customer").select("c_custkey", place.alias("coordinates"), scale.alias("deposit_scale"))
    return rows.select("c_custkey", F.array_join(monitor.record_errors(rows), ";").alias("errors"), F.size(monitor.record_warnings(rows)).alias("warnings"))


@register("SELECT p_partkey, CASE WHEN p_partkey % 9 > 0 THEN 'Read ' || p_name || ', ' || CASE WHEN lower(p_type[1]) IN ('a', 'e', 'i', 'o', 'u') THEN 'an ' ELSE 'a ' END || p_type || ' of {size}.' END AS prompt FROM part")
def prompt_texts(spark, d):
    """Prompts from a template; a null slot gives no prompt, and what a slot holds is never filled again."""
    rows = table(spark, d, "part")
    return rows.select("p_partkey", ft.fill("Read {name}, {an} {kind}.", name=F.when(F.col("p_partkey") % 9 > 0, F.col("p_name")), an=ft.article("p_type"), kind=F.concat("p_type", F.lit(" of {size}"))).alias("prompt"))


@register("SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1")
def vocabulary_contract(spark, d):
    """Counts of a column's values, given only if they are a vocabulary that holds what it must and nothing forbidden."""
    counts = reports.histogram(table(spark, d, "orders"), "o_orderstatus").withColumnRenamed("o_orderstatus", "value")
    required, forbidden = ("F", "O"), ("", "X")
    gate.check_contract([r[0] for r in counts.where(F.col("value").isin(*required, *forbidden)).collect()], required, forbidden)
    return counts
