"""Figures: classes by words, descriptions put into Markdown, questions that mean the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.collections import parse_loose
from ..functions.text import any_of, capitalized, first_of, short_id, text_or_empty, title_case, unfence, without_trailing
from .fixed import CROSS_SECTIONS, GEO_MAPS, GEOPHYSICAL_MAPS, JUNK_FIGURES, SPATIAL_WORDS, TRENDS

FIGURE_SCHEMA = "figure_type string, title_or_caption string, axes struct<x:string,y:string>, legend array<string>, key_values array<string>, trends_or_findings array<string>, text_in_figure array<string>"
PLACEHOLDER = r"!\[[^\]]*\]\(images/[^)]+\)"
BODY_CHARS = 1500


def figure_class(kind: Column | str, caption: Column | str) -> Column:
    """junk by type alone first, then maps, sections and geophysics by type or caption, else junk."""
    own = F.lower(F.trim(text_or_empty(kind)))
    both = F.concat_ws(" ", own, F.lower(text_or_empty(caption)))
    return F.when(any_of(own, JUNK_FIGURES), "junk").when(any_of(both, GEO_MAPS), "geo_map").when(any_of(both, CROSS_SECTIONS), "cross_section").when(any_of(both, GEOPHYSICAL_MAPS), "geophys_map").otherwise("junk")


def classify_figures(results: DataFrame) -> DataFrame:
    """Vision results with the figure's parsed fields and category; tables are left out, other statuses than ok too."""
    rows = results.where((F.coalesce("task", F.lit("")) != "table") & (F.col("status") == "ok")).withColumn("_f", parse_loose("output", FIGURE_SCHEMA))
    caption = F.coalesce("_f.title_or_caption", F.lit(""))
    return rows.select("paper_id", "image_path", caption.alias("caption"), F.coalesce("_f.figure_type", F.lit("")).alias("figure_type"), figure_class("_f.figure_type", caption).alias("category"), "_f.text_in_figure", "_f.legend")


def category_counts(results: DataFrame) -> DataFrame:
    """(category, n), tables counted as excluded."""
    tables = results.where("task = 'table'").agg(F.count("*").alias("n")).select(F.lit("table_excluded").alias("category"), "n")
    return classify_figures(results).groupBy("category").agg(F.count("*").alias("n")).unionByName(tables)


def attach_references(figures: DataFrame, refs: DataFrame) -> DataFrame:
    """figures with body lines (image_id, lines array) of the same image, by the file's stem, and the ground truth made of caption and lines."""
    from ..functions.text import stem

    rows = figures.withColumn("image_id", stem("image_path")).join(refs, "image_id", "left")
    n = F.size(F.coalesce("lines", F.array().cast("array<string>")))
    body = F.left(F.array_join(F.transform("lines", lambda x: F.concat(F.lit("(body) "), x)), "\n"), F.lit(BODY_CHARS))
    return rows.withColumn("n_body_refs", n).withColumn("full_groundtruth", F.when(n > 0, F.concat_ws("\n", "caption", body)).otherwise(F.col("caption")))


def has_caption(least: int = 20) -> Column:
    return (F.length("caption") > least) | (F.col("n_body_refs") > 0)


def described_images(results: DataFrame) -> DataFrame:
    """(paper_id, shown): a map from image file to the text that stands for it; of repeated images the last result counts."""
    ok = results.where("status = 'ok' AND paper_id <> '' AND image_basename <> '' AND output <> ''")
    last = ok.groupBy("paper_id", "image_basename").agg(F.max_by(F.struct("task", "output"), F.struct("block_idx", "output")).alias("r"))
    tag = F.when(F.col("r.task") == "table", "TABLE").otherwise("FIGURE")
    shown = F.concat(F.lit("<!-- "), tag, F.lit(": "), F.col("image_basename"), F.lit(" -->\n"), unfence("r.output"), F.lit("\n<!-- /"), tag, F.lit(" -->"))
    return last.select("paper_id", "image_basename", shown.alias("s")).groupBy("paper_id").agg(F.map_from_entries(F.collect_list(F.struct("image_basename", "s"))).alias("shown"))


def inject_descriptions(docs: DataFrame, results: DataFrame) -> DataFrame:
    """docs (paper_id, text) with each image placeholder replaced by its description where there is one."""
    rows = docs.join(described_images(results), "paper_id", "left")
    marks = F.regexp_extract_all("text", F.lit(f"({PLACEHOLDER})"), F.lit(1))
    gaps = F.split("text", PLACEHOLDER, -1)
    file = lambda m: F.regexp_extract(m, r"images/([^)]+)", 1)
    filled = F.transform(marks, lambda m: F.coalesce(F.try_element_at("shown", file(m)), m))
    pieces = F.zip_with(gaps, filled, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
    return rows.withColumn("text", F.when(F.col("shown").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))).drop("shown")


def is_spatial(question: Column | str) -> Column:
    return any_of(F.lower(text_or_empty(question)), SPATIAL_WORDS)


def gold_equivalents(qa: DataFrame) -> DataFrame:
    """Questions (id, image, question, answer, caption) that mean exactly the same: trends read backwards, what lies above read from below."""
    answer, low = F.col("answer"), F.lower("answer")
    trend = first_of(answer, [a for a, _ in TRENDS])
    back = F.create_map(*[F.lit(x) for p in TRENDS for x in p])
    sides = F.split(low, " overlies ")
    upper, under = title_case(F.trim(F.get(sides, F.lit(0)))), title_case(without_trailing(F.trim(F.get(sides, F.lit(1)))))

    def made(question: Column, text: Column, kind: str) -> Column:
        return F.struct(question.alias("question"), text.alias("answer"), F.lit(kind).alias("equivalence_type"))

    turned = F.when(trend.isNotNull(), made(F.regexp_replace("question", r"\btrend\b", "strike direction"), F.replace(answer, trend, back[trend]), "bidirectional_trend"))
    flipped = F.when(F.size(sides) == 2, made(F.concat(F.lit("What underlies the "), upper, F.lit("?")), F.concat(F.lit("The "), under, F.lit(" underlies the "), upper, F.lit(".")), "vertical_inverse"))
    return _equivalents(qa, F.array_compact(F.array(turned, flipped)), "gold", 1.0)


def silver_equivalents(qa: DataFrame) -> DataFrame:
    """Questions that may have other answers too: what is aligned in a direction."""
    question, answer = F.lower("question"), F.lower("answer")
    way = F.upper(first_of(answer, ("nw-se", "ne-sw", "n-s", "e-w")))
    what = F.when(F.contains(answer, F.lit("fault")), "faults").when(F.contains(answer, F.lit("deposit")), "deposits").when(F.contains(answer, F.lit("mineralization")), "mineralization").otherwise("features")
    made = F.when(
        question.rlike("trend|distribution") & way.isNotNull(),
        F.struct(F.concat(F.lit("Which geological features lie along the "), way, F.lit(" direction?")).alias("question"), F.concat(capitalized(what), F.lit(" lie along the "), way, F.lit(" direction.")).alias("answer"), F.lit("reverse_distribution").alias("equivalence_type")),
    )
    return _equivalents(qa, F.array_compact(F.array(made)), "silver", 0.75)


def _equivalents(qa: DataFrame, made: Column, tier: str, confidence: float) -> DataFrame:
    rows = qa.withColumn("_e", F.explode(made))
    out = rows.select(F.col("id").alias("original_id"), "image", "_e.question", "_e.answer", "caption", "_e.equivalence_type", F.lit(tier).alias("tier"), F.lit(confidence).alias("confidence"))
    # the original's id is part of the new one, so equal questions about different images differ
    return out.withColumn("id", F.concat(F.lit(f"{tier}_"), short_id("original_id", "question", n=10)))


def augment(qa: DataFrame, silver: bool = False) -> DataFrame:
    """Originals and their equivalents."""
    base = qa.select(F.lit(None).cast("string").alias("original_id"), "image", "question", "answer", "caption", F.lit(None).cast("string").alias("equivalence_type"), F.lit("original").alias("tier"), F.lit(1.0).alias("confidence"), "id")
    out = base.unionByName(gold_equivalents(qa))
    return out.unionByName(silver_equivalents(qa)) if silver else out


def tier_counts(augmented: DataFrame) -> DataFrame:
    return augmented.agg(*[F.count_if(F.col("tier") == t).alias(t) for t in ("original", "gold", "silver")], F.count("*").alias("total"))


def demote_guessable(augmented: DataFrame, guessed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept with image, demoted to text): questions whose answer a model got without the image, guessed (id, guessed), lose their image."""
    rows = augmented.join(guessed, "id", "left").withColumn("guessed", F.coalesce("guessed", F.lit(False)))
    return rows.where(~F.col("guessed")).drop("guessed"), rows.where("guessed").drop("guessed", "image").withColumns({"source": F.lit("blind_test"), "blind_test": F.lit(True)})
