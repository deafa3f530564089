"""Coordinates by prioritised tiers, and where they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_dashes, text_or_empty
from . import lookup
from .fixed import BELT_LEVEL, PROVINCE_LEVEL, SITE_LEVEL
from .records import COORDINATES

PIPELINE = "v4.1.0"
#: Which table an extraction method stands for.
BELT_METHOD, DATABASE_METHOD = "belt", "database"


def place(lat: Column, lon: Column, precision: Column | str, source: Column, confidence: Column, method: str, token: Column | None = None) -> Column:
    return F.struct(
        lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"), (F.lit(precision) if isinstance(precision, str) else precision).alias("precision"), source.alias("source"),
        confidence.cast("double").alias("confidence"), F.lit(method).alias("extraction_method"), (token if token is not None else F.lit(None).cast("string")).alias("matched_token"),
    ).cast(COORDINATES)


def add_tier(df: DataFrame, found: DataFrame, row_id: str = "_ord") -> DataFrame:
    """df with coordinates of found (row_id, place) where it has none: an existing one is never replaced."""
    return df.join(found.select(row_id, "place"), row_id, "left").withColumn("coordinates", F.coalesce("coordinates", "place")).drop("place")


def _open(df: DataFrame) -> DataFrame:
    return df.where(F.col("coordinates").isNull())


def record_text(*names: str) -> Column:
    return F.concat_ws(" ", *[text_or_empty(n) for n in names])


def tier_database(df: DataFrame, dim: DataFrame, keywords: DataFrame) -> DataFrame:
    """Names of deposits in the record's text, by phrase."""
    text = record_text("paper_id", "metallogenic_belt", "tectonic_setting", "deposit_type_evidence")
    hits = lookup.match_phrases(_open(df), text, lookup.claimed_countries("countries"), dim, keywords)
    conf = F.least(F.lit(0.95), F.col("score"))
    return add_tier(df, hits.withColumn("place", place(F.col("hit.lat"), F.col("hit.lon"), F.when(conf >= 0.85, SITE_LEVEL).otherwise(PROVINCE_LEVEL), F.concat(F.lit("Global DB-"), F.col("hit.name")), F.round(conf, 3), DATABASE_METHOD, F.col("phrase"))))


def tier_belt(df: DataFrame, belts: DataFrame, confidence: float = 0.55) -> DataFrame:
    """The first belt whose name is in the record's belt and tectonic setting."""
    hits = lookup.first_contained(_open(df), fold_dashes(record_text("metallogenic_belt", "tectonic_setting")), belts)
    return add_tier(df, hits.withColumn("place", place(F.col("hit.lat"), F.col("hit.lon"), BELT_LEVEL, F.concat(F.lit("belt-"), F.col("hit.name")), F.lit(confidence), BELT_METHOD)))


def tier_belt_either(df: DataFrame, belts: DataFrame, exact: float = 0.6, near: float = 0.5) -> DataFrame:
    """Belts by equal name, else by containment either way."""
    hits = lookup.exact_or_contained(_open(df), text_or_empty("metallogenic_belt"), belts)
    return add_tier(df, hits.withColumn("place", place(F.col("hit.lat"), F.col("hit.lon"), BELT_LEVEL, F.concat(F.lit("belt-"), F.col("hit.name")), F.when(F.col("exact"), exact).otherwise(near), BELT_METHOD)))


def tier_alias(df: DataFrame, belts: DataFrame, exact: float = 0.75, near: float = 0.65) -> DataFrame:
    """Belts by any of their aliases, the longest first; belts: (ord, name, lat, lon, country, alias array)."""
    index = belts.withColumn("key", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("alias", F.array().cast("array<string>"))))))
    hits = lookup.longest_contained(_open(df), text_or_empty("metallogenic_belt"), index, key="key")
    return add_tier(df, hits.withColumn("place", place(F.col("hit.lat"), F.col("hit.lon"), BELT_LEVEL, F.concat(F.lit("belt-"), F.col("hit.name")), F.when(F.col("exact"), exact).otherwise(near), BELT_METHOD, F.col("hit.key"))))


def tier_ratio(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Deposits whose name shares most of its length with a word of id or belt."""
    ids = F.filter(F.split(F.lower(F.translate(text_or_empty("paper_id"), "_-", "  ")), r"\s+"), lambda w: F.length(w) > 4)
    belts = F.filter(F.split(F.lower(F.translate(text_or_empty("metallogenic_belt"), ",", " ")), r"\s+"), lambda w: F.length(w) > 4)
    hits = lookup.match_ratio(_open(df), F.concat(ids, belts), lookup.claimed_countries("countries"), dim)
    return add_tier(df, hits.withColumn("place", place(F.col("hit.lat"), F.col("hit.lon"), SITE_LEVEL, F.concat(F.lit("survey-"), F.col("hit.name")), F.least(F.lit(0.9), F.col("score") + 0.3), DATABASE_METHOD)))


def tier_famous(df: DataFrame, dim: DataFrame) -> DataFrame:
    """The first well-known deposit named in id or belt whose country fits."""
    text = F.concat_ws("\n", F.lower(text_or_empty("paper_id")), F.lower(text_or_empty("metallogenic_belt")))
    hits = lookup.named_in(_open(df), text, lookup.claimed_countries("countries"), dim)
    return add_tier(df, hits.withColumn("place", place(F.col("hit.lat"), F.col("hit.lon"), SITE_LEVEL, F.concat(F.lit("famous-"), F.col("hit.name")), F.lit(0.95), DATABASE_METHOD)))


def tier_centroid(df: DataFrame, centroids: DataFrame) -> DataFrame:
    """The middle of the first claimed country that is known."""
    hits = lookup.first_of_array(_open(df), "countries", centroids, "country")
    return add_tier(df, hits.withColumn("place", place(F.col("hit.lat"), F.col("hit.lon"), "国家级", F.concat(F.lit("centroid-"), F.col("hit.country")), F.lit(0.3), "centroid")))


def tier_extracted(df: DataFrame, extracted: DataFrame, id_col: str = "paper_id") -> DataFrame:
    """Coordinates that a model extracted afterwards (id, latitude, longitude, precision, source, confidence); zero or null isn't one."""
    some = extracted.where("coalesce(latitude, 0) <> 0 AND coalesce(longitude, 0) <> 0")
    one = some.select(F.col(id_col).alias("_id"), place(F.col("latitude"), F.col("longitude"), F.col("precision"), F.col("source"), F.coalesce("confidence", F.lit(0.7)), "model").alias("_new"))
    return df.join(one, df[id_col] == one["_id"], "left").withColumn("coordinates", F.coalesce("_new", "coordinates")).drop("_id", "_new")


def expand_belts(missing: DataFrame, belts: DataFrame, geocoded: DataFrame) -> DataFrame:
    """Places for belt names (ord, name): from the dimension by containment either way, else from a table (name, lat, lon) of geocoded names.

    A place is looked up once a name, and each row of missing with that name gets it.
    """
    names = missing.select(F.col("name").alias("_name")).distinct()
    known = lookup.exact_or_contained(names, F.col("_name"), belts, row_id="_name").select("_name", F.struct("hit.lat", "hit.lon").alias("_known"))
    coded = geocoded.select(F.col("name").alias("_name"), F.struct("lat", "lon").alias("_coded")).distinct()
    places = known.join(coded, "_name", "full").select("_name", F.coalesce("_known", "_coded").alias("_at")).distinct()
    return missing.join(places, F.col("name") == F.col("_name")).select("ord", "name", "_at.lat", "_at.lon")


def coordinate_source() -> Column:
    method = F.lower(F.coalesce("coordinates.extraction_method", F.lit("")))
    return F.when(F.col("coordinates").isNull(), "none").when(F.contains(method, F.lit("belt")) | F.contains(method, F.lit("成矿带")), "belt_inferred").when(method.rlike("mrds|database"), "mrds_match").otherwise("llm_extracted")


def with_provenance(df: DataFrame) -> DataFrame:
    """df with _provenance: source of the coordinates, whether the type is verified, pipeline and tier of confidence."""
    conf = F.coalesce("deposit_type_conf", F.lit(0.0))
    own = F.coalesce("coordinates.confidence", F.lit(0.0))
    source = coordinate_source()
    tier = F.when((conf >= 0.8) & (source == "llm_extracted") & (own >= 0.8), "high").when((conf >= 0.6) | (own >= 0.6), "medium").otherwise("low")
    return df.withColumn("_provenance", F.struct(source.alias("coordinates_source"), F.lit(False).alias("deposit_type_verified"), F.lit(PIPELINE).alias("extraction_pipeline"), tier.alias("confidence_tier")))


def coverage(df: DataFrame) -> DataFrame:
    n, have = F.count("*"), F.count_if(F.col("coordinates").isNotNull())
    return df.agg(n.alias("total"), have.alias("coords_total"), F.when(n > 0, have / n).otherwise(F.lit(0.0)).alias("coords_rate"))


def postprocess(df: DataFrame, deposits: DataFrame, keywords: DataFrame, belts: DataFrame) -> DataFrame:
    """Clean, look up deposits, then belts, then note provenance."""
    from .records import prune_geochemistry

    return with_provenance(tier_belt(tier_database(prune_geochemistry(df), deposits, keywords), belts))
