"""Coordinate validation: range, country, belt, hemisphere and precision rules, giving errors, warnings and suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import planar_km, text_or_empty
from . import lookup
from .fixed import BELT_CIRCLES, COUNTRY_ALIASES, COUNTRY_BOXES, PROVINCE_LEVEL, SITE_LEVEL

_NONE = "array<string>"


def country_boxes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, c, *map(float, b)) for k, (c, b) in enumerate(COUNTRY_BOXES.items())], "ord int, country string, lat_lo double, lat_hi double, lon_lo double, lon_hi double")


def belt_circles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, n, *map(float, b)) for k, (n, b) in enumerate(BELT_CIRCLES.items())], "ord int, name string, lat double, lon double, radius_km double")


def same_country(a: Column, b: Column) -> Column:
    """Equal names, case aside, or both of one group of aliases."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    out = x == y
    for group in COUNTRY_ALIASES:
        out = out | (x.isin(*group) & y.isin(*group))
    return out


def _flags(*flags: Column) -> Column:
    return F.array_compact(F.array(*flags))


def _range_errors(lat: Column, lon: Column) -> list[Column]:
    return [
        F.when(~lat.between(-90, 90), F.format_string("latitude out of range: %s", lat)),
        F.when(~lon.between(-180, 180), F.format_string("longitude out of range: %s", lon)),
    ]


def _hemisphere(text: Column, lat: Column, merged: bool) -> list[Column]:
    if merged:
        south = F.contains(text, F.lit("South")) & ~F.contains(text, F.lit("South Africa")) & ~F.contains(text, F.lit("South Korea"))
        return [
            F.when(F.contains(text, F.lit("North")) & (lat < 0), F.format_string("says North, but latitude is %s", lat)),
            F.when(south & (lat > 0), F.format_string("says South, but latitude is %s", lat)),
        ]
    return [
        F.when(F.contains(text, F.lit(w)) & (lat < 0 if w.startswith("North") else lat > 0), F.format_string(f"says {w}, but latitude is %s", lat))
        for w in ("Northern", "Southern", "North", "South")
    ]


def _precision(conf: Column, precision: Column) -> list[Column]:
    return [
        F.when((precision == SITE_LEVEL) & (conf < 0.8), F.format_string("site precision at low confidence %.2f", conf)),
        F.when((precision == PROVINCE_LEVEL) & (conf > 0.9), F.format_string("province precision at high confidence %.2f", conf)),
    ]


def validate(df: DataFrame, rules: str = "boxes", polygons: DataFrame | None = None, places: DataFrame | None = None, row_id: str = "_ord") -> DataFrame:
    """df with validation(valid, errors, warnings, suggestions).

    rules: "boxes" tests claimed countries against coarse boxes and belts against circles, "polygons" each claimed country against
    polygons (ord, country, ring), "places" against a table (lat2, lon2, country) of rounded places. A country that none of the
    tables knows is neither confirmed nor refuted. Records without coordinates are valid with a warning.
    """
    spark = df.sparkSession
    lat, lon = F.col("coordinates.latitude"), F.col("coordinates.longitude")
    claimed = F.coalesce("countries", F.array().cast(_NONE))
    belt = text_or_empty("metallogenic_belt")
    conf, precision = F.coalesce("coordinates.confidence", F.lit(0.0)), text_or_empty("coordinates.precision")
    where = F.format_string("(%.2f, %.2f)", lat, lon)
    some = df.where(lat.isNotNull() & lon.isNotNull())
    country, more, good = [], [], []
    rows = df
    if rules == "boxes":
        boxes = country_boxes(spark)
        rows = rows.join(lookup.boxes_around(some, lat, lon, boxes, row_id).withColumnRenamed("countries", "_around"), row_id, "left")
        around = F.coalesce("_around", F.array().cast(_NONE))
        known = F.exists(claimed, lambda c: c.isin(*COUNTRY_BOXES))
        off = (F.size(claimed) > 0) & ~F.arrays_overlap(claimed, around)
        country.append(F.when(off & known & (F.size(around) > 0), F.concat(where, F.lit(" isn't in "), F.array_join(claimed, ", "), F.lit(", perhaps in "), F.array_join(around, ", "))))
        more.append(F.when(off & (F.size(around) == 0), F.concat(where, F.lit(" is in no known country"))))
        # only the first belt named counts
        circles = belt_circles(spark)
        hits = lookup.first_contained(some, F.lower(belt), circles, "name", row_id).withColumnRenamed("hit", "_belt")
        rows = rows.join(hits, row_id, "left")
        far = planar_km(lat, lon, F.col("_belt.lat"), F.col("_belt.lon"))
        more.append(F.when(far > F.col("_belt.radius_km"), F.format_string("%.0f km from the middle of %s, more than %.0f", far, F.col("_belt.name"), F.col("_belt.radius_km"))))
    elif rules == "polygons" and polygons is not None:
        rows = rows.join(lookup.containing_polygon(some, lat, lon, polygons, row_id).withColumnRenamed("country", "_in"), row_id, "left")
        odd = F.filter(claimed, lambda c: ~same_country(c, F.col("_in")))
        country.append(F.when(F.col("_in").isNotNull() & (F.size(odd) > 0), F.concat(where, F.lit(" isn't in "), F.array_join(odd, ", "), F.lit(" but in "), F.col("_in"))))
        more.append(F.when(F.col("_in").isNull() & (F.size(claimed) > 0), F.concat(where, F.lit(" is in no known country"))))
        good.append(F.when(F.size(odd) < F.size(claimed), F.concat(F.lit("confirmed in "), F.col("_in"))))
    elif rules == "places" and places is not None:
        rows = lookup.rounded_place(rows, lat, lon, places).withColumnRenamed("country", "_in")
        match = F.exists(claimed, lambda c: same_country(c, F.col("_in")))
        country.append(F.when(F.col("_in").isNotNull() & (F.size(claimed) > 0) & ~match, F.concat(where, F.lit(" isn't in "), F.array_join(claimed, ", "), F.lit(" but in "), F.col("_in"))))
        good.append(F.when(match, F.concat(F.lit("confirmed in "), F.col("_in"))))
    said = F.concat_ws(" ", belt, F.array_join(claimed, ", "))
    errors = _flags(*_range_errors(lat, lon), *country)
    warnings = _flags(*more, *_hemisphere(said, lat, rules == "places"), *_precision(conf, precision))
    none = F.array().cast(_NONE)
    rows = rows.withColumn("_errors", errors).withColumn("_warnings", warnings)
    advice = _flags(*good, F.when(F.size("_errors") > 0, "check or correct the coordinates"), F.when((F.size("_errors") == 0) & (F.size("_warnings") > 0), "review the coordinates") if rules == "boxes" else F.lit(None).cast("string"))

    def result(valid: Column, e: Column, w: Column, s: Column) -> Column:
        return F.struct(valid.alias("valid"), e.alias("errors"), w.alias("warnings"), s.alias("suggestions"))

    full = result(F.size("_errors") == 0, F.col("_errors"), F.col("_warnings"), advice)
    out = F.when(F.col("coordinates").isNull(), result(F.lit(True), none, F.array(F.lit("no coordinates")), none))
    out = out.when(lat.isNull() | lon.isNull(), result(F.lit(False), F.array(F.lit("latitude or longitude missing")), none, none)).otherwise(full)
    return rows.withColumn("validation", out).select(*df.columns, "validation")


def validation_stats(validated: DataFrame) -> DataFrame:
    v = F.col("validation")
    return validated.agg(F.count("*").alias("total"), F.count_if(v["valid"]).alias("valid"), F.count_if(F.size(v["errors"]) > 0).alias("has_errors"), F.count_if(F.size(v["warnings"]) > 0).alias("has_warnings"))
