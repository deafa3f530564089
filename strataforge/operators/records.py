"""The record schema, its flat and legacy views, and the ordinal that order-dependent operators use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STRINGS = "array<string>"
COORDINATES = "struct<latitude:double,longitude:double,precision:string,source:string,confidence:double,extraction_method:string,matched_token:string>"
FIELDS = {
    "paper_id": "string",
    "deposit_type": "string",
    "deposit_type_conf": "double",
    "deposit_type_alternative": "struct<type:string,relation:string,evidence:string>",
    "deposit_type_evidence": "string",
    "deposit_type_null_reason": "string",
    "deposit_class": "string",
    "is_primary_research": "boolean",
    "is_primary_research_reason": "string",
    "countries": _STRINGS,
    "metallogenic_belt": "string",
    "tectonic_setting": "string",
    "coordinates": COORDINATES,
    "minerals": f"struct<ore_minerals:{_STRINGS},gangue_minerals:{_STRINGS},alteration_minerals:{_STRINGS}>",
    "alteration": _STRINGS,
    "commodities": f"struct<primary:{_STRINGS},byproduct:{_STRINGS},trace:{_STRINGS}>",
    "host_rocks": _STRINGS,
    "structural_controls": _STRINGS,
    "deposit_scale": "struct<tonnage:struct<value:double,unit:string,resource_type:string>,grade:map<string,double>,scale_class:string,production_status:string,citation:string>",
    "ages": "array<struct<age_ma:double,uncertainty:double,method:string,material:string,interpretation:string,citation:string>>",
    "geochemistry": f"struct<trace_elements:struct<enriched:{_STRINGS},depleted:{_STRINGS}>,isotopes:map<string,string>,fluid_inclusion:map<string,string>,citation:string>",
    "reference_deposits": "array<struct<name:string,relation:string,similarity:string>>",
    "mineral_system": "struct<" + ",".join(f"{n}:struct<score:int,evidence:string>" for n in ("source", "transport", "trap", "reservoir", "seal", "timing", "preservation")) + ">",
}
RECORD_SCHEMA = ", ".join(f"{n} {t}" for n, t in FIELDS.items())
ENVELOPE_SCHEMA = f"paper_id string, extracted struct<{','.join(f'{n}:{t}' for n, t in FIELDS.items())}>, tokens struct<input:bigint,output:bigint>"


def with_ordinal(df: DataFrame, *order: str) -> DataFrame:
    """df with _ord, its rows numbered from 0 in the given order, without bringing all rows into one task.

    Rows are range-partitioned; a partition's first number is the count of rows before it (one row a partition).
    """
    from pyspark.sql.window import Window as W

    # a stated number of partitions, which adaptive execution leaves alone: both uses below must see the same ones
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())
    counts = keyed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return keyed.join(F.broadcast(starts.select("_part", "_first", "_before")), "_part").withColumn("_ord", F.col("_before") + F.col("_seq") - F.col("_first")).drop("_part", "_seq", "_first", "_before")


def unwrap(df: DataFrame) -> DataFrame:
    """Records out of their envelope `extracted` where it is given; other columns stay as they are."""
    if "extracted" not in df.columns:
        return df
    inner = {f.name: f.dataType for f in df.schema["extracted"].dataType.fields}
    outer = [c for c in df.columns if c not in inner and c not in ("extracted", "tokens")]
    fields = [F.when(F.col("extracted").isNotNull(), F.col(f"extracted.{n}")).otherwise(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in inner.items() if n != "paper_id"]
    ids = F.coalesce(*[F.col(c) for c in (["extracted.paper_id"] if "paper_id" in inner else []) + (["paper_id"] if "paper_id" in df.columns else [])]).alias("paper_id")
    return df.select(ids, *fields, *[c for c in outer if c != "paper_id"])


def with_legacy(df: DataFrame) -> DataFrame:
    """df with the older flat columns derived where they are absent: coord_lat, coord_lon, ages_ma, minerals_mentioned, and commodities as a list."""
    out, kinds = df, dict(df.dtypes)
    none = F.array().cast("array<string>")
    if "coordinates" in kinds:
        out = out.withColumns({n: F.col(f"coordinates.{p}").cast("string") for n, p in (("coord_lat", "latitude"), ("coord_lon", "longitude")) if n not in kinds})
    if "ages" in kinds and "ages_ma" not in kinds:
        out = out.withColumn("ages_ma", F.transform("ages", lambda a: a["age_ma"]))
    if "minerals" in kinds and "minerals_mentioned" not in kinds:
        out = out.withColumn("minerals_mentioned", F.concat(*[F.coalesce(F.col(f"minerals.{n}"), none) for n in ("ore_minerals", "gangue_minerals", "alteration_minerals")]))
    if kinds.get("commodities", "").startswith("struct"):
        out = out.withColumn("commodities", F.concat(*[F.coalesce(F.col(f"commodities.{n}"), none) for n in ("primary", "byproduct", "trace")]))
    return out


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def prune_geochemistry(df: DataFrame) -> DataFrame:
    """geochemistry as null where none of its parts holds anything."""
    g = F.col("geochemistry")
    some = F.greatest(*[F.coalesce(c, F.lit(False)) for c in (F.size(g["trace_elements"]["enriched"]) > 0, F.size(g["trace_elements"]["depleted"]) > 0, F.size(g["isotopes"]) > 0, F.size(g["fluid_inclusion"]) > 0)])
    return df.withColumn("geochemistry", F.when(some, g))


def pruned_count(before: DataFrame) -> DataFrame:
    """How many records lose an empty geochemistry."""
    after = prune_geochemistry(before.withColumn("_given", F.col("geochemistry").isNotNull()))
    return after.agg(F.count_if(F.col("_given") & F.col("geochemistry").isNull()).alias("cleaned"))


def populated(df: DataFrame, fields, least: int) -> DataFrame:
    """Rows in which at least that many of the fields are given."""
    from ..functions.collections import truthy_field

    n = sum((truthy_field(df, f).cast("int") for f in fields), F.lit(0))
    return df.where(n >= least)


def coordinate_slices(df: DataFrame) -> DataFrame:
    """df with the slice its coordinates fall into by confidence: precise, usable, coarse or none."""
    c = F.col("coordinates.confidence")
    return df.withColumn("coordinate_slice", F.when(F.col("coordinates").isNull() | c.isNull(), "none").when(c >= 0.9, "precise").when(c >= 0.7, "usable").otherwise("coarse"))


def head_of_class(df: DataFrame, value: str, n: int, field: str = "deposit_class", order: str = "_ord") -> DataFrame:
    """The first n records of a class, by order."""
    return df.where(F.col(field) == value).orderBy(order).limit(n)


def only_ids(df: DataFrame, ids: DataFrame, id_col: str = "paper_id") -> DataFrame:
    """The records whose id is among those asked for; ids without a record give nothing."""
    return df.join(ids.select(id_col).distinct(), id_col, "left_semi").select(*df.columns)


def pick_entries(dim: DataFrame, kind: str | None = None, country: str | None = None) -> DataFrame:
    """Entries of a type and of a country whose name holds the one given, case aside; what isn't given doesn't count."""
    if kind is not None:
        dim = dim.where(F.upper("type") == kind.upper())
    return dim if country is None else dim.where(F.contains(F.lower("country"), F.lit(country.lower())))
