"""Sources: JSON arrays and lines, CSV, Markdown corpora, layout blocks, dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name, stem
from ..operators.records import RECORD_SCHEMA

#: Files that a parser leaves beside a document.
SIDE_FILES = r"_(layout|middle|model|spans)"


def read_records(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """JSON arrays of records, one or more files, with _ord: file by name, then place in its array."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), "value")
    items = rows.select("_file", F.posexplode(F.from_json("value", f"array<struct<{_ddl(schema)}>>")).alias("_pos", "r"))
    from ..operators.records import with_ordinal

    return with_ordinal(items, "_file", "_pos").select("r.*", "_ord")


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _pos, raw): each record of JSON arrays as it is written, for hashing by content."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), F.col("value"))
    items = F.from_json("value", "array<variant>")
    return rows.select("_file", F.posexplode(items).alias("_pos", "v")).select("_file", "_pos", F.to_json("v").alias("raw"))


def _ddl(schema: str) -> str:
    from pyspark.sql.types import _parse_datatype_string

    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in _parse_datatype_string(schema).fields)


def read_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines; malformed ones are skipped, or raise if strict; blank ones never count."""
    if not strict:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str, schema: str, encoding: str = "ISO-8859-1") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("encoding", encoding).option("quote", '"').option("escape", '"').csv(path)


def read_markdown(spark: SparkSession, root: str, enhanced: str | None = None) -> DataFrame:
    """(paper_id, path, text) of a corpus: id from the file's stem, side files left out; an enhanced text is preferred."""
    rows = _markdown(spark, root).where(~F.col("paper_id").rlike(SIDE_FILES))
    # of equal ids in several folders the first path counts
    rows = rows.groupBy("paper_id").agg(F.min_by(F.struct("path", "text"), "path").alias("r")).select("paper_id", "r.*")
    if enhanced is None:
        return rows
    return prefer_enhanced(rows, _markdown(spark, enhanced))


def prefer_enhanced(rows: DataFrame, enhanced: DataFrame) -> DataFrame:
    """(paper_id, path, text) of rows, with path and text of enhanced where it has the paper. One row an id in both."""
    better = enhanced.select("paper_id", F.col("path").alias("_p"), F.col("text").alias("_t"))
    return rows.join(better, "paper_id", "left").select("paper_id", F.coalesce("_p", "path").alias("path"), F.coalesce("_t", "text").alias("text"))


def _markdown(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(stem(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).alias("paper_id"), path.alias("path"), F.col("value").alias("text"))


def read_blocks(spark: SparkSession, root: str, tasks=("table", "image"), present: DataFrame | None = None) -> DataFrame:
    """(uid, paper_id, block_idx, task, image_path, image_basename) of layout files *_content_list.json; present: paths that exist."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_content_list.json").text(root, wholetext=True)
    paper = F.regexp_replace(stem(F.col("_metadata.file_path")), "_content_list$", "")
    rows = files.select(paper.alias("paper_id"), F.posexplode(F.from_json("value", "array<struct<type:string,img_path:string>>")).alias("block_idx", "b"))
    rows = rows.where(F.col("b.type").isin(*tasks) & (F.coalesce("b.img_path", F.lit("")) != ""))
    rows = rows.select("paper_id", "block_idx", F.col("b.type").alias("task"), F.col("b.img_path").alias("image_path"), base_name("b.img_path").alias("image_basename"))
    if present is not None:
        rows = rows.join(present.select("image_path").distinct(), "image_path", "left_semi")
    return rows.withColumn("uid", F.concat_ws("::", "paper_id", F.col("block_idx").cast("string"), "image_basename"))


def read_dimension(spark: SparkSession, path: str, schema: str, key: str = "name") -> DataFrame:
    """A dimension from JSON lines; of equal keys the last by ord wins, at the place of the first."""
    rows = spark.read.schema(schema).json(path)
    rest = [c for c in rows.columns if c not in (key, "ord")]
    one = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "ord").alias("v"), F.min("ord").alias("ord"))
    return one.select("ord", key, *[F.col(f"v.{c}").alias(c) for c in rest])


def read_polygons(spark: SparkSession, path: str, name: str = "name", aliases: dict[str, str] | None = None) -> DataFrame:
    """(ord, country, ring) of a GeoJSON file's polygons, one row an outer ring; aliases: other names by the file's own.

    A feature's place in the file is its ord, so the parts of a country share one. Features without a name or a polygon give none.
    """
    kind = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", kind)["features"]).alias("ord", "f"))
    rings = "array<array<array<double>>>"
    one, many = F.array(F.from_json("f.geometry.coordinates", rings)), F.from_json("f.geometry.coordinates", f"array<{rings}>")
    polygons = F.when(F.col("f.geometry.type") == "Polygon", one).when(F.col("f.geometry.type") == "MultiPolygon", many)
    rows = rows.select("ord", F.try_element_at(F.col("f.properties"), F.lit(name)).alias("country"), F.explode(polygons).alias("p")).where("country <> '' AND size(p) > 0")
    ring = F.transform(F.col("p")[0], lambda q: F.struct(q[0].alias("lon"), q[1].alias("lat")))
    if aliases:
        known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        rows = rows.withColumn("country", F.coalesce(F.try_element_at(known, F.col("country")), "country"))
    return rows.select("ord", "country", ring.alias("ring"))


def read_named(spark: SparkSession, path: str, fields: str, key: str = "name") -> DataFrame:
    """A dimension from one JSON object of objects by name, as (ord, key, and the fields): ord is the name's place in the file.

    Written as JSON lines it is what read_dimension and the large place tables read.
    """
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string, struct<{fields}>>").alias("m"))
    return whole.select(F.posexplode(F.map_entries("m")).alias("ord", "e")).select("ord", F.col("e.key").alias(key), "e.value.*")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key).distinct(), key, "left_anti")


def batch_of(order: str = "_ord", size: int = 500):
    return F.floor(F.col(order) / size)
