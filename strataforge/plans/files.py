"""Queries that write the driver tables in each format and read them again, ask model clients, and run streams to their end."""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources import models, readers, sinks
from ..streaming import ingest
from .base import register, table


def _folder(spark: SparkSession) -> str:
    """A new folder where all executors can write, under spark.checkpoint.dir, or a temporary one of a local session that has none; it goes when the driver ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strataforge-")
    at = f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return at


@register("SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 3 > 0 THEN n_regionkey END AS region, (row_number() OVER (ORDER BY n_name DESC) - 1)::BIGINT AS ord FROM nation")
def json_array_round(spark, d):
    """A small table as one JSON array in order, each record's place in it kept; one array is one task's to read, so large tables are written as lines."""
    at, n = f"{_folder(spark)}/array", table(spark, d, "nation")
    rows = n.select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 3 > 0, F.col("n_regionkey")).alias("region"))
    rows = rows.join(n.select("n_nationkey", F.row_number().over(W.orderBy(F.desc("n_name"))).alias("_ord")), "n_nationkey")
    sinks.json_array(rows).coalesce(1).write.text(at)
    return readers.read_records(spark, at, "n_nationkey int, n_name string, region int").withColumnRenamed("_ord", "ord")


@register("SELECT doc_id, md5(text) AS text FROM documents WHERE doc_id % 5 > 0 AND doc_id % 2 = 0 UNION ALL SELECT doc_id, md5(text) FROM documents WHERE doc_id % 2 = 1")
def json_lines_round(spark, d):
    """Lines appended in two goes, some of them broken off: these are skipped."""
    at, docs = f"{_folder(spark)}/lines", table(spark, d, "documents").select("doc_id", "text")
    whole = F.to_json(F.struct("doc_id", "text"))
    even = docs.where("doc_id % 2 = 0").select(F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(', "text": "cut'))).otherwise(whole).alias("value"))
    even.write.text(at)
    sinks.write_lines(docs.where("doc_id % 2 = 1"), at, append=True)
    return readers.read_lines(spark, at, "doc_id bigint, text string").select("doc_id", F.md5("text").alias("text"))


@register("SELECT o_orderkey, o_custkey FROM orders")
def parquet_round(spark, d):
    at = f"{_folder(spark)}/orders"
    sinks.write_parquet(table(spark, d, "orders").select("o_orderkey", "o_custkey"), at)
    return spark.read.parquet(at)


@register("SELECT c_custkey, 'Müller, \"' || c_name || '\"' AS name FROM customer")
def latin_csv_round(spark, d):
    at = f"{_folder(spark)}/csv"
    rows = table(spark, d, "customer").select("c_custkey", F.concat(F.lit('Müller, "'), "c_name", F.lit('"')).alias("name"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").option("quote", '"').option("escape", '"').csv(at)
    return readers.read_csv(spark, at, "c_custkey bigint, name string")


@register("""SELECT page_id::VARCHAR AS paper_id, block_idx, task, page_id || '-' || block_idx || '.jpg' AS image_basename, page_id || '::' || block_idx || '::' || page_id || '-' || block_idx || '.jpg' AS uid
    FROM pages, (VALUES (0, 'image'), (2, 'table')) v(block_idx, task)""")
def layout_blocks(spark, d):
    """Blocks of layout files, a file a page; those of other kinds or without an image are left out."""
    at = f"{_folder(spark)}/pages"
    k = F.col("page_id").cast("string")

    def block(kind: str, n: int, image: bool = True):
        return F.struct(F.lit(kind).alias("type"), (F.concat(F.lit("images/"), k, F.lit(f"-{n}.jpg")) if image else F.lit("")).alias("img_path"))

    text = F.to_json(F.array(block("image", 0), block("text", 1), block("table", 2), block("image", 3, image=False)))
    _named_files(table(spark, d, "pages").select(F.concat(k, F.lit("_content_list.json")).alias("name"), text.alias("value")), at)
    return readers.read_blocks(spark, at).select("paper_id", F.col("block_idx").cast("int").alias("block_idx"), "task", "image_basename", "uid")


def _named_files(rows: DataFrame, at: str) -> None:
    """A file a row (name, value), written by the tasks that hold the rows, through the file system that the path names."""
    import pyarrow.fs

    uri = at if "://" in at else os.path.abspath(at.removeprefix("file:"))

    def write(parts):
        fs, root = pyarrow.fs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        for part in parts:
            for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                with fs.open_output_stream(f"{root}/{name}") as out:
                    out.write(value.encode())
            yield part.slice(0, 0)

    rows.mapInArrow(write, rows.schema).write.format("noop").mode("overwrite").save()


@register("""SELECT doc_id::VARCHAR AS paper_id, md5(CASE WHEN doc_id % 3 = 0 THEN 'better ' ELSE '' END || coalesce(text, '')) AS text FROM documents""")
def markdown_corpus(spark, d):
    """A corpus of a file a document, side files left out; every third has an enhanced text."""
    at = _folder(spark)
    docs, name = table(spark, d, "documents"), F.concat(F.col("doc_id").cast("string"), F.lit(".md"))
    text = F.coalesce("text", F.lit(""))
    _named_files(docs.select(name.alias("name"), text.alias("value")), f"{at}/plain")
    _named_files(docs.select(F.concat(F.col("doc_id").cast("string"), F.lit("_layout.md")).alias("name"), text.alias("value")), f"{at}/plain")
    _named_files(docs.where("doc_id % 3 = 0").select(name.alias("name"), F.concat(F.lit("better "), text).alias("value")), f"{at}/better")
    return readers.read_markdown(spark, f"{at}/plain", f"{at}/better").select("paper_id", F.md5("text").alias("text"))


@register("SELECT n_name AS name, max(n_regionkey)::DOUBLE AS lat FROM nation GROUP BY 1")
def dimension_round(spark, d):
    """A dimension of JSON lines: of equal names the last entry counts."""
    at = f"{_folder(spark)}/dim"
    n = table(spark, d, "nation").select("n_name", F.col("n_regionkey").cast("double").alias("lat"), F.col("n_nationkey").alias("ord"))
    sinks.write_lines(n.select(F.col("n_name").alias("name"), (F.col("lat") - 50).alias("lat"), "ord"), at)
    sinks.write_lines(n.select(F.col("n_name").alias("name"), "lat", (F.col("ord") + 1000).alias("ord")), at, append=True)
    return readers.read_dimension(spark, at, "name string, lat double, ord int").select("name", "lat")


@register("SELECT c_name AS paper_id FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 > 0")
def manifest_resume(spark, d):
    """What a manifest hasn't got yet for the current prompt: ids done for an older prompt are to be done again."""
    at, ids = f"{_folder(spark)}/manifest", table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("paper_id"))
    now = sinks.prompt_hash("now")
    sinks.add_done(ids.where("c_custkey % 3 > 0"), at, now)
    sinks.add_done(ids.where("c_custkey % 2 = 0"), at, now)
    sinks.add_done(ids, at, sinks.prompt_hash("before"))
    return readers.not_done(ids, sinks.done_ids(spark, at, now), "paper_id").select("paper_id")


def _echo(prompt: str) -> tuple[str, int, int]:
    """A client that answers with its prompt's last line, as a record in a fence."""
    return "```json\n" + json.dumps({"deposit_type": prompt.rsplit("\n", 1)[-1][:20], "latitude": len(prompt), "longitude": 1}) + "\n```", len(prompt), 3


@register("SELECT doc_id::VARCHAR AS paper_id, substr(lang || '-' || doc_id, 1, 20) AS kind, length('Read:') + 2 + length(lang || '-' || doc_id) AS asked FROM documents")
def client_extraction(spark, d):
    """Records from a model client (a stub): text without references, a fenced answer, tokens counted."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.concat("lang", F.lit("-"), F.col("doc_id").cast("string"), F.lit("# References\nnone")).alias("text"))
    out = models.extract(docs, "Read:", "deposit_type string", _echo, wait=0.0)
    return out.select("paper_id", F.col("extracted.deposit_type").alias("kind"), F.col("tokens.input").alias("asked"))


def _wary(prompt: str) -> tuple[str, int, int]:
    """A client that says yes or no, or fails."""
    last = prompt[-1:]
    if last == "7":
        raise TimeoutError("late")
    return ("No, it isn't." if last in "02468" else "yes"), 1, 1


@register("SELECT c_custkey, c_custkey % 2 = 1 AS wanted FROM customer")
def client_prescreen(spark, d):
    """Yes and no of a client; where it fails a record is wanted."""
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("text"))
    return models.prescreen(rows, "Wanted?", _wary, retries=1, wait=0.0).select("c_custkey", "wanted")


@register("SELECT s_name AS paper_id, (length('Where?') + 2 + length(s_name))::DOUBLE AS latitude FROM supplier")
def client_coordinates(spark, d):
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("paper_id"), F.col("s_name").alias("text"))
    return models.extract_coordinates(rows, "Where?", _echo, wait=0.0).select("paper_id", "latitude")


def _doubtful(prompt: str) -> tuple[str, int, int]:
    return json.dumps({"consistent": prompt.endswith("1"), "issues": "x", "suggested_type": "VMS"}), 1, 1


@register("""SELECT c_name AS paper_id, CASE WHEN c_custkey % 4 = 0 THEN 'low_confidence' WHEN c_custkey % 3 = 0 THEN 'no_text' END AS skip, CASE WHEN c_custkey % 4 > 0 AND c_custkey % 3 > 0 THEN c_custkey % 10 = 1 END AS consistent FROM customer""")
def client_reviews(spark, d):
    """A second opinion on what deserves one, and why the others get none."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.col("c_name").alias("paper_id"), F.lit("VMS").alias("deposit_type"), F.when(k % 4 > 0, 0.9).otherwise(0.5).alias("deposit_type_conf"), F.lit("mineral_deposit").alias("deposit_class"))
    texts = table(spark, d, "customer").where("c_custkey % 3 > 0").select(F.col("c_name").alias("paper_id"), k.cast("string").alias("text"))
    return models.review_types(rows, texts, "Agreed?", _doubtful, wait=0.0).select("paper_id", "skip", F.col("result.consistent").alias("consistent"))


@register("SELECT c_name AS paper_id, c_custkey % 3 < 2 AS consistent FROM customer")
def client_abstracts(spark, d):
    """The type told from the beginning alone against the record's: equal or of one family is consistent."""
    k = F.col("c_custkey") % 3
    rows = table(spark, d, "customer").select(F.col("c_name").alias("paper_id"), F.lit("VMS").alias("deposit_type"))
    texts = table(spark, d, "customer").select(F.col("c_name").alias("paper_id"), F.concat(F.lit("x\n"), F.when(k == 0, "VMS").when(k == 1, "SMS").otherwise("MVT")).alias("text"))
    return models.compare_abstracts(rows, texts, "Which?", _echo, wait=0.0).select("paper_id", "consistent")


def _asks(prompt: str) -> tuple[str, int, int]:
    last = prompt.rsplit(" ", 1)[-1]
    return 'Here: [{"question": "Where is [' + last + ']?", "answer": "' + last + '"}]', 1, 1


@register("SELECT 'fig_' || substr(md5('i' || page_id || '::Where is [' || page_id || ']?'), 1, 10) AS id, 'Where is [' || page_id || ']?' AS question, page_id::VARCHAR AS answer, page_id % 10 = 1 AS guessed FROM pages WHERE page_id % 2 = 1")
def client_figure_questions(spark, d):
    """Questions on figures whose ground truth is long enough, and whether a client without the figure has the answer."""
    k = F.col("page_id").cast("string")
    shown = table(spark, d, "pages").select(k.alias("paper_id"), F.concat(F.lit("i"), k).alias("image_path"), F.lit("c").alias("caption"), F.when(F.col("page_id") % 2 == 1, F.concat(F.lit("a geological map of "), k)).otherwise("short").alias("full_groundtruth"))
    asked = models.figure_questions(shown, "Ask.", _asks, wait=0.0)
    return asked.join(models.blind_test(asked, _guess, wait=0.0), "id").select("id", "question", "answer", "guessed")


def _guess(prompt: str) -> tuple[str, int, int]:
    told = prompt.split("[")[1].split("]")[0]
    return (f"at {told}" if told.endswith("1") else "unknown"), 1, 1


@register("SELECT page_id, CASE WHEN page_id % 10 = 7 THEN 'error:TimeoutError: late' ELSE 'ok' END AS status, CASE WHEN page_id % 10 = 7 THEN 0 WHEN page_id % 2 = 0 THEN 13 ELSE 3 END AS n_chars FROM pages")
def client_images(spark, d):
    """What a vision client says of each image, or how it failed."""
    blocks = table(spark, d, "pages").select("page_id", F.lit("image").alias("task"), F.col("page_id").cast("string").alias("image_path"))
    return models.read_images(blocks, _wary, retries=1, wait=0.0).select("page_id", "status", "n_chars")


@register("SELECT name, length(name)::DOUBLE AS lat FROM (SELECT DISTINCT c_mktsegment AS name FROM customer) UNION ALL SELECT n_name || ' (old), far', length(n_name)::DOUBLE FROM nation")
def client_geocode(spark, d):
    """Names looked up once each; where a name isn't known, shorter forms of it are."""
    names = table(spark, d, "customer").select(F.col("c_mktsegment").alias("name")).unionByName(table(spark, d, "nation").select(F.concat("n_name", F.lit(" (old), far")).alias("name")))
    return models.geocode(names, _short_places, pause=0.0).select("name", "lat")


def _short_places(name: str) -> tuple[float, float] | None:
    return None if "," in name or "(" in name else (float(len(name)), 0.0)


@register("SELECT DISTINCT round(c_nationkey / 8.0, 2)::DOUBLE AS lat2, 'land ' || (c_nationkey // 8) AS country FROM customer")
def client_reverse_geocode(spark, d):
    points = table(spark, d, "customer").select((F.col("c_nationkey") / 8).alias("lat"), F.lit(1.0).alias("lon"))
    return models.reverse_geocode(points, _land, pause=0.0).select("lat2", "country")


def _land(lat: float, lon: float) -> str:
    return f"land {int(lat)}"


@register("SELECT event_id, event_type FROM events")
def stream_without_repeats(spark, d):
    """A stream that brings every event twice, run to its end: each is appended once."""
    at = _folder(spark)
    once = table(spark, d, "events").select("event_id", "event_type", "ts")
    once.unionByName(once).write.json(f"{at}/in")
    stream = ingest.result_stream(spark, f"{at}/in", "event_id bigint, event_type string, ts timestamp", 10_000)
    ingest.append_json(ingest.without_repeats(stream, "event_id"), f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.schema("event_id bigint, event_type string").json(f"{at}/out")


@register("SELECT event_type, count(*) AS total, decision FROM (SELECT event_type, CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN '_stopped' ELSE 'accepted' END AS decision FROM events) GROUP BY ALL")
def stream_guarded(spark, d):
    """Batches of a stream, one with impossible values: it is set aside, the others are appended."""
    at, events = _folder(spark), table(spark, d, "events")
    kinds = [r[0] for r in events.groupBy("event_type").count().orderBy("event_type").collect()]  # a handful of types
    for k, kind in enumerate(kinds):
        place = F.struct(F.lit(200.0 if k == 0 else 20.0).alias("latitude"), F.lit(10.0).alias("longitude"))
        scale = F.struct(F.create_map(F.lit("cu"), F.lit(1.0)).alias("grade"), F.struct(F.lit(5.0).alias("value")).alias("tonnage"))
        sinks.write_lines(events.where(F.col("event_type") == kind).select("event_id", "event_type", place.alias("coordinates"), scale.alias("deposit_scale")).coalesce(1), f"{at}/in", append=True)
    schema = "event_id bigint, event_type string, coordinates struct<latitude:double,longitude:double>, deposit_scale struct<grade:map<string,double>,tonnage:struct<value:double>>"
    ingest.guarded_append(ingest.result_stream(spark, f"{at}/in", schema, 1), f"{at}/out", f"{at}/state", {"coordinates": 0.65}).awaitTermination()
    read = [spark.read.parquet(f"{at}/out/{where}").select("event_type", F.lit(where).alias("decision")) for where in ("accepted", "_stopped")]
    return read[0].unionByName(read[1]).groupBy("event_type", "decision").agg(F.count("*").alias("total"))
