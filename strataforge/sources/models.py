"""Model-backed sources: pluggable clients called per batch on the executors, with retries; a deterministic stub stands in offline.

A client is a function from a prompt to (text, tokens in, tokens out). It must be picklable. Results carry their own usage, so there is
no shared counter, and an error becomes a row instead of ending the job.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut_at_earliest, cut_at_first_listed, head

Client = Callable[[str], tuple[str, int, int]]
ANSWER = "answer string, prompt_tokens long, completion_tokens long, error string"
PRESCREEN_CHARS, FULL_CHARS = 1500, 30_000
BATCH_ROWS = 8


def stub(prompt: str) -> tuple[str, int, int]:
    """An answer that depends on the prompt alone: a record with nothing in it but a digest."""
    text = json.dumps({"digest": hashlib.sha256(prompt.encode()).hexdigest()[:16]})
    return text, len(prompt) // 4, len(text) // 4


def ask(client: Client, prompt: str, retries: int = 3, wait: float = 1.0) -> tuple[str | None, int, int, str | None]:
    """The client's answer without a code fence; waits 1, 2, 4 ... times wait between tries."""
    error = None
    for k in range(retries):
        try:
            text, i, o = client(prompt)
            return re.sub(r"^```(?:json)?\s*|\s*```$", "", text.strip()), i, o, None
        except Exception as e:  # a client may raise anything; the row tells of it
            error = f"{type(e).__name__}: {e}"
            if k + 1 < retries:
                time.sleep(wait * 2**k)
    return None, 0, 0, error


def answers(df: DataFrame, prompt: str, client: Client = stub, retries: int = 3, wait: float = 1.0) -> DataFrame:
    """df with answer, prompt_tokens, completion_tokens and error for the column prompt."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            got = [ask(client, p, retries, wait) for p in part[prompt]]
            yield part.assign(answer=[g[0] for g in got], prompt_tokens=[g[1] for g in got], completion_tokens=[g[2] for g in got], error=[g[3] for g in got])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{schema}, {ANSWER}")


def extract(papers: DataFrame, system: str, schema: str, client: Client = stub, most: int = FULL_CHARS, **how) -> DataFrame:
    """Records from (paper_id, text): text without references, cut to most characters; paper_id is always the file's."""
    rows = papers.select("paper_id", F.concat(F.lit(system + "\n\n"), head(cut_at_first_listed("text"), most)).alias("prompt"))
    got = answers(rows, "prompt", client, **how)
    return got.select("paper_id", F.from_json("answer", schema).alias("extracted"), F.struct(F.col("prompt_tokens").alias("input"), F.col("completion_tokens").alias("output")).alias("tokens"), "error")


def prescreen(papers: DataFrame, question: str, client: Client = stub, **how) -> DataFrame:
    """papers with wanted: the client's yes or no to the beginning of each; true where it gives none."""
    rows = papers.withColumn("prompt", F.concat(F.lit(question + "\n\n"), head("text", PRESCREEN_CHARS)))
    got = answers(rows, "prompt", client, **how)
    said = F.lower(F.trim("answer"))
    return got.withColumn("wanted", F.when(F.col("error").isNotNull() | said.isNull(), True).when(said.rlike(r"^\W*(no|false)\b"), False).otherwise(True)).select(*papers.columns, "wanted")


def extract_coordinates(papers: DataFrame, question: str, client: Client = stub, most: int = 4000, **how) -> DataFrame:
    """(paper_id, latitude, longitude, precision, source, confidence) of the first object that the client names."""
    from ..functions.text import braced_object

    rows = papers.select("paper_id", F.concat(F.lit(question + "\n\n"), head("text", most)).alias("prompt"))
    got = answers(rows, "prompt", client, **how)
    return got.select("paper_id", F.from_json(braced_object("answer"), "latitude double, longitude double, precision string, source string, confidence double").alias("c")).select("paper_id", "c.*")


def review_types(records: DataFrame, texts: DataFrame, question: str, client: Client = stub, most: int = 1500, **how) -> DataFrame:
    """(paper_id, result) where the record is to be reviewed, (paper_id, skip) where not."""
    from ..operators.review import skip_reason

    rows = records.withColumn("skip", skip_reason(records)).join(texts, "paper_id", "left").withColumn("skip", F.coalesce("skip", F.when(F.col("text").isNull(), "no_text")))
    todo = rows.where("skip IS NULL").select("paper_id", F.concat(F.lit(question + "\n"), F.col("deposit_type"), F.lit("\n\n"), head(cut_at_earliest("text"), most)).alias("prompt"))
    got = answers(todo, "prompt", client, **how).select("paper_id", F.from_json("answer", "consistent boolean, confidence double, issues string, suggested_type string").alias("result"), F.lit(None).cast("string").alias("skip"), "error")
    none = F.lit(None)
    return got.unionByName(rows.where("skip IS NOT NULL").select("paper_id", none.cast("struct<consistent:boolean,confidence:double,issues:string,suggested_type:string>").alias("result"), "skip", none.cast("string").alias("error")))


def compare_abstracts(records: DataFrame, texts: DataFrame, question: str, client: Client = stub, most: int = 1500, **how) -> DataFrame:
    """(paper_id, fulltext_type, abstract_type, consistent): the type told from the beginning alone against the record's, by family."""
    from ..operators.score import same_family

    rows = records.where("deposit_type IS NOT NULL").join(texts, "paper_id").select("paper_id", "deposit_type", F.concat(F.lit(question + "\n\n"), head(cut_at_earliest("text"), most)).alias("prompt"))
    got = answers(rows, "prompt", client, **how)
    kind = F.from_json("answer", "deposit_type string")["deposit_type"]
    return got.select("paper_id", F.col("deposit_type").alias("fulltext_type"), kind.alias("abstract_type"), F.when(kind.isNotNull(), same_family(F.col("deposit_type"), kind)).alias("consistent"), "error")


def figure_questions(figures: DataFrame, question: str, client: Client = stub, n: int = 3, **how) -> DataFrame:
    """(id, image, question, answer, caption, paper_id) from figures with a ground truth."""
    from ..functions.text import bracketed_list, short_id

    rows = figures.where(F.length("full_groundtruth") >= 20).withColumn("prompt", F.concat(F.lit(f"{question}\n{n}\n\n"), F.col("full_groundtruth")))
    got = answers(rows.select("paper_id", "image_path", "caption", "prompt"), "prompt", client, **how)
    out = got.select("*", F.explode(F.from_json(bracketed_list("answer"), "array<struct<question:string,answer:string>>")).alias("q"))
    return out.select(F.concat(F.lit("fig_"), short_id("image_path", "q.question", n=10)).alias("id"), F.col("image_path").alias("image"), "q.question", F.col("q.answer").alias("answer"), "caption", "paper_id")


def blind_test(questions: DataFrame, client: Client = stub, **how) -> DataFrame:
    """(id, guessed): whether a client without the image gives the answer."""
    got = answers(questions.select("id", "question", F.col("answer").alias("truth")), "question", client, **how)
    return got.select("id", F.coalesce(F.contains(F.lower("answer"), F.lower("truth")), F.lit(False)).alias("guessed"))


def read_images(blocks: DataFrame, client: Client = stub, **how) -> DataFrame:
    """Vision results of layout blocks: status ok, empty or error:..., output and its length."""
    rows = blocks.withColumn("prompt", F.concat_ws("\n", "task", "image_path"))
    got = answers(rows, "prompt", client, **how)
    status = F.when(F.col("error").isNotNull(), F.concat(F.lit("error:"), "error")).when(F.coalesce("answer", F.lit("")) == "", "empty").otherwise("ok")
    return got.select(*blocks.columns, status.alias("status"), F.coalesce("answer", F.lit("")).alias("output"), F.length(F.coalesce("answer", F.lit(""))).alias("n_chars"))


def geocode(names: DataFrame, lookup: Callable[[str], tuple[float, float] | None], pause: float = 1.1) -> DataFrame:
    """(name, lat, lon): distinct names looked up one at a time in one task, with a pause; each name, then shorter forms of it."""

    def forms(name: str) -> list[str]:
        plain = re.sub(r"\s*[(（].*?[)）]|[一-鿿]+", "", name).strip()
        return list(dict.fromkeys(x for x in (name, plain, plain.split(",")[0].strip()) if x))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for name in part["name"]:
                for form in forms(name):
                    found = lookup(form)
                    time.sleep(pause)
                    if found:
                        out.append((name, float(found[0]), float(found[1])))
                        break
            yield pd.DataFrame(out, columns=["name", "lat", "lon"])

    # a service that allows one call a second is the limit, not the cluster
    return names.select("name").distinct().coalesce(1).mapInPandas(run, "name string, lat double, lon double")


def reverse_geocode(points: DataFrame, lookup: Callable[[float, float], str | None], pause: float = 0.5) -> DataFrame:
    """(lat2, lon2, country) of distinct places rounded to two decimals, each looked up once."""
    places = points.select(F.round("lat", 2).alias("lat2"), F.round("lon", 2).alias("lon2")).distinct()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for a, b in zip(part["lat2"], part["lon2"], strict=True):
                out.append(lookup(a, b))
                time.sleep(pause)
            yield part.assign(country=out)

    return places.coalesce(1).mapInPandas(run, "lat2 double, lon2 double, country string")
