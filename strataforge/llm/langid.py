"""Operator 4: language by compression.

For each language a raw-content Zstandard dictionary is cut from a bounded sample of labelled texts.
A text is folded to lower-case letters and single
spaces and compressed in blocks with every dictionary and gets the language whose total is smallest.
The score is the margin to the runner-up relative to what the best dictionary saves or leaves; texts
whose margin is below MARGIN are marked as rejected.

Training: rows with a text, a label and a truth of `train`; the sample is bounded by SAMPLE_DOCS rows
a language and DICTIONARY_BYTES of them (documented parameters), drawn by a hash of the key.  Languages
that fill DICTIONARY_BYTES have dictionaries of equal size; one with less text keeps its own shorter one and
changes no other's.

A null text or one without a letter is `und` with score 0 and rejected; with one learned language
every other text gets it; with none all are `und`.  Ties go to the language first by code point.
Texts are compressed whole.  Empty tables, repeated rows and further columns pass through; a column named
like an output is replaced by it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import pick, without
from .words import row_groups

SAMPLE_DOCS, SNIPPET_CHARS, DICTIONARY_BYTES = 250, 200, 32 << 10
BLOCK_BYTES, LEVEL = 1024, 5
MARGIN = 0.004
MAX_LANGUAGES = 1000
UNKNOWN = "und"


_NO_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str) -> bytes:
    """Lower-case letters with single spaces between: case, digits and marks don't tell languages apart."""
    return _NO_LETTERS.sub(" ", text.lower()).encode()


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def learn(docs: DataFrame, train: Column | None = None, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """Dictionary content of each language; train: a condition over doc_id, by default that the row isn't held out."""
    rows = pick(docs, doc_id=key, lang=lang, text=text).where((~held_out() if train is None else train) & F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0))
    rows = rows.select("lang", "text", F.xxhash64(F.lit(5), "doc_id").alias("draw"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{len(counts)} languages; at most {MAX_LANGUAGES} are meant")
    if not counts:
        return {}
    # a threshold on the hash leaves about SAMPLE_DOCS rows of each language, however many it has
    least = -(1 << 63)
    limit = F.create_map(*[F.lit(x) for s, n in counts.items() for x in (s, min((1 << 63) - 1, least + math.ceil((1 << 64) * min(1.0, SAMPLE_DOCS / n))))])
    room = F.greatest(F.length("text") - SNIPPET_CHARS, F.lit(0))
    snippet = F.substring(F.col("text"), (F.pmod(F.shiftrightunsigned("draw", 7), room + 1) + 1).cast("int"), F.lit(SNIPPET_CHARS))
    picked = rows.where(F.col("draw") <= limit[F.col("lang")]).select("lang", "draw", snippet.alias("snippet")).orderBy("draw", "snippet").limit(2 * SAMPLE_DOCS * len(counts))
    parts: dict[str, list[bytes]] = {s: [] for s in counts}
    for r in picked.collect():  # bounded by SAMPLE_DOCS snippets a language, twice that at most
        parts[r["lang"]].append(folded(r["snippet"]))
    out = {}
    for s, found in sorted(parts.items()):
        whole = b"\n".join(dict.fromkeys(found))
        if whole:
            out[s] = whole[:DICTIONARY_BYTES]
    return out


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names, self.by = sorted(dictionaries), []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def predict(self, data: bytes) -> tuple[str, float]:
        if not self.names:
            return UNKNOWN, 0.0
        sizes = np.zeros(len(self.by), np.int64)
        for at in range(0, len(data), BLOCK_BYTES):
            block = data[at : at + BLOCK_BYTES]
            sizes += [len(c.compress(block)) for c in self.by]
        order = np.argsort(sizes, kind="stable")
        best = int(sizes[order[0]])
        margin = 1.0 if len(order) == 1 else (int(sizes[order[1]]) - best) / max(1, int(sizes[order[1]]))
        return self.names[order[0]], min(1.0, max(0.0, margin))


_MODELS: dict[int, Compressors] = {}


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and lang_rejected."""
    # at most MAX_LANGUAGES times DICTIONARY_BYTES
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    names = ["lang_pred", "score", "lang_rejected"]
    docs = without(docs, *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        key = hash(tuple(sorted(learned.items())))
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Compressors(learned)
        model = _MODELS[key]
        for batch in row_groups(batches, text, 8 << 20):
            column = batch.column(text)
            letters = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_pylist()
            found = [model.predict(folded(t)) if ok else (UNKNOWN, 0.0) for t, ok in zip(column.to_pylist(), letters, strict=True)]
            more = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[0] == UNKNOWN or f[1] < margin for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])

    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields), "lang_pred string, score double, lang_rejected boolean"])
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, train: Column | None = None, text: str = "text", lang: str = "lang", key: str = "doc_id", margin: float = MARGIN) -> DataFrame:
    """Learn from the rows where train holds (a condition over doc_id; not held out if None), then classify all."""
    return classify(docs, learn(docs, train, text, lang, key), text, margin)
