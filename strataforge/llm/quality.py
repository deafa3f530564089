"""Operator 7: quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

Symbols are whole code points with their case, n-grams are of ORDER symbols.  N-grams of the trusted texts
are counted per task and added up by n-gram; lower orders count distinct left contexts; discounts come
from counts of counts; each order's counts are joined with their contexts' totals and count classes.

The model grows with the text, so no one holds it.  Texts are cut into chunks of CHUNK_BYTES; a chunk asks
for its own distinct n-grams and contexts in sorted blobs dealt out by hash, each bucket answers from its
part of the model, and a chunk's texts are scored from its answers.  N-grams are known by 64-bit hashes.
A document's perplexity is that of its whole text; it is kept if it isn't above its language's quantile of
the trusted texts' perplexities.

Trusted: all rows labelled quality 1.  A half of them, by hash, trains the model, the other sets the
quantiles, so that these hold for texts it hasn't seen.  Languages
with fewer than LEAST_TRUSTED trusted texts, and null languages, use the quantile of all trusted texts.

Null and empty texts have a null perplexity and aren't kept; symbols that training lacks share one place of
the lowest, uniform order; without trusted text every perplexity is 1 and nothing is kept;
repeated rows and ids get a row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lm_scoring import _number, _numbers
from .packed import pack, unpack
from .store import free, pick, staged
from .words import mix, row_groups, text_buffer

ORDER, BITS = 4, 5
LEAST_TRUSTED = 30
QUANTILE = 0.995
PIECE = 1 << 20
CHUNK_BYTES = 8 << 20
BUCKET_KEYS = 1 << 20

_ODD = mix(np.arange(1, ORDER + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def symbols(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points, plus 1, of UTF-8 texts, and the offsets of the texts among them."""
    lead = (buf & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    place = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(lead, out=place[1:])
    out = buf[at].astype(np.uint32)
    wide = np.flatnonzero(out >= 0x80)
    if len(wide):
        first, b = out[wide], [np.append(buf, [0] * 3).astype(np.uint32)[at[wide] + k] & 0x3F for k in (1, 2, 3)]
        two, three = (first & 31) << 6 | b[0], (first & 15) << 12 | b[0] << 6 | b[1]
        out[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, (first & 7) << 18 | b[0] << 12 | b[1] << 6 | b[2]))
    return out + np.uint32(1), place[off]


def gram_keys(grams: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of symbols; those of different lengths differ too."""
    n, k = grams.shape
    out = np.full(n, k + 1, np.uint64) * np.uint64(0x632BE59BD9B4E019)
    for j in range(k):
        out += grams[:, j].astype(np.uint64) * _ODD[j]
    return mix(out)


def pieces(sym: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, distinct, index, n): the distinct rows of ORDER symbols that end at the symbols from place on, which of them each is and how
    often each occurs; 0 stands before a text's start."""
    for a in range(0, len(sym), PIECE):
        b, lead = min(len(sym), a + PIECE), max(0, a - ORDER + 1)
        starts = off[(off >= lead) & (off < b)] - lead
        before = [sym[lead:b]]
        for _ in range(1, ORDER):
            shifted = np.zeros_like(before[0])
            shifted[1:] = before[0][:-1]
            shifted[starts] = 0
            before.insert(0, shifted)
        rows = np.stack([x[a - lead :] for x in before], axis=1)
        coded = pa.array(gram_keys(rows)).dictionary_encode()
        index = coded.indices.to_numpy()
        one = np.empty(len(coded.dictionary), np.int64)
        one[index] = np.arange(len(index))
        yield a, rows[one], index, np.bincount(index, minlength=len(one))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_groups(batches, "text", CHUNK_BYTES):
        for _, rows, _, n in pieces(*symbols(*text_buffer(batch.column("text")))):
            blob = np.ascontiguousarray(rows, ">u4").tobytes()
            grams = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * ORDER), len(rows), [None, pa.py_buffer(blob)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([grams, pa.array(n, pa.int64())], names=["gram", "n"])


def _suffix(order: int, wide: bool) -> Column:
    """The last symbols of an n-gram that is one longer."""
    return F.substring("gram", 5, 4 * order) if wide else F.col("gram").bitwiseAND((1 << BITS * order) - 1)


def kneser_ney(grams: DataFrame, wide: bool = False) -> DataFrame:
    """grams(gram, n) of ORDER symbols to rows (order, gram, share, gamma): the discounted share of each n-gram and its context's backoff weight.

    wide: a symbol is four bytes of a binary, else BITS of a long.
    """
    out = level = None
    for order in range(ORDER, 0, -1):
        level = grams if order == ORDER else level.groupBy(_suffix(order, wide).alias("gram")).agg(F.count("*").alias("n")).select("gram", "n")
        if wide:
            level = staged(level, f"level{order}")
        low = [F.count_if(F.col("n") == k).alias(f"t{k}") for k in (1, 2, 3, 4)]
        t = level.agg(*low).select(*(F.greatest(F.col(f"t{k}"), F.lit(1)).cast("double").alias(f"t{k}") for k in (1, 2, 3, 4)))
        y = F.col("t1") / (F.col("t1") + 2 * F.col("t2"))
        # discounts of counts 1, 2 and 3 or more
        d = t.select(*(F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}"))).alias(f"d{k}") for k in (1, 2, 3)))
        placed = level.withColumn("context", F.substring("gram", 1, 4 * (order - 1)) if wide else F.shiftright("gram", BITS))
        contexts = placed.groupBy("context").agg(F.sum("n").alias("total"), *(F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2)), F.count_if(F.col("n") >= 3).alias("n3"))
        joined = placed.join(contexts, "context") if order > 1 else placed.crossJoin(F.broadcast(contexts.drop("context")))  # the lowest has one context
        joined = joined.crossJoin(F.broadcast(d))  # one row of discounts
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        gamma = (F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total")
        rows = joined.select(F.lit(order).alias("order"), "gram", ((F.col("n") - cut) / F.col("total")).alias("share"), gamma.alias("gamma"))
        out = rows if out is None else out.unionByName(rows)
    return out


def dense(rows: list, size: int = 1 << BITS) -> np.ndarray:
    """log10 of the probability of every n-gram's last symbol, orders interpolated from the lowest: the whole table of a model of few symbols."""
    p = np.full(1, 1 / size)
    by = {o: [] for o in range(1, ORDER + 1)}
    for order, gram, share, gamma in rows:
        by[order].append((gram, share, gamma))
    for order in range(1, ORDER + 1):
        share, gamma = np.zeros(1 << BITS * order), np.ones(1 << BITS * (order - 1))
        if by[order]:
            g, s, w = (np.array(x) for x in zip(*by[order], strict=True))
            share[g.astype(np.int64)] = s
            gamma[g.astype(np.int64) >> BITS] = w
        codes = np.arange(len(share))
        lower = p[codes & ((1 << BITS * (order - 1)) - 1)] if order > 1 else np.full(len(share), 1 / size)
        p = share + gamma[codes >> BITS] * lower
    return np.log10(p).astype(np.float32)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, share, gamma) of n-grams and of their contexts, 0 where a row doesn't say."""
    for batch in batches:
        order, gram = batch.column("order").to_numpy(), batch.column("gram")
        share, gamma = (batch.column(n).to_numpy() for n in ("share", "gamma"))
        for k in np.unique(order).tolist():
            of = np.flatnonzero(order == k)
            rows = np.frombuffer(b"".join(gram.take(pa.array(of)).to_pylist()), ">u4").reshape(-1, k)
            key = np.concatenate([gram_keys(rows), gram_keys(rows[:, :-1])]).view(np.int64)
            none = np.zeros(len(of))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate([share[of], none])), pa.array(np.concatenate([none, gamma[of]]))], names=["key", "share", "gamma"])


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk each: its documents and its texts."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in row_groups(batches, "text", CHUNK_BYTES):
        buf, off = text_buffer(batch.column("text"))
        ids = batch.column("doc_id")
        yield pa.RecordBatch.from_arrays([
            pa.array([part << 32 | seq], pa.int64()),
            pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()),
            pa.array([np.packbits(ids.is_valid().to_numpy(zero_copy_only=False)).tobytes()], pa.binary()),
            pa.array([batch.column("lang").to_pylist()], pa.list_(pa.string())),
            pa.array([_number(np.diff(off))], pa.binary()),
            pa.array([zstandard.ZstdCompressor(level=3).compress(buf.tobytes())], pa.binary()),
            pa.array([len(buf)], pa.int64()),
        ], names=["chunk", "ids", "valid", "langs", "lengths", "texts", "size"])
        seq += 1


class _Chunk:
    """A chunk's row as symbols, their distinct n-grams and the keys it asks for."""

    def __init__(self, row: dict):
        buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["texts"]), np.uint8)
        self.sym, self.off = symbols(buf, np.append(0, np.cumsum(_numbers(row["lengths"]))))
        found = [rows for _, rows, _, _ in pieces(self.sym, self.off)]
        rows = np.concatenate([np.empty((0, ORDER), np.uint32), *found])
        self.distinct, first = np.unique(gram_keys(rows), return_index=True)
        self.rows = rows[first]
        asked = [gram_keys(self.rows[:, ORDER - k : end]) for k in range(1, ORDER + 1) for end in (ORDER, ORDER - 1)]
        self.keys = np.unique(np.concatenate(asked))
        self.asked = asked  # of orders from the lowest: the n-gram, its context

    def logs(self, share: np.ndarray, gamma: np.ndarray, size: int) -> np.ndarray:
        """log10 of the probability of each distinct n-gram's last symbol."""
        p = np.full(len(self.rows), 1 / size)
        for gram, context in zip(self.asked[::2], self.asked[1::2], strict=True):
            p = share[np.searchsorted(self.keys, gram)] + gamma[np.searchsorted(self.keys, context)] * p
        return np.log10(p)


def _deal(bits: int):
    """Requests (bucket, chunk, keys); a bucket holds the keys that begin with its bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]  # a chunk at a time
                keys = _Chunk(row).keys
                cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() if bits else []
                bounds = [0, *cuts, len(keys)]
                some = [(b, pack(keys[x:y])) for b, (x, y) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in some], pa.int32()), pa.array([row["chunk"]] * len(some), pa.int64()), pa.array([x for _, x in some], pa.binary())], names=["bucket", "chunk", "keys"])

    return run


def _answer(requests: pa.Table, model: pa.Table) -> pa.Table:
    """Answers (chunk, bucket, values) of a bucket: for each key its share, 0 if it has none, and its weight as a context, 1 if it is none."""
    key = model["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    key = np.append(key[order], np.uint64(0))
    share, gamma = (np.append(model[n].to_numpy()[order], 0).astype("<f4") for n in ("share", "gamma"))
    out = []
    for blob in requests["keys"]:
        asked = unpack(blob.as_py())
        at = np.searchsorted(key[:-1], asked)
        known = (at < len(key) - 1) & (key[at] == asked)
        weight = np.where(known, gamma[at], 0)
        out.append(np.where(known, share[at], 0).astype("<f4").tobytes() + np.where(weight > 0, weight, 1).astype("<f4").tobytes())
    return pa.table({"chunk": requests["chunk"], "bucket": requests["bucket"], "answers": pa.array(out, pa.binary())})


def _score(size: int):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = {n: [] for n in ("doc_id", "lang", "n_symbols", "perplexity")}
        if chunks.num_rows:
            row = chunks.to_pylist()[0]
            c = _Chunk(row)
            found = sorted(zip(answers["bucket"].to_pylist(), answers["answers"].to_pylist(), strict=True))
            halves = [np.frombuffer(x, "<f4").reshape(2, -1) for _, x in found]
            share, gamma = np.concatenate([np.empty((2, 0), "<f4"), *halves], axis=1).astype(float)
            if len(share) != len(c.keys):
                raise ValueError("answers don't fit the chunk")
            log, ends = c.logs(share, gamma, size), np.zeros(len(c.sym) + 1)
            for a, rows, index, _ in pieces(c.sym, c.off):
                each = log[np.searchsorted(c.distinct, gram_keys(rows))][index]
                ends[a + 1 : a + 1 + len(each)] = np.cumsum(each) + ends[a]
            total, n = ends[c.off[1:]] - ends[c.off[:-1]], np.diff(c.off)
            valid = np.unpackbits(np.frombuffer(row["valid"], np.uint8), count=len(n)).astype(bool)
            out = {"doc_id": pa.array(np.frombuffer(row["ids"], np.int64), mask=~valid), "lang": row["langs"], "n_symbols": n, "perplexity": pa.array(np.power(10.0, -total / np.maximum(n, 1)), mask=n == 0)}
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.float64())
        return pa.table({n: x if isinstance(x, pa.Array) else pa.array(x, k) for (n, x), k in zip(out.items(), kinds, strict=True)})

    return run


def _trains(key: str = "doc_id"):
    return F.pmod(F.xxhash64(F.lit(29), key), F.lit(2)) == 0


def rate_quality(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, lang, n_symbols, perplexity, threshold, own_threshold (its language's, not that of all), kept. trusted_ids: one column of ids."""
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    ids = staged(ids, "trusted")
    rows = pick(docs, doc_id=key, text=text, lang=lang).withColumns({"doc_id": F.col("doc_id").cast("long"), "lang": F.col("lang").cast("string")})
    fitted = ids.where(_trains("id"))
    trained = rows.join(fitted.hint("merge"), rows["doc_id"] == fitted["id"], "left_semi").select("text")  # sorted whatever the size: the ids grow too
    grams = trained.mapInArrow(_count, "gram binary, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    shares = staged(kneser_ney(grams, wide=True), "shares")
    size = shares.where(F.col("order") == 1).count() + 1
    model = staged(shares.mapInArrow(_keyed, "key long, share double, gamma double").groupBy("key").agg(F.max("share").alias("share"), F.max("gamma").alias("gamma")), "model")
    free(shares)
    chunks = staged(rows.mapInArrow(_chunk, "chunk long, ids binary, valid binary, langs array<string>, lengths binary, texts binary, size long"), "chunks")
    most = max(model.count(), (chunks.agg(F.sum("size")).first()[0] or 0) // 16)  # of distinct n-grams, a symbol in sixteen is many
    bits = max(0, (math.ceil(most / BUCKET_KEYS) - 1).bit_length())
    requests = chunks.mapInArrow(_deal(bits), "bucket int, chunk long, keys binary")
    dealt = model.withColumn("bucket", F.shiftrightunsigned("key", 64 - bits).cast("int") if bits else F.lit(0))
    answers = staged(requests.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(_answer, "chunk long, bucket int, answers binary"), "answers")
    free(model)
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(size), "doc_id long, lang string, n_symbols long, perplexity double")
    rated = staged(scored, "rated")
    free(chunks, answers)
    others = ids.where(~_trains("id"))
    bound = rated.where("perplexity IS NOT NULL").join(others, rated["doc_id"] == others["id"], "left_semi")
    whole = bound.agg(F.percentile_approx("perplexity", quantile, 10_000)).first()[0]
    by = bound.where("lang IS NOT NULL").groupBy(F.col("lang").alias("of")).agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"), F.count("*").alias("n")).where(F.col("n") >= LEAST_TRUSTED)
    out = rated.join(by, rated["lang"] == by["of"], "left").withColumns({"own_threshold": F.col("threshold").isNotNull(), "threshold": F.coalesce("threshold", F.lit(whole).cast("double"))})
    return out.select("doc_id", "lang", "n_symbols", "perplexity", "threshold", "own_threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))
