"""Operator 2: scoring by a weighted backoff automaton.

The model is a trigram model with hierarchical Dirichlet smoothing.  Its states are the contexts seen in training: two words, the start
of a text and a word, a word, the start, and a root.  An arc over w from a state that c tokens of training left, c(w) of them by w, weighs
log10((c(w) + m P(w)) / (c + m)) with P(w) what the shorter context says, and leads to the state of the last two words.  Where a state
has no arc over w, its failure arc, log10(m / (c + m)), leads to the state of the shorter context; the root's arc over w weighs
log10((c(w) + 1) / (N + V + 1)) and leads to the word's state, or back to the root.  A text is read once from left to right: the state is
carried on, and over each token failure arcs are followed until an arc fits.  Smoothing needs only counts, so no context's followers are
gathered.

Counts are as large as the corpus, so no one holds them.  Texts are cut into chunks of CHUNK_BYTES; a chunk asks for its own distinct
n-grams in sorted blobs dealt out by hash; each bucket adds up what the chunks' training texts hold and answers every chunk in its order.
So a frequent word costs its bucket an entry a chunk, not one an occurrence.  The part of the automaton that a chunk can reach is
then built from its answers and its texts are scored.  Trigrams are asked for after shorter n-grams, so that only one of these shuffles is
on disk at a time.

N-grams are told apart by 64-bit hashes.

Null and empty texts consist of the end token alone; rows with null doc_id are held out of nothing and
train; repeated rows train as often as they occur; an empty table gives an empty result; with no training
text every token is unknown, P = 1 and the base score 0; further columns are ignored.
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

from .packed import pack, unpack
from .store import pick, staged
from .words import mix, row_groups, text_buffer, word_hashes

CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 1 << 20
#: m of contexts of one and of two words.
STRENGTHS = (300.0, 30.0)
#: Steps that parts of texts take side by side.
STEPS = 128
#: Hashes that stand for the end token and for the state before the first.
END, START = np.uint64(0x5EED0E2D), np.uint64(0x5EED57A7)


def held_out(key: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def _number(values: np.ndarray) -> bytes:
    """Counts in the fewest of 1, 2, 4 or 8 bytes each."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk each: its documents, their texts, how many tokens and training texts and tokens it has."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in row_groups(batches, "text", CHUNK_BYTES):
        buf, off = text_buffer(batch.column("text"))
        ids, held = batch.column("doc_id"), batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        lengths = word_hashes(buf, off)[1] + 1
        yield pa.RecordBatch.from_arrays([
            pa.array([part << 32 | seq], pa.int64()),
            pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()),
            pa.array([np.packbits(ids.is_valid().to_numpy(zero_copy_only=False)).tobytes()], pa.binary()),
            pa.array([np.packbits(held).tobytes()], pa.binary()),
            pa.array([_number(np.diff(off))], pa.binary()),
            pa.array([zstandard.ZstdCompressor(level=3).compress(buf.tobytes())], pa.binary()),
            pa.array([int(lengths.sum())], pa.int64()),
            pa.array([int((~held).sum())], pa.int64()),
            pa.array([int(lengths[~held].sum())], pa.int64()),
        ], names=["chunk", "ids", "valid", "held", "lengths", "texts", "tokens", "train_texts", "train_tokens"])
        seq += 1


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = mix(first)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= second
        return mix(out)


class _Chunk:
    """A chunk's tokens and the distinct n-grams that end at them, each order's in the order of their hashes."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        n = len(self.ids)
        self.valid = np.unpackbits(np.frombuffer(row["valid"], np.uint8), count=n).astype(bool)
        self.held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=n).astype(bool)
        buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["texts"]), np.uint8)
        hashes, counts = word_hashes(buf, np.append(0, np.cumsum(_numbers(row["lengths"]))))
        stream = np.insert(hashes, np.cumsum(counts), END)
        self.lengths = counts + 1
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~self.held, self.lengths)
        self.words, self.word = np.unique(stream, return_inverse=True)
        before = np.empty_like(stream)
        before[1:], before[self.begin] = stream[:-1], START
        self.pairs = pair_hashes(before, stream)
        self.stream = stream

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, where each occurs first, and which of them ends at each token."""
        return np.unique(self.pairs, return_index=True, return_inverse=True)

    def trigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As bigrams(), and the places of the tokens that have one: all but a text's first, the text's start being the first word of its second's."""
        inner = np.ones(len(self.stream), bool)
        inner[self.begin] = False
        at = np.flatnonzero(inner)
        distinct, first, which = np.unique(pair_hashes(self.pairs[at - 1], self.stream[at]), return_index=True, return_inverse=True)
        return distinct, at[first], which, at


def _deal(orders: list[tuple[int, int, int]]):
    """Requests (bucket, chunk, keys, counts) for n-grams of the given orders; each is (order, first bucket, bits of its buckets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]  # a chunk at a time
                c = _Chunk(row)
                for order, base, bits in orders:
                    if order == 1:
                        keys, which, train = c.words, c.word, c.train
                    elif order == 2:
                        (keys, _, which), train = c.bigrams(), c.train
                    else:
                        keys, _, which, at = c.trigrams()
                        train = c.train[at]
                    counts = np.bincount(which[train], minlength=len(keys))
                    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() if bits else []
                    rows = [(base + b, pack(keys[x:y]), _number(counts[x:y])) for b, (x, y) in enumerate(zip([0, *cuts], [*cuts, len(keys)], strict=True)) if y > x]
                    for k in range(0, len(rows), 256):
                        some = list(zip(*rows[k : k + 256], strict=True))
                        yield pa.RecordBatch.from_arrays([pa.array(some[0], pa.int64()), pa.array([row["chunk"]] * len(some[0]), pa.int64()), pa.array(some[1], pa.binary()), pa.array(some[2], pa.binary())], names=["bucket", "chunk", "keys", "counts"])

    return run


def _total(words: int):
    """Answers (chunk, bucket, totals) to a bucket's requests, and with a null chunk how many trained words it has."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        keys = [unpack(b.as_py()) for b in table["keys"]]
        counts = np.concatenate([_numbers(b.as_py()) for b in table["counts"]])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, counts, len(distinct)).astype(np.int64)
        each = np.split(total[place], np.cumsum([len(k) for k in keys])[:-1])
        chunk, answers = table["chunk"].to_pylist(), [_number(x) for x in each]
        if bucket < words:
            chunk, answers = [*chunk, None], [*answers, _number(np.array([int((total > 0).sum())]))]
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "bucket": pa.array([bucket] * len(chunk), pa.int64()), "totals": pa.array(answers, pa.binary())})

    return run


class Automaton:
    """The states and arcs that one chunk can reach.

    States: 0 is the root, then one a word, the start of a text, one a bigram.  Those that training lacks have no arc that leads to them.
    """

    def __init__(self, c: _Chunk, counts: list[np.ndarray], texts: int, tokens: int, distinct: int, strengths: tuple[float, float]):
        """counts: of training, of the chunk's distinct words, bigrams and trigrams; texts: the count of the state before a first token."""
        one, two, three = counts
        m2, m3 = strengths
        self.n = n = len(one)
        self.root = np.log10((one + 1) / (tokens + distinct + 1))
        self.home = np.where(one > 0, np.arange(n) + 1, 0)  # where the root's arcs lead
        self.start = n + 1
        _, first, bigram = c.bigrams()
        word, begins = c.word[first], np.zeros(len(c.word), bool)
        begins[c.begin] = True
        left = np.append(one, texts)
        before = np.where(begins[first], n, c.word[first - 1])
        p2 = (two + m2 * 10.0 ** self.root[word]) / (left[before] + m2)
        state = np.arange(len(two)) + n + 2
        _, last, _, _ = c.trigrams()
        p3 = (three + m3 * p2[bigram[last]]) / (two[bigram[last - 1]] + m3)
        some, more = two > 0, three > 0
        keys = np.concatenate([(before[some] + 1) * n + word[some], state[bigram[last - 1]][more] * n + c.word[last][more]])
        order = np.argsort(keys)
        self.arcs = np.append(keys[order], -1)
        self.weight = np.log10(np.concatenate([p2[some], p3[more]])[order])
        self.to = np.concatenate([state[some], state[bigram[last]][more]])[order]
        self.fail_to = np.concatenate([np.zeros(n + 2, np.int64), word + 1])
        self.fail = np.concatenate([[0.0], np.log10(m2 / (left + m2)), np.log10(m3 / (two + m3))])

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after reading a word each, and the log10 of each step."""
        state, log, after = state.copy(), np.zeros(len(state)), np.empty(len(state), np.int64)
        left = np.arange(len(state))
        while len(left):
            s, w = state[left], word[left]
            at = np.searchsorted(self.arcs[:-1], s * self.n + w)
            arc = (self.arcs[at] == s * self.n + w) & (s > 0)
            done = left[arc]
            log[done] += self.weight[at[arc]]
            after[done] = self.to[at[arc]]
            home = left[s == 0]
            log[home] += self.root[word[home]]
            after[home] = self.home[word[home]]
            left = left[~arc & (s > 0)]
            log[left] += self.fail[state[left]]
            state[left] = self.fail_to[state[left]]
        return after, log

    def traverse(self, word: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 of each token's step.  Texts are read side by side, long ones in parts of STEPS tokens; a part begins in the state that the two tokens
        before it lead to, since no state knows more than two."""
        parts = -(-lengths // STEPS)
        text = np.repeat(np.arange(len(begin)), parts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        at, size = begin[text] + nth * STEPS, np.minimum(lengths[text] - nth * STEPS, STEPS)
        order = np.argsort(-size, kind="stable")
        at, size, nth = at[order], size[order], nth[order]
        state = np.where(nth == 0, self.start, 0)
        inner = np.flatnonzero(nth)
        for k in (2, 1):
            state[inner], _ = self.step(state[inner], word[at[inner] - k])
        out = np.zeros(len(word))
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t))  # parts with more than t tokens
            state[:n], out[at[:n] + t] = self.step(state[:n], word[at[:n] + t])
        return out


def _score(bases: list[int], texts: int, tokens: int, distinct: int, strengths: tuple[float, float]):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = {n: [] for n in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        if chunks.num_rows:
            c = _Chunk(chunks.to_pylist()[0])
            found = sorted(zip(answers["bucket"].to_pylist(), answers["totals"].to_pylist(), strict=True))
            counts = [np.concatenate([np.empty(0, np.int64), *(_numbers(t) for b, t in found if low <= b < high)]) for low, high in zip(bases[:-1], bases[1:], strict=True)]
            if [len(x) for x in counts] != [len(c.words), len(c.bigrams()[0]), len(c.trigrams()[0])]:
                raise ValueError("answers don't fit the chunk")
            a = Automaton(c, counts, texts, tokens, distinct, strengths)

            def by_text(x):
                return np.add.reduceat(x, c.begin) if len(x) else x

            out["doc_id"], out["held_out"], out["n_tokens"] = pa.array(c.ids, mask=~c.valid), c.held, c.lengths
            out["n_known"] = by_text((counts[0] > 0)[c.word].astype(np.int64))
            out["base_score"] = by_text(a.root[c.word])
            out["score"] = by_text(a.traverse(c.word, c.begin, c.lengths))
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({n: x if isinstance(x, pa.Array) else pa.array(x, k) for (n, x), k in zip(out.items(), kinds, strict=True)})

    return run


def score_texts(docs: DataFrame, held: Column | None = None, strengths: tuple[float, float] = STRENGTHS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. held: a condition over doc_id; rows where it isn't true train."""
    rows = pick(docs, doc_id=key, text=text).select(F.col("doc_id").cast("long"), "text", (held_out() if held is None else held).alias("held_out"))
    kind = "chunk long, ids binary, valid binary, held binary, lengths binary, texts binary, tokens long, train_texts long, train_tokens long"
    chunks = staged(rows.mapInArrow(_chunk, kind), "chunks")
    total, texts, tokens = chunks.agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("long") for n in ("tokens", "train_texts", "train_tokens"))).first()
    bits = max(0, (math.ceil(total / BUCKET_KEYS) - 1).bit_length())
    bases = [k << bits for k in range(4)]  # buckets of words, of bigrams, of trigrams
    answers = []
    for orders in ((1, 2), (3,)):
        requests = chunks.mapInArrow(_deal([(k, bases[k - 1], bits) for k in orders]), "bucket long, chunk long, keys binary, counts binary")
        answers.append(staged(requests.groupBy("bucket").applyInArrow(_total(bases[1]), "chunk long, bucket long, totals binary"), "answers"))
    distinct = sum(int(_numbers(bytes(r["totals"])).sum()) for r in answers[0].where("chunk IS NULL").toLocalIterator())  # a row a bucket of words
    told = answers[0].where("chunk IS NOT NULL").unionByName(answers[1])
    scored = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_score(bases, texts, tokens, distinct, strengths), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
