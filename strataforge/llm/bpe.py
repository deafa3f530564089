"""Operator 1: exact byte-pair encoding by backtracking, and decoding through an offset table.

Text is split by the tokenizer's pattern.  An Aho-Corasick automaton over the vocabulary reports all
tokens in a piece in one pass, which gives the longest token at every byte.  The encoder walks from the
left with these longest matches; a token may follow another only if the pair is compatible, that is, if
the merges of the two tokens' bytes would leave exactly these two.  Where it may not, the next shorter
token is tried, then the last token is taken back; a bit per byte forbids a dead end twice, so the work
is linear.  The result is that of applying all merges by rank.

Pieces repeat, so each worker keeps the codes of a bounded number of short pieces; this changes no result.

Null texts encode as empty, as do empty ones; texts of any length are encoded whole; strings of added
tokens become their ids.  Ids outside the vocabulary decode to nothing, bytes that are no UTF-8 to U+FFFD.
Rows are independent: ties, repeats, empty tables and further columns pass through; a column named like an
output is replaced by it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import without
from .words import row_groups

#: Fixed value: the splitting pattern that byte-level BPE vocabularies of this kind are used with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_PARTS, CACHE_PIECES, CACHE_CHARS = 400_000, 200_000, 48
GROUP_BYTES = 2 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files of byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    return letters


class _Spaces(Exception):
    """White space stands beside a space, so that splitting at spaces isn't enough."""


class _Parts(dict):
    """Codes of what stands between two spaces, the first of them included."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, part: str) -> tuple[int, ...]:
        if not part or part[0].isspace() or part[-1].isspace():
            raise _Spaces
        codes = tuple(self.codec._split(" " + part))
        if len(part) <= CACHE_CHARS and len(self) < CACHE_PARTS:
            self[part] = codes
        return codes


class Codec:
    """Encoder and decoder of one vocabulary file's content."""

    def __init__(self, content: str):
        model = json.loads(content)
        letters = byte_letters()
        vocab, added = model["model"]["vocab"], {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for word, k in vocab.items():
            if word not in added:
                self.tokens[k] = bytes(letters[c] for c in word)
        ids = {t: k for k, t in enumerate(self.tokens) if t}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        rank = {k: -1 for k in self.byte_id}
        self.pair: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int] | None] = [None] * size
        for r, m in enumerate(model["model"]["merges"]):
            a, b = (vocab[x] for x in (m if isinstance(m, list) else m.split(" ")))
            whole = ids[self.tokens[a] + self.tokens[b]]
            if (a, b) not in self.pair:
                self.pair[a, b] = whole
                if whole not in rank:
                    rank[whole], self.halves[whole] = r, (a, b)
        self.rank = rank
        self.shorter = [next((ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ids), -1) for t in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for t, k in ids.items():
            if k in rank:
                self.automaton.add_word(t.decode("latin-1"), (len(t), k))
        self.automaton.make_automaton()
        self.table: dict[int, bool] = {}
        self.added = added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.pattern = regex.compile(PATTERN)
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.parts = _Parts(self)
        shown = [(t.encode() if (t := next((w for w, j in added.items() if j == k), None)) else self.tokens[k]) for k in range(size)]
        self.length = np.array([*(len(t) for t in shown), 0], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b by rank leaves a and b: no merge across their border comes first."""
        key = a << 20 | b
        if (known := self.table.get(key)) is None:
            if len(self.table) > 2_000_000:
                self.table.clear()
            known = self.table[key] = self._survives(a, b)
        return known

    def _survives(self, a: int, b: int) -> bool:
        # Undo merges from the last on. At each step the halves at the border are those present when `limit` was next;
        # a merge of the two that ranks before the merges that built what stands there would have been done.
        rank, pair, halves = self.rank, self.pair, self.halves
        limit, left, right = float("inf"), a, b
        while True:
            joined = pair.get((left, right))
            if joined is not None and rank[joined] < limit:
                return False
            ra, rb = rank[left], rank[right]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:  # the left one was built last; at equal ranks the left place is merged first
                limit, left = ra, halves[left][1]
            else:
                limit, right = rb + 1, halves[right][0]

    def encode_piece(self, data: bytes) -> list[int]:
        n = len(data)
        if n == 1:
            return [self.byte_id[data[0]]]
        longest, reach = [-1] * n, [0] * n
        for end, (size, k) in self.automaton.iter(data.decode("latin-1")):
            start = end - size + 1
            if size > reach[start]:
                reach[start], longest[start] = size, k
        tokens, shorter, compatible = self.tokens, self.shorter, self.compatible
        free = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + len(tokens[token])
            if free[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                free[at] = 0  # nothing fits here: the last token is taken back and tried again, now with its end forbidden
                token = out.pop()
                at -= len(tokens[token])

    def _split(self, text: str) -> list[int]:
        pieces, out = self.pieces, []
        for piece in self.pattern.findall(text):
            codes = pieces.get(piece)
            if codes is None:
                codes = tuple(self.encode_piece(piece.encode()))
                if len(piece) <= CACHE_CHARS and len(pieces) < CACHE_PIECES:
                    pieces[piece] = codes
            out += codes
        return out

    def _plain(self, text: str) -> list[int]:
        parts = text.split(" ")
        try:  # the pattern splits before any space that stands between two other characters than white space
            first = parts[0]
            if not first or first[-1].isspace():
                raise _Spaces
            return [*self._split(first), *chain.from_iterable(map(self.parts.__getitem__, islice(parts, 1, None)))]
        except _Spaces:
            return self._split(text)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.split_added is None or not any(t in text for t in self.added):
            return self._plain(text)
        out: list[int] = []
        for k, part in enumerate(self.split_added.split(text)):
            if k % 2:
                out.append(self.added[part])
            elif part:
                out += self._plain(part)
        return out

    def decode_rows(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of rows of ids that lie one after another; ends: where each row's ids end."""
        known = (ids >= 0) & (ids < len(self.length) - 1)
        ids = ids if known.all() else np.where(known, ids, len(self.length) - 1)
        size = self.length[ids]
        stop = np.cumsum(size)
        # place of each output byte in the table: its token's offset plus its place in the token
        at = np.repeat(self.offset[ids] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)
        data = self.bytes[at].tobytes()
        bounds = np.concatenate([[0], stop])[np.concatenate([[0], ends])].tolist()
        return [data[a:b].decode("utf-8", errors="replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return self.decode_rows(ids, np.array([len(ids)]))[0]


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    content = shared.value
    key = hash(content)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(content)
    return _CODECS[key]


def _append(df: DataFrame, function, names: list[tuple[str, str]]) -> DataFrame:
    df = without(df, *[n for n, _ in names])
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields), *(f"`{n}` {t}" for n, t in names)])
    return df.mapInArrow(function, schema)


def _with(batch: pa.RecordBatch, more: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])


def _lists(rows: list[list[int]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The rows as an array of lists, their values and where each row ends in these."""
    ends = np.cumsum([len(r) for r in rows])
    values = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values)), values, ends


def shared_vocabulary(df: DataFrame, path: str):
    """The vocabulary file (a few MB, fixed by the tokenizer) read by the driver and broadcast: executors need no copy of it."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with an array<int> of the text's token ids."""
    shared = shared_vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in row_groups(batches, text, GROUP_BYTES):
            yield _with(batch, [_lists([codec.encode(t) for t in batch.column(text).to_pylist()])[0]], [ids])

    return _append(df, run, [(ids, "array<int>")])


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the text that an array<int> of token ids stands for; a null array gives an empty text."""
    shared = shared_vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            yield _with(batch, [pa.array([codec.decode(r.values.to_numpy(zero_copy_only=False) if r.is_valid else []) for r in batch.column(ids)], pa.string())], [out])

    return _append(df, run, [(out, "string")])


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encode() and decode() in one pass over the rows."""
    shared = shared_vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in row_groups(batches, text, GROUP_BYTES):
            lists, values, ends = _lists([codec.encode(t) for t in batch.column(text).to_pylist()])
            yield _with(batch, [lists, pa.array(codec.decode_rows(values, ends), pa.string())], [ids, decoded])

    return _append(df, run, [(ids, "array<int>"), (decoded, "string")])


def digests(df: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of rows with ids and decoded."""
    return df.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256),
        "decoded_sha256": F.sha2(F.col("decoded"), 256),
    })
