"""Vectorised word hashing over Arrow string buffers.

Words are runs of bytes other than space and 0x09-0x0D with A-Z folded to lower case.  Every word
becomes one 64-bit hash; a pair of different words collides with probability near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 256 << 10

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256)
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_BYTE = _stream(256, 11)[_FOLD]
_PLACE = _stream(4096, 977) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = _stream(1 << int(n - 1).bit_length(), 977) | np.uint64(1)
    return _PLACE


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def _piece(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a piece's words and the place where each word starts; starts: offsets at which a text begins."""
    word = ~_SPACE[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = starts[starts < len(buf)]
    first[starts] = word[starts]
    at = np.flatnonzero(word)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    head = np.flatnonzero(first[at])
    length = np.diff(np.append(head, len(at)))
    place = np.arange(len(at)) - np.repeat(head, length)
    value = _BYTE[buf[at]] * _places(int(length.max()))[place]
    return mix(np.add.reduceat(value, head) + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), at[head]


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text.  Works through pieces of bounded size."""
    n, out, counts = len(off) - 1, [], np.zeros(len(off) - 1, np.int64)
    row = 0
    with np.errstate(over="ignore"):
        while row < n:
            end = int(np.searchsorted(off, off[row] + PIECE_BYTES, side="right")) - 1
            if end > row:
                end = min(end, n)
                h, at = _piece(buf[off[row] : off[end]], off[row:end] - off[row])
                counts[row:end] = np.bincount(np.searchsorted(off[row + 1 : end + 1], at + off[row], side="right"), minlength=end - row)[: end - row]
                out.append(h)
                row = end
                continue
            a, stop = int(off[row]), int(off[row + 1])
            while a < stop:  # one long text: cut where a space is
                b = min(stop, a + PIECE_BYTES)
                while b < stop and not _SPACE[buf[b]]:
                    gap = np.flatnonzero(_SPACE[buf[b : min(stop, b + PIECE_BYTES)]])
                    b = b + int(gap[0]) if len(gap) else min(stop, b + PIECE_BYTES)
                h, _ = _piece(buf[a:b], np.zeros(1, np.int64))
                counts[row] += len(h)
                out.append(h)
                a = b
            row += 1
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), counts


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive hashes."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(m, n, np.uint64) * np.uint64(0x632BE59BD9B4E019)
        for k, c in enumerate(_stream(n, 31337) | np.uint64(1)):
            total += mix(hashes[k : k + m] + np.uint64(k + 1)) * c
        return mix(total)


def row_groups(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most limit bytes of text, or one row."""
    for batch in batches:
        _, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
        row, n = 0, batch.num_rows
        while row < n:
            end = min(n, max(row + 1, int(np.searchsorted(off, off[row] + limit, side="right")) - 1))
            yield batch.slice(row, end - row)
            row = end
