"""Sorted 64-bit keys as blobs: the first key, then differences of as few bytes as the largest needs."""

from __future__ import annotations

import numpy as np


def pack(keys: np.ndarray) -> bytes:
    keys = np.ascontiguousarray(keys, np.uint64)
    if not len(keys):
        return b""
    step = np.diff(keys)
    width = max(1, (int(step.max()).bit_length() + 7) // 8) if len(step) else 1
    return bytes([width]) + keys[:1].tobytes() + np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    width, body = blob[0], np.frombuffer(blob, np.uint8, offset=9)
    out = np.zeros((len(body) // width + 1, 8), np.uint8)
    out[1:, :width] = body.reshape(-1, width)
    out = out.view(np.uint64).ravel()
    out[0] = np.frombuffer(blob, np.uint64, 1, 1)[0]
    return np.cumsum(out, dtype=np.uint64)
