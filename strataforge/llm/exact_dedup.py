"""Operator 6: exact de-duplication against a minimal perfect hash over historical distinct digests.

Rows up to a cut in doc_id are history, the rest are new.  History is reduced to distinct SHA-256
digests, dealt into shards by digest prefix, and every shard gets a minimal perfect hash (levels of
collision-free bits, ranked) whose slots hold the full digest and the locator of the winner.  New
digests probe their shard's slot and are accepted only when all 32 bytes agree; digests that are no
members form groups of their own.

Of equal texts exactly one row stays: one with the largest doc_id and, where several rows have that one, the last of them by a number that
tells rows apart (their texts are equal too, so it is no matter which).

Nulls in the text count as empty; empty texts are equal to each other; rows with a null doc_id never win over a row that has one,
and of such rows alone one stays; an empty table gives an empty result; repeated
rows (same doc_id and text) each count.  Extra columns are ignored whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import pick, staged
from .words import mix

SHARD_DIGESTS = 100_000
#: Groups of this many rows are joined by broadcast; with the second bound there are at most MAX_HOT of them.
HOT_ROWS, MAX_HOT = 1_000, 10_000
_NONE = np.iinfo(np.int64).min


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, one per key that met no other."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.base = np.cumsum([0, *(int(b.sum()) for b in bits)])
        self.rank = [np.cumsum(b) - b for b in bits]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(keys + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, level = [], 0
        while len(keys):
            if level > 200:
                raise ValueError("keys are not distinct")
            size = max(1, int(1.6 * len(keys)))
            slot = cls._slot(keys, level, size)
            alone = np.bincount(slot, minlength=size) == 1
            bits.append(alone.astype(np.int64))
            keys = keys[~alone[slot]]
            level += 1
        return cls(bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has a bit. A key outside the set may get a slot: compare what it holds."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, b in enumerate(self.bits):
            slot = self._slot(keys[open_], level, len(b))
            hit = b[slot] == 1
            out[open_[hit]] = self.base[level] + self.rank[level][slot[hit]]
            open_ = open_[~hit]
        return out

    def dump(self) -> bytes:
        return b"".join(np.int64(len(b)).tobytes() + np.packbits(b.astype(np.uint8)).tobytes() for b in self.bits)

    @classmethod
    def load(cls, blob: bytes) -> PerfectHash:
        bits, at = [], 0
        while at < len(blob):
            n = int(np.frombuffer(blob, np.int64, 1, at)[0])
            m = (n + 7) // 8
            bits.append(np.unpackbits(np.frombuffer(blob, np.uint8, m, at + 8), count=n).astype(np.int64))
            at += 8 + m
        return cls(bits)


def _digests(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)


def _keys(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests[:, 8:16]).view(np.uint64).ravel()


def _longs(table: pa.Table, name: str) -> np.ndarray:
    return table[name].fill_null(_NONE).to_numpy()


def _build(table: pa.Table) -> pa.Table:
    digests, winner, row, n = _digests(table), *(_longs(table, c) for c in ("winner", "row", "n"))
    mph = PerfectHash.build(_keys(digests))
    slot = mph.find(_keys(digests))
    order = np.argsort(slot)
    return pa.table({
        "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
        "mph": pa.array([mph.dump()], pa.binary()),
        "slots": pa.array([digests[order].tobytes()], pa.binary()),
        "winners": pa.array([winner[order].tobytes()], pa.binary()),
        "rows": pa.array([row[order].tobytes()], pa.binary()),
        "counts": pa.array([n[order].tobytes()], pa.binary()),
    })


def _groups(digests: np.ndarray, keep: np.ndarray, row: np.ndarray, n: np.ndarray) -> pa.Table:
    some = np.flatnonzero(n > 1)
    return pa.table({
        "digest": pa.array([digests[i].tobytes() for i in some], pa.binary()),
        "keep_id": pa.array(keep[some], pa.int64(), mask=keep[some] == _NONE),
        "keep_row": pa.array(row[some], pa.int64()),
        "group_size": pa.array(n[some], pa.int64()),
    })


def _probe(new: pa.Table, history: pa.Table) -> pa.Table:
    """Groups of more than one row of a shard."""
    if not history.num_rows:
        return _groups(_digests(new), *(_longs(new, c) for c in ("winner", "row", "n")))
    mph = PerfectHash.load(history["mph"][0].as_py())
    slots = np.frombuffer(history["slots"][0].as_py(), np.uint8).reshape(-1, 32)
    winner, row, count = (np.frombuffer(history[c][0].as_py(), np.int64).copy() for c in ("winners", "rows", "counts"))
    if not new.num_rows:
        return _groups(slots, winner, row, count)
    digests, own, its, n = _digests(new), *(_longs(new, c) for c in ("winner", "row", "n"))
    slot = mph.find(_keys(digests))
    member = slot >= 0
    member[member] = (slots[slot[member]] == digests[member]).all(axis=1)
    at = slot[member]  # distinct: the probing digests are
    after = (own[member] > winner[at]) | ((own[member] == winner[at]) & (its[member] > row[at]))
    winner[at], row[at] = np.where(after, own[member], winner[at]), np.where(after, its[member], row[at])
    count[at] += n[member]
    return pa.concat_tables([_groups(slots, winner, row, count), _groups(digests[~member], own[~member], its[~member], n[~member])])


def exact_dedup(docs: DataFrame, history_share: float = 0.5, text: str = "text", key: str = "doc_id", place: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. place: a column that tells rows apart, given back as place."""
    more = ["place"] if place else []
    rows = pick(docs, doc_id=key, text=text, **({"place": place} if place else {}))
    rows = rows.select(F.col("doc_id").cast("long"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), F.monotonically_increasing_id().alias("row"), *more)
    rows = staged(rows, "digests")
    total, cut = rows.agg(F.count("*"), F.percentile_approx("doc_id", history_share, 10_000)).first()
    cut = cut if cut is not None else 0
    shards = max(1, math.ceil(total / SHARD_DIGESTS))
    shard = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")
    old = F.coalesce(F.col("doc_id") <= cut, F.lit(True))

    def distinct(which):
        best = rows.where(which).groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("n"))
        return best.select("digest", F.col("best.doc_id").alias("winner"), F.col("best.row").alias("row"), "n", shard.alias("shard"))

    index = distinct(old).groupBy("shard").applyInArrow(_build, "shard int, mph binary, slots binary, winners binary, rows binary, counts binary")
    groups = staged(distinct(~old).groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe, "digest binary, keep_id long, keep_row long, group_size long"), "groups")
    bound = max(HOT_ROWS, math.ceil(total / MAX_HOT))
    hot = F.broadcast(groups.where(F.col("group_size") >= bound))  # at most MAX_HOT rows of 56 bytes
    out = rows.join(hot, "digest").unionByName(rows.join(hot.select("digest"), "digest", "left_anti").join(groups.where(F.col("group_size") < bound), "digest", "left"))
    grouped = F.col("group_size").isNotNull()
    return out.select(
        "doc_id",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (~grouped | F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *more,
    )
