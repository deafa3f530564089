"""Operator 8: n-gram Jaccard self-join with adaptive multi-match prefixes, down to link components.

1. Every text becomes the set of its 64-bit shingle hashes; texts with the same set are one class, known by a 64-bit signature.
2. Each class's shingles are dealt out by hash in sorted blobs, and every bucket counts in how many classes its shingles occur
   (document frequency).  Shingles of one class can't be shared, so only the others come back to the classes; a class of which fewer
   than the threshold's share came back can't have a link and is done.
3. Shingles are ordered by (frequency, hash), unshared ones first.  A document with n shingles and least
   overlap t shares l of its first n - t + l with any partner.  For l = 1..MOST_MATCHES the cost is
   estimated from the frequencies (postings read, plus candidates left, at most postings / l, times the
   cost of a verification); the cheapest l is the document's.  A pair is a candidate when it shares
   min(l) within the prefixes that its own least overlap, by both sizes, leaves of these.
4. Links only matter between different components.  Rounds let each class verify one promising partner of another component found
   beside it in posting lists; components are rebuilt; once a round finds little, every candidate pair that still crosses components
   is verified.  No link between components is lost and no group's pairs are listed.

Verification counts the shared hashes exactly: 100 * |A & B| >= percent * |A | B|.

Skew.  A chunk of texts deals a set once however many copies it holds, and a class with more than one text in 2**HOT_BITS is dealt by the
chunk of its representative alone.  A shingle that LOCAL sets of one chunk have in common and that makes up one in 2**HOT_BITS of
all shingles is known to be shared beforehand: it goes straight to the classes, not to its bucket.  Both lists are bounded by
2**HOT_BITS entries, so they are broadcast.  Their frequencies need only agree everywhere, since they set an order.  In the last pass a
posting list is joined in blocks of LIST_ROWS rows, and never its largest component with itself.

Texts are tokenised twice, for the signatures and to be dealt out: that costs less than storing eight bytes a shingle between.

Null or wordless texts have an empty set, link with nothing and are their own component.  Texts shorter than the shingle are one
shingle.  Rows with null doc_id are reported but take no part in links.  Rows of one doc_id are one document: their texts are compared
each for itself and belong to one component.  Empty tables give an empty result; ties are broken by doc_id; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .components import components
from .packed import pack, unpack
from .store import free, pick, staged
from .words import combine, mix, row_groups, text_buffer, word_hashes

SHINGLE, PERCENT, MOST_MATCHES = 5, 75, 8
CHUNK_BYTES = 8 << 20
BUCKET_KEYS = 1 << 20
LIST_ROWS = 2_000
LOCAL, HOT_BITS = 8, 18
PACKAGE = "bucket long, keys binary, docs binary, ids binary, dfs binary"


def shingle_sets(column, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, counts = word_hashes(*text_buffer(column))
    at = 0
    for n in counts.tolist():
        own = hashes[at : at + n]
        at += n
        if n >= size:
            yield np.unique(combine(own, size))
        elif n:
            yield combine(own, n) ^ np.uint64(n)
        else:
            yield np.empty(0, np.uint64)


def _sums(s: np.ndarray) -> tuple[int, int, int]:
    with np.errstate(over="ignore"):
        return len(s), int(s.sum(dtype=np.uint64).astype(np.int64)), int(mix(s).sum(dtype=np.uint64).astype(np.int64))


def signature(n, one, two, again: frozenset | set = frozenset()) -> int:
    """A set's 64-bit name from its size and its two sums; those that two sets have in common (again) give way to a second one."""
    with np.errstate(over="ignore"):
        a, b = np.array([one, two], np.int64).view(np.uint64)[:, None]
        out = int(mix(mix(a + np.uint64(n)) ^ b).view(np.int64)[0])
        return out if out not in again else int(mix(mix(b + np.uint64(n)) + a).view(np.int64)[0])


def _facts(size: int):
    """Rows (place, doc_id, n, one, two, sig) of documents and, with a null n, rows (one: shingle, two: sets) of what many sets of a chunk share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "doc_id", "n", "one", "two", "sig"]
        for batch in row_groups(batches, "text", CHUNK_BYTES):
            sums, distinct = [], {}
            valid = batch.column("doc_id").is_valid().to_pylist()
            for ok, s in zip(valid, shingle_sets(batch.column("text"), size), strict=True):
                sums.append(_sums(s))
                if ok and len(s):
                    distinct[sums[-1]] = s
            n, one, two = (pa.array(x, pa.int64()) for x in zip(*sums, strict=True))
            sigs = pa.array([signature(*x) for x in sums], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("doc_id"), n, one, two, sigs], names=names)
            if len(distinct) >= LOCAL:
                keys, count = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                keys, count = keys[count >= LOCAL].view(np.int64), count[count >= LOCAL]
                none = pa.nulls(len(keys), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array(keys), pa.array(count.astype(np.int64)), none], names=names)

    return run


def _packages(ids: np.ndarray, sets: list[np.ndarray], bits: int, hot: np.ndarray | None = None, dfs: np.ndarray | None = None, lane: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, keys, docs, ids, dfs): the shingles of distinct sets of a chunk that fall into a bucket, each with its set's place among those
    ids that the row has.  Shingles that are hot go to the bucket that lane names, beyond the others, with their frequencies."""
    order = np.argsort(ids)
    ids, place = ids[order], np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    keys = np.concatenate(sets)
    docs = np.repeat(place, [len(s) for s in sets])
    by = np.argsort(keys, kind="stable")
    keys, docs = keys[by], docs[by]
    rows = []

    def add(bucket, k, d, known):
        present, at = np.unique(d, return_inverse=True)
        width = np.uint8 if len(present) <= 1 << 8 else np.uint16 if len(present) <= 1 << 16 else np.uint32
        rows.append((bucket, pack(k), at.astype(width).tobytes(), pack(ids[present]), known))

    if hot is not None and len(hot):
        at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        known = hot[at] == keys
        if known.any():
            add((1 << bits) + lane, keys[known], docs[known], dfs[at[known]].astype(np.uint32).tobytes())
            keys, docs = keys[~known], docs[~known]
    bounds = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() if bits else []
    for b, (x, y) in enumerate(zip([0, *bounds], [*bounds, len(keys)], strict=True)):
        if y > x:
            add(b, keys[x:y], docs[x:y], None)
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    for k in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[k : k + 256], strict=True), kinds, strict=True)], names=["bucket", "keys", "docs", "ids", "dfs"])


def _deal(bits: int, size: int, shared):
    """The shingles of each chunk's distinct sets, dealt out by hash.  shared: hot shingles with frequencies, hot classes with representatives, signatures met twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, dfs, classes, again = shared.value
        for batch in row_groups(batches, "text", CHUNK_BYTES):
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            distinct = {}
            for doc, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), size), strict=True):
                if len(s):
                    sig = signature(*_sums(s), again)
                    if classes.get(sig, doc) == doc:
                        distinct[sig] = s
            if distinct:
                ids = np.array(list(distinct), np.int64).view(np.uint64)
                yield from _packages(ids, list(distinct.values()), bits, hot, dfs, int(ids.min() % np.uint64(1 << bits)))

    return run


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _crowd(ids: np.ndarray, crowds: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(ids.view(np.uint64) + np.uint64(3)) % np.uint64(crowds)).astype(np.int64)


def _count(crowds: int):
    """Of a bucket: rows (crowd, ids, keys, dfs) with the shingles that more than one class has, dealt by class."""

    def run(table: pa.Table) -> pa.Table:
        keys, ids, given = [], [], []
        for k, docs, present, dfs in zip(*(table[c].to_pylist() for c in ("keys", "docs", "ids", "dfs")), strict=True):
            k, present = unpack(k), unpack(present)
            keys.append(k)
            ids.append(present[np.frombuffer(docs, f"u{len(docs) // len(k)}")])
            given.append(np.frombuffer(dfs, np.uint32) if dfs is not None else np.zeros(len(k), np.uint32))
        keys, ids, given = np.concatenate(keys), np.concatenate(ids), np.concatenate(given)
        order = np.lexsort((ids, keys))
        keys, ids, given = keys[order], ids[order], given[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))  # copies in other chunks count once
        keys, ids, given = keys[new], ids[new], given[new]
        df = np.diff(np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys)))
        each = np.maximum(np.repeat(df, df), given).astype(np.uint32)
        shared = each > 1
        keys, ids, each = keys[shared], ids[shared], each[shared]
        crowd = _crowd(ids, crowds)
        order = np.argsort(crowd, kind="stable")
        keys, ids, each, crowd = keys[order], ids[order], each[order], crowd[order]
        at = np.flatnonzero(np.diff(crowd, prepend=-1))
        ends = [*at[1:].tolist(), len(crowd)][: len(at)]
        cut = [[x[a:b].tobytes() for a, b in zip(at.tolist(), ends, strict=True)] for x in (ids, keys, each)]
        return pa.table({"crowd": pa.array(crowd[at], pa.int64()), **{n: pa.array(x, pa.binary()) for n, x in zip(("ids", "keys", "dfs"), cut, strict=True)}})

    return run


def _gather(percent: int):
    """Of a crowd of classes: those with enough shared shingles, as rows (doc, n, tokens, dfs) in the global order."""

    def run(classes: pa.Table, shared: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if classes.num_rows and shared.num_rows:
            known, sizes = classes["sig"].to_numpy(), classes["n"].to_numpy()
            by = np.argsort(known)
            known, sizes = known[by], sizes[by]
            ids = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in shared["ids"]])
            keys = np.concatenate([np.frombuffer(b.as_py(), np.uint64) for b in shared["keys"]])
            dfs = np.concatenate([np.frombuffer(b.as_py(), np.uint32) for b in shared["dfs"]])
            order = np.lexsort((keys, dfs, ids))
            ids, keys, dfs = ids[order], keys[order], dfs[order]
            new = np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))  # a hot shingle comes from every chunk that has a copy
            ids, keys, dfs = ids[new], keys[new], dfs[new]
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(ids)], strict=True):
                n = int(sizes[np.searchsorted(known, ids[a])])
                if 100 * (b - a) >= percent * n:
                    for x, v in zip(out, (int(ids[a]), n, keys[a:b].tobytes(), dfs[a:b].tobytes()), strict=True):
                        x.append(v)
        return pa.table({"doc": pa.array(out[0], pa.int64()), "n": pa.array(out[1], pa.int64()), "tokens": pa.array(out[2], pa.binary()), "dfs": pa.array(out[3], pa.binary())})

    return run


def prefix(n: int, dfs: np.ndarray, percent: int = PERCENT, most: int = MOST_MATCHES) -> tuple[int, np.ndarray]:
    """The matches l to ask of a document with n shingles, and the places from 0, unshared shingles first, of the shared ones in its prefix.

    dfs: frequencies of its shared shingles in order.
    """
    t = -(-percent * n // 100)
    alone = n - len(dfs)
    total = np.cumsum(dfs, dtype=np.float64)
    best, cheapest = 1, math.inf
    for matches in range(1, min(most, t) + 1):
        read = float(total[min(n - t + matches - alone, len(dfs)) - 1]) if n - t + matches > alone else 0.0
        cost = read + read / matches * (1 + n / 64)
        if cost < cheapest:
            best, cheapest = matches, cost
    end = max(0, min(n - t + best - alone, len(dfs)))
    return best, np.arange(alone, alone + end)


def _postings(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = ([], [], [], [], [], [])
            for doc, n, tokens, dfs in zip(*(batch.column(c).to_pylist() for c in ("doc", "n", "tokens", "dfs")), strict=True):
                dfs = np.frombuffer(dfs, np.uint32)
                matches, at = prefix(n, dfs, percent)
                m = len(at)
                for x, v in zip(out, (np.frombuffer(tokens, np.int64)[:m], np.full(m, doc), np.full(m, n), at, np.full(m, matches), dfs[:m]), strict=True):
                    x.append(v)
            if out[0]:
                kinds = (np.int64, np.int64, np.int64, np.int32, np.int32, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(k)) for x, k in zip(out, kinds, strict=True)], names=["token", "doc", "n", "at", "matches", "df"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 256):
            ok = []
            for nx, ny, a, b in zip(*(batch.column(c).to_pylist() for c in ("nx", "ny", "tx", "ty")), strict=True):
                both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                ok.append(100 * both >= percent * (nx + ny - both))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(ok, pa.bool_())], names=["x", "y", "ok"])

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(x, y) with the truth of their link."""
    one = sets.select(F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("tx"))
    two = sets.select(F.col("doc").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("ty"))
    return staged(pairs.join(one, "x").join(two, "y").select("x", "y", "nx", "ny", "tx", "ty").mapInArrow(_verify(percent), "x long, y long, ok boolean"), "verified")


def _fits(x: dict, y: dict, percent: int):
    """Whether a shared shingle counts for a pair: sizes that can link, and a place within both prefixes of the pair's own least overlap.

    Two sets of n and m shingles that link share o >= percent * (n + m) / (100 + percent); of l shared ones among the first n - o + l
    and m - o + l in order there are l at least.
    """
    sizes = (100 * x["n"] >= percent * y["n"]) & (100 * y["n"] >= percent * x["n"])
    overlap = F.ceil(percent * (x["n"] + y["n"]) / (100 + percent))
    return sizes & (F.greatest(x["at"] - x["n"], y["at"] - y["n"]) + overlap < F.least(x["matches"], y["matches"]))


def _partners(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """For each class the class of another component that most often stands before it, or first, in its posting lists."""
    lane = [F.col("token"), F.when(F.col("df") > 2 * LIST_ROWS, F.pmod(F.xxhash64("doc", "token"), F.ceil(F.col("df") / LIST_ROWS))).otherwise(F.lit(0)).alias("salt")]
    rows = lists.select("doc", "n", "at", "matches", "component", *lane).withColumn("turn", F.xxhash64(F.lit(turn), "component", "doc") if turn else F.col("doc"))
    w = W.partitionBy("token", "salt").orderBy("turn", "doc")
    own = F.struct("doc", "n", "at", "matches", "component")
    near = rows.select(own.alias("x"), F.lag(own).over(w).alias("near"), F.first(own).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("head"))
    near = near.select("x", F.explode(F.array_distinct(F.array("near", "head"))).alias("y")).where((F.col("x.component") != F.col("y.component")) & _fits(F.col("x"), F.col("y"), percent))
    near = near.select(F.col("x.doc").alias("doc"), F.col("y.doc").alias("other"))
    seen = near.groupBy("doc", "other").agg(F.count("*").alias("hits"))
    best = seen.groupBy("doc").agg(F.max(F.struct("hits", (-F.col("other")).alias("o"))).alias("b"))
    return best.select(F.least("doc", -F.col("b.o")).alias("x"), F.greatest("doc", -F.col("b.o")).alias("y")).distinct()


def _prefixes(percent: int):
    """(doc, alone, prefix): how many unshared shingles a class has, and the shared ones of its prefix in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            alone, out = [], []
            for n, tokens, dfs in zip(*(batch.column(c).to_pylist() for c in ("n", "tokens", "dfs")), strict=True):
                dfs = np.frombuffer(dfs, np.uint32)
                alone.append(n - len(dfs))
                out.append(np.frombuffer(tokens, np.int64)[: len(prefix(n, dfs, percent)[1])])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(alone, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["doc", "alone", "prefix"])

    return run


def _crossing(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs of different components, each once: at the last of the shingles that it must share within its prefixes.

    Of two classes in different components one at least isn't in the largest component of a list they share.  So the others of a list (y)
    meet all of it (x), both in blocks of about LIST_ROWS rows.
    """
    whole = sets.join(lists.select("doc").distinct(), "doc", "left_semi").mapInArrow(_prefixes(percent), "doc long, alone long, prefix array<long>")
    blocks = F.ceil(F.col("df") / LIST_ROWS)
    rows = lists.withColumn("i", F.pmod(F.xxhash64("doc"), blocks))
    parts = rows.groupBy("token", "component").agg(F.count("*").alias("c"), F.max("df").alias("df"))
    tops = parts.groupBy("token").agg(F.sum("c").alias("all"), F.max(F.struct("c", "component")).alias("top"), F.max("df").alias("df"))
    tops = tops.select("token", F.col("top.component").alias("most"), F.ceil((F.col("all") - F.col("top.c")) / LIST_ROWS).alias("others"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("i"))
    rows = rows.join(tops, ["token", "i"]).join(whole, "doc")
    own = F.struct("doc", "n", "at", "matches", "component", "alone", "prefix")
    x = rows.select("token", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("j"), (F.col("component") == F.col("most")).alias("mainly"), own.alias("x"))
    y = rows.where("component <> most").select("token", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("i"), F.pmod(F.xxhash64(F.lit(7), "doc"), F.col("others")).alias("j"), own.alias("y"))
    one, two = F.col("x"), F.col("y")
    need = F.least(one["matches"], two["matches"])
    overlap = F.ceil(percent * (one["n"] + two["n"]) / (100 + percent))

    def within(d):
        return F.slice(d["prefix"], F.lit(1), F.greatest(d["n"] - overlap + need - d["alone"], F.lit(0)).cast("int"))

    apart = (one["component"] != two["component"]) & (F.col("mainly") | (one["doc"] < two["doc"]))
    last = F.get(F.array_intersect(within(one), within(two)), need - 1) == F.col("token")
    return x.join(y, ["token", "i", "j"]).where(apart & _fits(one, two, percent) & last).select(F.least(one["doc"], two["doc"]).alias("x"), F.greatest(one["doc"], two["doc"]).alias("y"))


def _placed(crowds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:  # as in _count, done once a class
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_crowd(b.column("sig").to_numpy(), crowds))], names=["sig", "n", "crowd"])

    return run


def _hot(facts: DataFrame, total: int):
    """The bounded lists that dealing needs: hot shingles in order and their frequencies, hot classes by signature, signatures of two sets."""
    keys = facts.where("n IS NULL").groupBy("one").agg(F.sum("two").alias("df")).where(F.col("df") * (1 << HOT_BITS) >= total).toArrow()  # 2**HOT_BITS rows at most
    held = facts.where("n > 0 AND doc_id IS NOT NULL")
    again = held.groupBy("sig").agg(F.countDistinct("n", "one", "two").alias("k")).where("k > 1").toArrow()  # about rows**2 / 2**65 of them
    docs = facts.where("n IS NOT NULL").count()
    many = held.groupBy("n", "one", "two").agg(F.count("*").alias("c"), F.min("doc_id").alias("class_id")).where((F.col("c") > 1) & (F.col("c") * (1 << HOT_BITS) >= docs)).toArrow()  # 2**HOT_BITS rows at most
    again = frozenset(again["sig"].to_pylist())
    order = np.argsort(keys["one"].to_numpy().view(np.uint64))
    classes = {signature(r["n"], r["one"], r["two"], again): r["class_id"] for r in many.to_pylist()}
    return keys["one"].to_numpy().view(np.uint64)[order], np.minimum(keys["df"].to_numpy()[order], (1 << 32) - 1), classes, again


def link_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", key: str = "doc_id", rounds: int | None = None, place: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id (smallest doc_id with the same set).

    rounds: at most as many before the exact pass; by default as long as a tenth of what a round verifies are links.
    place: a column that tells rows apart, given back as place.
    """
    spark = docs.sparkSession
    texts = pick(docs, doc_id=key, text=text, **({"place": place} if place else {}))
    texts = texts.select(F.col("place").cast("long") if place else F.lit(None).cast("long").alias("place"), F.col("doc_id").cast("long"), "text")
    found_facts = staged(texts.mapInArrow(_facts(size), "place long, doc_id long, n long, one long, two long, sig long"), "facts")
    facts = found_facts.where("n IS NOT NULL")
    total = facts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = _hot(found_facts, total)
    if hot[3]:
        named = F.udf(lambda n, one, two: signature(n, one, two, hot[3]), "long")  # of the few rows with such a signature
        facts = facts.withColumn("sig", F.when(F.col("sig").isin(*hot[3]), named("n", "one", "two")).otherwise(F.col("sig")))
    held = facts.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(held.groupBy("sig", "n").agg(F.min("doc_id").alias("class_id")), "classes")
    crowds = max(1, math.ceil(total / BUCKET_KEYS))
    bits = max(0, (crowds - 1).bit_length())
    packages = texts.select("doc_id", "text").mapInArrow(_deal(bits, size, spark.sparkContext.broadcast(hot)), PACKAGE)
    counted = packages.groupBy("bucket").applyInArrow(_count(crowds), "crowd long, ids binary, keys binary, dfs binary")
    placed = classes.select("sig", "n").mapInArrow(_placed(crowds), "sig long, n long, crowd long")
    sets = staged(placed.groupBy("crowd").cogroup(counted.groupBy("crowd")).applyInArrow(_gather(percent), "doc long, n long, tokens binary, dfs binary"), "sets")
    lists = staged(sets.mapInArrow(_postings(percent), "token long, doc long, n long, at int, matches int, df long"), "postings")
    tested = spark.createDataFrame([], "x long, y long")
    # texts of one doc_id are one document
    several = held.groupBy("doc_id").agg(F.min("sig").alias("least"), F.max("sig").alias("most")).where("least <> most")
    found = components(held.join(several, "doc_id").select(F.col("sig").alias("x"), F.col("least").alias("y")))
    turn, exact, old = 0, rounds == 0, lists
    while True:
        # a list within one component leads nowhere, now or later
        placed = lists.join(found, lists["doc"] == found["node"], "left").select("token", "doc", "n", "at", "matches", "df", F.coalesce("component", "doc").alias("component"))
        mixed = placed.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("token")
        placed = staged(placed.join(mixed, "token", "left_semi"), "lists")
        free(old)
        old, lists = placed, placed.drop("component")
        pairs = _crossing(placed, sets, percent) if exact else _partners(placed, turn, percent)
        verified = _links(pairs.join(tested, ["x", "y"], "left_anti"), sets, percent)
        seen, linked = verified.agg(F.count("*"), F.count_if("ok")).first()
        if linked:
            # an edge from each node to its component stands for all earlier links
            found = components(found.select(F.col("node").alias("x"), F.col("component").alias("y")).unionByName(verified.where("ok").select("x", "y")))
        if exact:
            break
        turn += 1
        exact = linked * 10 < seen or not linked or turn == rounds
        tested = tested.unionByName(verified.select("x", "y"))
    named = classes.join(found, classes["sig"] == found["node"], "left").select("sig", "class_id", F.coalesce("component", "sig").alias("component"))
    least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "component").select("sig", "class_id", "component_id")
    facts = facts.withColumn("held", (F.col("n") > 0) & F.col("doc_id").isNotNull())
    facts = facts.withColumn("sig", F.when(F.col("held"), F.col("sig")).otherwise(F.monotonically_increasing_id()))  # rows without a class needn't meet
    rows = facts.join(named.withColumn("held", F.lit(True)), ["sig", "held"], "left")
    more = ["place"] if place else []
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"), *more)
