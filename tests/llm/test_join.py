"""The n-gram join where tables are odd or skewed."""

import random

import numpy as np
import pytest
from test_results import brute_components

from strataforge.llm import ngram_join

SCHEMA = "doc_id long, text string"


def run(spark, rows, **how):
    return ngram_join.link_components(spark.createDataFrame(rows, SCHEMA), **how).collect()


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "a b c d e"), (2, "v w x y z")],  # nothing shared
        [(1, "a b c d e"), (2, "a b c d e"), (3, "v w x y z q")],  # copies alone
        [(4, "one row of six words here")],
        [(1, None), (2, None), (3, "")],
        [(1, "short"), (2, "Short"), (3, "a few")],
    ],
)
def test_small_tables(spark, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, rows)}
    assert got == brute_components(dict(rows))


def test_one_doc_id_with_two_texts(spark):
    long, short = [f"l{k}" for k in range(104)], [f"s{k}" for k in range(24)]
    rows = [(5, " ".join(long)), (5, " ".join(short)), (7, " ".join([*long, "more"])), (8, " ".join([*short, "more"])), (9, "none of these words at all"), (3, " ".join([*short, "less"]))]
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in run(spark, rows)} == {(5, 100, 3), (5, 20, 3), (7, 101, 3), (8, 21, 3), (9, 2, 9), (3, 21, 3)}


def skewed(seed=11):
    rng = random.Random(seed)
    line = [f"c{k}" for k in range(12)]
    crowd = [f"g{k}" for k in range(60)]
    texts = {}
    for k in range(400):
        if k % 3 == 0:
            w = list(crowd)
            w[rng.randrange(60)] = f"v{rng.randrange(40)}"
        elif k % 3 == 1:
            w = [f"o{rng.randrange(3000)}" for _ in range(rng.randrange(6, 40))] + line
        else:
            w = [f"copy{j}" for j in range(30)] + line
        texts[k] = " ".join(w)
    return texts


@pytest.mark.parametrize("how", ["plain", "hot", "blocks", "buckets"])
def test_hot_shingles_classes_and_lists(spark, monkeypatch, how):
    """The same links whether shingles and classes are hot or not, lists are cut into blocks or not, and at any number of buckets."""
    if how == "plain":
        monkeypatch.setattr(ngram_join, "LOCAL", 1 << 40)  # no shingle is hot
    if how == "blocks":
        monkeypatch.setattr(ngram_join, "LIST_ROWS", 7)
    if how == "buckets":
        monkeypatch.setattr(ngram_join, "BUCKET_KEYS", 100)
        monkeypatch.setattr(ngram_join, "CHUNK_BYTES", 2000)
    texts = skewed()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, list(texts.items()), rounds=0 if how == "blocks" else None)}
    assert got == brute_components(texts)


def test_signatures_met_twice(spark, monkeypatch):
    again = frozenset({ngram_join.signature(3, 5, 7)})
    assert ngram_join.signature(3, 5, 7, again) != ngram_join.signature(3, 5, 7)
    assert ngram_join.signature(3, 5, 8, again) == ngram_join.signature(3, 5, 8)


def test_package_bytes_are_bounded():
    """A shingle never costs more than a plain row would, however many buckets there are."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, 600, np.uint64) * np.uint64(2)) for _ in range(1000)]
    ids = rng.integers(0, 1 << 63, 1000, np.uint64)
    total = sum(len(s) for s in sets)
    size = {}
    for bits in (0, 8, 14, 18):
        got = 0
        for batch in ngram_join._packages(ids, sets, bits):
            got += sum(len(x) for c in ("keys", "docs", "ids") for x in batch.column(c).to_pylist())
        size[bits] = got / total
    assert size[0] < 10 and size[8] < 12 and size[14] < 17 and size[18] < 17
