"""Lookups whose cost and results must not depend on how often names, texts and rows repeat."""

import os
import subprocess
import sys
from collections import Counter

from pyspark.sql import functions as F

from strataforge.operators import lookup
from strataforge.plans.registry import QUERIES

from test_whole_tables import NAMES, brute


def parts(spark, at, rows):
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(f"{at}/part.parquet")
    return str(at)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_belts_of_repeated_rows(spark, tmp_path):
    """A row that comes n times gets its place n times."""
    rows = [(1, "red Bolt"), (1, "red Bolt"), (2, "rod"), (2, "rod"), (2, "rod"), (2, "nut"), (3, "rod"), (4, None), (6, "")]
    got = QUERIES["belts_expanded"](spark, parts(spark, tmp_path, rows))
    assert Counter(map(tuple, got.collect())) == Counter({(1, 10.0): 2, (2, 2.0): 3, (2, 20.0): 1, (4, 4.0): 1, (6, 6.0): 1})
    assert "Generate" not in plan(got)  # no name is cut into letters to meet two keys


def test_belts_by_anchors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lookup, "FEW_KEYS", 0)
    rows = [(k, n) for k, n in enumerate(["red Bolt", "nut", "rod", "nut bolt", "peanuts"] * 3)]
    got = QUERIES["belts_expanded"](spark, parts(spark, tmp_path, rows))
    assert {tuple(r) for r in got.collect()} == {(k, 10.0 if "bolt" in n.lower() else 20.0 if "nut" in n else float(k)) for k, n in rows if n != "rod" or k % 2 == 0}


def test_lookup_of_copies(spark, tmp_path):
    """One entry stands for all with its name, so that copies don't meet copies."""
    rows = [(k, NAMES[k % len(NAMES)]) for k in range(3000)]
    got = QUERIES["lookup_exact_or_contains"](spark, parts(spark, tmp_path, rows))
    firsts = {}
    for k, n in rows:
        firsts.setdefault((n or "").lower(), k)
    assert sorted(map(tuple, got.collect())) == [(k, firsts[n.lower()], True) for k, n in rows if n]
    assert "Generate" not in plan(got)


def test_lookup_of_copies_by_anchors(spark, monkeypatch):
    monkeypatch.setattr(lookup, "FEW_KEYS", 0)
    texts, entries = [(k, n) for k, n in enumerate(NAMES * 3)], [(k, n) for k, n in enumerate(NAMES * 4) if n not in ("red oak", "Red Oak", "tin can")]
    rows, dim = spark.createDataFrame(texts, "_ord long, t string"), spark.createDataFrame(entries, "ord long, name string")
    found = lookup.exact_or_contained(rows, F.col("t"), dim).select("_ord", "hit.ord", "exact").collect()
    assert Counter(map(tuple, found)) == Counter(brute(texts, entries))


def test_lookup_of_many_names(spark, tmp_path, monkeypatch):
    """Names are sent to the driver by their count, not by the size of their file; if each has its equal, none is cut into letters."""
    rows = [(k, f"bolt {k % 300}") for k in range(900)]
    for most, word in ((lookup.SMALL_DIMENSION, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(lookup, "SMALL_DIMENSION", most)
        got = QUERIES["lookup_exact_or_contains"](spark, parts(spark, tmp_path / word, rows))
        assert sorted(map(tuple, got.collect())) == [(k, k % 300, True) for k, _ in rows]
        whole = got._jdf.queryExecution().toString()
        assert "Generate" not in whole and [j for j in ("BroadcastHashJoin", "SortMergeJoin") if j in whole] == [word]


def test_containment_of_many_names(spark, monkeypatch):
    """Texts without an equal, repeated rows, rows of one id with two texts, places that are null: as brute force, without any broadcast."""
    monkeypatch.setattr(lookup, "FEW_KEYS", 0)
    texts = [(k % 11, n) for k, n in enumerate(NAMES * 3)] + [(20, "copper"), (21, "a red oak chest"), (21, "a red oak chest"), (22, "ca")]
    entries = [(k, n) for k, n in enumerate(NAMES * 2) if n not in ("red oak", "Red Oak", "tin can")]
    rows = spark.createDataFrame(texts, "_ord long, t string")
    dim = spark.createDataFrame([*entries, (None, "steel"), (None, "chest")], "ord long, name string")
    first = {}
    for i, t in texts:
        equal = [o for o, k in entries if t and k and k.lower() == t.lower()]
        near = [o for o, k in entries if t and k and (k.lower() in t.lower() or t.lower() in k.lower())]
        if equal or near:
            first[i] = min(first.get(i, (True, 99)), (not equal, min(equal or near)))
    for most in (lookup.SMALL_DIMENSION, 0):
        monkeypatch.setattr(lookup, "SMALL_DIMENSION", most)
        got = lookup.exact_or_contained(rows, F.col("t"), dim)
        assert sorted((r["_ord"], (not r["exact"], r["hit"]["ord"])) for r in got.collect()) == sorted(first.items())
    assert "Broadcast" not in got._jdf.queryExecution().toString()


def famous(spark, names):
    papers = spark.createDataFrame([(0, "near the a b c d e mine", ["chile"]), (1, "a b c d e", []), (2, "old a b c d e", ["peru"]), (3, "big hill", ["peru"]), (4, None, [])], "_ord long, text string, countries array<string>")
    dim = spark.createDataFrame(names, "ord int, name string, country string")
    return lookup.named_in(papers, F.lower("text"), lookup.claimed_countries("countries"), dim)


def test_names_and_countries_without_adaptive_plans(spark, monkeypatch):
    """The country is compared where it is known, also when no stage is left out for being empty."""
    names = [(3, "A b c d e", "Chile"), (1, "a b c d e", "Chile"), (2, "a b c d e", "Peru"), (5, "hill", None), (6, "", "Chile"), (7, "mine", "Peru")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for most in (100, 0):
            monkeypatch.setattr(lookup, "FEW_KEYS", most, raising=False)
            got = famous(spark, names)
            assert sorted((r["_ord"], r["hit"]["ord"]) for r in got.collect()) == [(0, 1), (1, 1), (2, 2), (3, 5)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


FRESH = """
import __spark_entry__
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
got = __spark_entry__.queries()["famous_match"](spark, "/root/testdata/sf0.001")
print("misplaced", "!Filter" in got._jdf.queryExecution().optimizedPlan().toString())
"""


def test_famous_match_as_the_first_query_of_a_session():
    """Only then Spark put the condition on countries below the join, where it has no countries."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    told = subprocess.run([sys.executable, "-c", FRESH], cwd=root, capture_output=True, text=True, timeout=300, env={k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_")} | {"PYTHONPATH": root})
    assert "misplaced False" in told.stdout


PAPERS = [(0, "escondida norte"), (1, "condid"), (2, "la escondida norte mine"), (3, None), (4, ""), (0, "escondida norte")]
ENTRIES = [(4, "Escondida", "Chile"), (1, "escondida", "Chile"), (2, "Escondida", None), (3, "Norte", "Peru"), (5, "", "Chile")]


def both_ways(spark, monkeypatch, match, rows):
    """What a match gives by comparing all pairs and by anchors."""
    df = spark.createDataFrame([(k, t, ["chile"] if k else []) for k, t in rows], "_ord long, text string, claimed array<string>")
    dim = spark.createDataFrame(ENTRIES, "ord int, name string, country string")
    for most in (100, 0):
        monkeypatch.setattr(lookup, "FEW_KEYS", most, raising=False)
        yield sorted((r["_ord"], r["hit"]["ord"], round(r["score"], 3)) for r in match(df, dim).collect())


def test_ratio_of_copies(spark, tmp_path, monkeypatch):
    ratio = lambda df, dim: lookup.match_ratio(df, F.split("text", " "), F.col("claimed"), dim)
    for got in both_ways(spark, monkeypatch, ratio, PAPERS):
        assert got == [(0, 1, 1.0), (1, 1, 0.667), (2, 1, 1.0)]
    monkeypatch.undo()
    got = QUERIES["ratio_match_top1"](spark, parts(spark, tmp_path, [(k, "Basin") for k in range(7)]))
    assert plan(got).count("Generate explode") == 1  # of texts into words; no word is cut into letters


def test_phrases_of_copies(spark, tmp_path, monkeypatch):
    keywords = spark.createDataFrame([("Escondida",)], "keyword string")
    phrases = lambda df, dim: lookup.match_phrases(df, F.col("text"), F.col("claimed"), dim, keywords)
    for got in both_ways(spark, monkeypatch, phrases, PAPERS):
        assert got == [(0, 1, 1.3), (2, 1, 1.3)]
    monkeypatch.undo()
    got = QUERIES["ngram_match_top1"](spark, parts(spark, tmp_path, [(k, "Basin") for k in range(7)]))
    assert plan(got).count("Generate explode") == 2  # of texts and of entries into phrases; no text is cut into letters
