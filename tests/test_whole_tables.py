"""Queries over whole tables against brute force on fixtures."""

from pyspark.sql import functions as F

from strataforge.operators import lookup
from strataforge.plans.registry import QUERIES

NAMES = ["red oak", "Red Oak", "oak", "small red oak", "", None, "tin", "tin can", "steel", "Steel", "red", "can"]


def brute(texts, dim):
    """(id, ord, exact) of each named text: the first equal entry, else the first contained either way."""
    out = set()
    for i, t in texts:
        equal = [o for o, k in dim if t and k and k.lower() == t.lower()]
        near = [o for o, k in dim if t and k and (k.lower() in t.lower() or t.lower() in k.lower())]
        if equal or near:
            out.add((i, min(equal or near), bool(equal)))
    return out


def test_lookup_over_all_of_part(spark, tmp_path):
    parts = [(k + 1, n) for k, n in enumerate(NAMES * 5)]
    spark.createDataFrame(parts, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {tuple(r) for r in QUERIES["lookup_exact_or_contains"](spark, str(tmp_path)).collect()}
    assert got == brute(parts, parts) and len(got) == 50


def test_lookup_by_containment(spark):
    texts, entries = [(k, n) for k, n in enumerate(NAMES)], [(k, n) for k, n in enumerate(NAMES) if k not in (0, 1, 7)]
    rows, dim = spark.createDataFrame(texts, "_ord long, t string"), spark.createDataFrame(entries, "ord long, name string")
    found = lookup.exact_or_contained(rows, F.col("t"), dim).select("_ord", "hit.ord", "exact").collect()
    assert {tuple(r) for r in found} == brute(texts, entries)
    assert any(not r["exact"] for r in found)


def test_contained_meets_every_pair(spark):
    """Keys of one to six words, at words' ends and inside them, with double spaces, against plain containment."""
    texts = ["a bc  def ghij klm no", "xbc  def ghij klmx", "bc def", "def", "", None, "  a  b", "no nono é漢 x", "a b c d e f g", "b c d e f", "zzz b c d e"]
    keys = ["bc  def ghij klm", "a", "def", "b c d e f", "c  def gh", "nono", "é漢", "  ", "b", " b c d e", "ghij klm", "x", "a b", "q", "", None, "  a"]
    left = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    right = spark.createDataFrame(list(enumerate(keys)), "j long, k string")
    got = sorted((r["i"], r["j"]) for r in lookup.contained(left, "t", right, "k").collect())
    assert got == [(i, j) for i, t in enumerate(texts) for j, k in enumerate(keys) if t and k and k in t]
    plan = lookup.contained(left, "t", right, "k")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_box_and_projection_over_all_of_lineitem(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").collect()
    boxes = ((1, 10, 900, 20000), (8, 30, 10000, 50000), (25, 50, 40000, 110000))
    inside = [r for r in lines if any(a <= r["l_quantity"] <= b and c <= r["l_extendedprice"] <= e for a, b, c, e in boxes)]
    assert QUERIES["prefix_drop_projection"](spark, "/root/testdata/sf0.001").count() == len(lines)
    assert QUERIES["range_join_box"](spark, "/root/testdata/sf0.001").count() == len({(r["l_orderkey"], r["l_linenumber"], r["l_partkey"], r["l_suppkey"]) for r in inside})
    assert len(inside) > len([r for r in inside if r["l_discount"] > 0.08])
