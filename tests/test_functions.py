import pytest
from pyspark.sql import functions as F

from strataforge.functions import collections as fc
from strataforge.functions import text as ft


def one(spark, value, *columns, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()


@pytest.mark.parametrize(
    ("given", "name"),
    [
        ("normal_paper", "normal_paper"), ("paper with spaces", "paper with spaces"), ("a/b\\c", "a_b_c"), ("../../../etc/passwd", "etc_passwd"), ("CON", "file_CON"),
        ("LPT1.txt", "file_LPT1.txt"), ("paper\0null", "papernull"), ("paper(1)", "paper_1_"), ("x" * 300, "x" * 200), ("", "unknown"), (None, "unknown"),
    ],
)
def test_safe_name(spark, given, name):
    assert one(spark, given, ft.safe_name("x"))[0] == name


@pytest.mark.parametrize(
    ("text", "listed", "earliest"),
    [
        ("body\n## References\nx\n# References\ny", "body\n#", "body\n#"), ("# References first", "# References first", "# References first"), ("a # REFERENCES b # References c", "a # REFERENCES b ", "a "), ("none", "none", "none"),
    ],
)
def test_reference_cuts(spark, text, listed, earliest):
    assert tuple(one(spark, text, ft.cut_at_first_listed("x"), ft.cut_at_earliest("x"))) == (listed, earliest)


def test_texts(spark):
    row = one(spark, " The lower–CRETACEOUS  3rd\tunit. ", ft.fold_dashes("x"), ft.squeeze("x"), ft.title_case(F.lit("lower-cretaceous 3rd")), ft.without_trailing(F.trim("x")), ft.article(F.lit("Orogen")), ft.article(F.lit("belt")), ft.split_words(F.lit("a-b_c/d.e(f),g;h:i j")))
    assert row[0] == " the lower-cretaceous  3rd\tunit. " and row[1] == "the lower–cretaceous 3rd unit." and row[2] == "Lower-Cretaceous 3Rd"
    assert row[3].endswith("unit") and (row[4], row[5]) == ("an", "a") and row[6] == list("abcdefghij")


def test_json_carving(spark):
    row = one(spark, 'said ```json {"a": [1, "x]y"]} ``` ok', ft.braced_object("x"), ft.bracketed_list("x"), fc.parse_loose("x", "a array<string>"), ft.unfence(F.lit("```html\n<b>\n```")))
    assert row[0] == '{"a": [1, "x]y"]}' and row[1] == '[1, "x]y"]' and row[2]["a"] == ["1", "x]y"] and row[3] == "<b>"
    assert one(spark, "nothing", fc.parse_loose("x", "a int"))[0] is None or one(spark, "nothing", fc.parse_loose("x", "a int"))[0]["a"] is None


def test_numbers(spark):
    rows = spark.createDataFrame([("1.5",), ("abc",), (None,), ("",)], "x string").select(ft.number("x").alias("n"), ft.not_number("x").alias("bad")).collect()
    assert [(r["n"], r["bad"]) for r in rows] == [(1.5, False), (None, True), (None, False), (None, True)]


def test_truthy(spark):
    df = spark.createDataFrame([("", 0.0, [], {}, False, None), ("x", 1.0, ["a"], {"k": 1}, True, ("v",))], "s string, d double, a array<string>, m map<string,int>, b boolean, t struct<v:string>")
    rows = df.select(*[fc.truthy_field(df, c).alias(c) for c in df.columns]).collect()
    assert not any(rows[0]) and all(rows[1])


def test_ngrams_and_items(spark):
    row = one(spark, ["a", "b", "c", "d"], fc.ngrams("x"), fc.join_first("x", 2), fc.item("x", -1), fc.item("x", 9, "none"), fc.categories("x", {"two": ["b"], "one": ["a"], "no": ["q"]}), kind="array<string>")
    assert row[0] == ["a b c", "a b", "a", "b c d", "b c", "b", "c d", "c", "d"] and tuple(row)[1:4] == ("a, b", "d", "none") and row[4] == ["one", "two"]
    assert one(spark, [], fc.ngrams("x"), kind="array<string>")[0] == []


def test_canonical_raw(spark):
    raw = ['{"b": 1, "a": null, "paper_id": "p", "_gate": 1}', '{"a": null, "b": 1.0}', '{"b": 1}']
    got = [r[0] for r in spark.createDataFrame([(x,) for x in raw], "x string").select(fc.canonical_raw("x")).collect()]
    assert got[0] == got[1] != got[2]


def test_struct_default_and_append(spark):
    blank = F.from_json(F.lit("{}"), "a string, b boolean")
    row = one(spark, None, fc.set_default("x", blank, "b", F.lit(True)), fc.appended(F.lit(None).cast("array<string>"), F.lit("f"), F.lit(None).cast("string")), ft.fill("n={n}, t={t}", n=F.lit(3), t=F.lit("u")), ft.stem(F.lit("/a/b/c.d.md")), ft.base_name(F.lit("a\\b.jpg")), kind="struct<a:string,b:boolean>")
    assert row[0]["b"] is True and row[1] == ["f"] and row[2] == "n=3, t=u" and row[3] == "c.d" and row[4] == "b.jpg"
