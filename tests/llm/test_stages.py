"""The pipeline's stages on rows with null and repeated ids."""

import collections

import pytest

import corpus_pipeline
from strataforge.llm import components, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
    (5, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
    (7, "of other things one two three", "en", "b", 1),
    (7, "of other things one two three", "en", "b", 1),
    (None, "der schnelle braune fuchs", "de", None, 2),
    (None, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
]


def texts(rows):
    return collections.Counter((r["doc_id"], r["text"]) for r in rows)


def test_near_keeps_rows_without_id_and_one_of_a_group(spark):
    got = corpus_pipeline.near(spark, spark.createDataFrame(ROWS, SCHEMA), "").collect()
    assert texts(got) == collections.Counter({(1, ROWS[0][1]): 1, (7, ROWS[2][1]): 1, (None, ROWS[4][1]): 1, (None, ROWS[5][1]): 1})


def test_exact_keeps_one_row_of_a_text(spark):
    got = corpus_pipeline.exact(spark, spark.createDataFrame(ROWS, SCHEMA), "").collect()
    assert texts(got) == collections.Counter({(5, ROWS[0][1]): 1, (7, ROWS[2][1]): 1, (None, ROWS[4][1]): 1})


def test_stages_on_odd_rows(spark):
    rows = [*ROWS, (8, None, None, None, None), (9, "", "en", "a", 0), (10, "word soup and more " * 20_000, "en", "b", 1), (11, "x" * 300_000, None, "b", 3)]
    docs = spark.createDataFrame([(*r, "?", "?") for r in rows], f"{SCHEMA}, place string, component string")
    for stage in (corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.mix):
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0
    assert collections.Counter(r["doc_id"] for r in corpus_pipeline.exact(spark, docs, "").collect()) == {5: 1, 7: 1, None: 1, 9: 1, 10: 1, 11: 1}
    assert collections.Counter(r["doc_id"] for r in corpus_pipeline.near(spark, docs, "").collect()) == {1: 1, 7: 1, None: 2, 8: 1, 9: 1, 10: 1, 11: 1}
    assert corpus_pipeline.language_id(spark, docs, "").count() == 0 + len([r for r in corpus_pipeline.langid.identify(docs).collect() if not r["lang_rejected"]])
    tokens = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.tokenize(spark, docs, "").collect()}
    assert tokens[8] == tokens[9] == 0 and tokens[10] >= 80_000


def test_mix_takes_each_row_as_often_as_told(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    copies = mixing.mix_sources(docs).collect()
    got = corpus_pipeline.mix(spark, docs, "").collect()
    want = collections.Counter()
    for r in copies:
        want[r["doc_id"], r["source"]] += r["copies"]
    assert collections.Counter((r["doc_id"], r["source"]) for r in got) == +want
    assert want[None, None] > 0 and want[None, "a"] > 0


def test_components_that_have_not_settled_are_an_error(spark):
    chain = spark.range(40).selectExpr("id AS x", "id + 1 AS y")
    with pytest.raises(RuntimeError, match="settled"):
        components.components(chain, rounds=1)
    assert {r["component"] for r in components.components(chain).collect()} == {0}
