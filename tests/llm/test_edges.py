"""Every operator on nulls, empty, long, tied and repeated rows, empty tables and clashing columns."""

import pytest

from strataforge.llm import binary_search, bpe, exact_dedup, langid, lm_scoring, mixing, ngram_join, pii, quality, queries, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word soup and more " * 20_000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, LONG, "en", "b", 1),
    (5, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
    (5, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
    (None, "der schnelle braune fuchs", "de", None, 2),
    (7, " \n\t ", "de", "b", 3),
    (8, "x" * 300_000, None, "b", 3),
    (9, "write to a.b@c.org or +1 (212) 555-0100, password=abcdefghijkl", "fr", "c", 3),
]
#: Columns that operators use as names of their own.
CLASHING = ["digest", "N", "Row", "bucket", "keep_id", "component", "score", "ids", "decoded", "lang_pred", "held_out", "items", "found", "rules", "TEXT", "Doc_Id"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["?"] * len(CLASHING)) for r in ROWS], f"{SCHEMA}, {extra}")


OPERATORS = {
    "bpe": lambda d: bpe.encode_decode(d, queries.TOKENIZER).select("ids", "decoded"),
    "lm": lm_scoring.score_texts,
    "pii": lambda d: pii.report(pii.find_pii(d)),
    "langid": lambda d: langid.identify(d).select("lang_pred", "lang_rejected"),
    "secrets": lambda d: secrets.report(secrets.find_secrets(d)),
    "exact": exact_dedup.exact_dedup,
    "quality": lambda d: quality.rate_quality(d, d.sparkSession.createDataFrame([(1,), (5,)], "doc_id long")),
    "join": ngram_join.link_components,
    "mixing": mixing.mix_sources,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_a_document(docs, name):
    if name in ("bpe", "langid"):
        docs = docs.drop("n_chars")
    assert OPERATORS[name](docs).count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(clashing, name):
    if name in ("bpe", "langid"):  # these keep further columns, so a name may be there once only
        names = [c for c in clashing.columns if c not in ("TEXT", "Doc_Id")]
        clashing = clashing.toDF(*[f"{c}_{k}" if c in ("TEXT", "Doc_Id") else c for k, c in enumerate(clashing.columns)]).select(*names)
    assert OPERATORS[name](clashing).count() == len(ROWS)


def test_defined_results(docs):
    exact = {(r["doc_id"], r["kept"]): r for r in exact_dedup.exact_dedup(docs).collect()}
    assert exact[1, False]["keep_id"] == 5 and exact[5, True]["group_size"] == 3
    assert exact[3, True]["group_size"] == 2  # null counts as empty
    joined = {r["doc_id"]: r for r in ngram_join.link_components(docs).collect()}
    assert joined[5]["component_id"] == 1 and joined[2]["component_id"] == 2 and joined[3]["n_shingles"] == 0
    assert joined[8]["n_shingles"] == 1 and joined[4]["component_id"] == 4
    found = {r["doc_id"]: r for r in pii.report(pii.find_pii(docs)).collect()}
    assert found[9]["spans"] == "email:9:18,phone:22:39" and found[2]["spans"] == ""
    assert {r["doc_id"]: r for r in secrets.report(secrets.find_secrets(docs)).collect()}[9]["spans"] == "assign:41:62"
    langs = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs.drop("n_chars")).collect()}
    assert langs[2] == langs[3] == langs[7] == "und"


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0] * 64), (2, None), (None, [1.0] * 64), (3, [1.0, None] * 32), (4, [1.0] * 3), (50, [1.0] * 64), (50, [1.0] * 64)], "vec_id long, embedding array<float>")
    codes = binary_search.codes(df)
    assert {(r["id"], r["code"]) for r in codes.collect()} == {(1, -1), (3, 0x5555555555555555), (50, -1)}
    rows = binary_search.top_k(codes, codes.where("id % 50 = 0"), 3).orderBy("rank").collect()
    assert [(r["query_id"], r["id"], r["distance"]) for r in rows] == [(50, 1, 0), (50, 50, 0), (50, 50, 0)]
    assert binary_search.top_k(codes.limit(0), codes.limit(0)).count() == 0
