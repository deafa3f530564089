"""Scoring types against known answers: families, evaluation by references, regression over a catalogue."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed import FAMILIES, SYNONYMS
from .lookup import small


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


def _family_pairs() -> list[tuple[str, str]]:
    found: dict[str, str] = {}
    for family, codes in FAMILIES.items():
        for code in codes:
            found.setdefault(code, family)
    return list(found.items())


def normal_type(c: Column) -> Column:
    c = F.upper(F.trim(c))
    return F.coalesce(F.try_element_at(_map(SYNONYMS.items()), c), c)


def family_of(c: Column) -> Column:
    """The family of a code, or the code itself; null for none."""
    up = F.upper(c)
    return F.when(c != "", F.coalesce(F.try_element_at(_map(_family_pairs()), up), up))


def same_family(a: Column, b: Column) -> Column:
    return F.coalesce((a != "") & (b != "") & (family_of(a) == family_of(b)), F.lit(False))


def score_match(predicted: Column, expected: Column, strict: bool = False) -> Column:
    """1 for the same code, synonyms resolved, 0.5 for the same family, else 0; 0 if either is missing."""
    given = (F.coalesce(predicted, F.lit("")) != "") & (F.coalesce(expected, F.lit("")) != "")
    if strict:
        return F.when(given & (F.upper(predicted) == F.upper(expected)), 1.0).otherwise(0.0)
    p, e = normal_type(predicted), normal_type(expected)
    return F.when(given & (p == e), 1.0).when(given & (family_of(p) == family_of(e)), 0.5).otherwise(0.0)


def match_references(df: DataFrame, famous: DataFrame, row_id: str = "_ord") -> DataFrame:
    """(row_id, pos, ref_deposit, famous_name, expected_type, predicted_type, score) of a record's reference deposits found in a catalogue
    (ord, name, type): by equal name, else the first contained either way. Empty names match nothing."""
    refs = df.select(F.col(row_id), F.col("deposit_type"), F.posexplode("reference_deposits").alias("pos", "ref")).select(row_id, "deposit_type", "pos", F.col("ref.name").alias("ref_deposit")).where("ref_deposit <> ''")
    refs = refs.withColumn("_up", F.upper("ref_deposit"))
    dim = small(famous.select(F.col("ord").alias("_o"), F.col("name").alias("famous_name"), F.col("type").alias("expected_type"), F.upper("name").alias("_key")))
    hits = refs.join(dim, F.contains("_key", "_up") | F.contains("_up", "_key"))
    rank = F.struct((F.col("_key") != F.col("_up")).alias("x"), F.col("_o"))
    best = hits.groupBy(row_id, "pos", "ref_deposit", "deposit_type").agg(F.min_by(F.struct("famous_name", "expected_type"), rank).alias("h"))
    out = best.select(row_id, "pos", "ref_deposit", "h.famous_name", "h.expected_type", F.coalesce("deposit_type", F.lit("")).alias("predicted_type"))
    return out.withColumn("score", score_match(F.col("predicted_type"), F.col("expected_type")))


def evaluation(matches: DataFrame, row_id: str = "_ord") -> DataFrame:
    """One row over the best score of each record: n, mean, counts of 1, 0.5 and 0; zeros for none."""
    best = matches.groupBy(row_id).agg(F.max("score").alias("best"))
    return best.agg(F.count("*").alias("n"), F.coalesce(F.avg("best"), F.lit(0.0)).alias("mean_score"), *[F.count_if(F.col("best") == v).alias(n) for v, n in ((1.0, "exact"), (0.5, "family"), (0.0, "wrong"))])


def null_reasons(df: DataFrame) -> DataFrame:
    """(paper_id, reason) of records without a type."""
    return df.where(F.coalesce("deposit_type", F.lit("")) == "").select("paper_id", F.coalesce("deposit_type_null_reason", F.lit("MISSING_FIELD")).alias("reason"))


def name_index(df: DataFrame, famous: DataFrame, row_id: str = "_ord") -> DataFrame:
    """(name, at, row): upper-case names that records mention as reference, or catalogue names in their id or belt; at: first place."""
    refs = df.select(F.col(row_id).alias("row"), F.explode("reference_deposits").alias("r")).select("row", F.upper(F.trim("r.name")).alias("name")).where("name <> ''")
    left = df.select(F.col(row_id).alias("row"), F.upper(F.coalesce("paper_id", F.lit(""))).alias("_i"), F.upper(F.coalesce("metallogenic_belt", F.lit(""))).alias("_b"))
    named = left.join(small(famous.select(F.upper("name").alias("name"))), F.contains("_i", "name") | F.contains("_b", "name")).select("row", "name")
    return refs.unionByName(named)


def regression(df: DataFrame, famous: DataFrame, strict: bool = False, row_id: str = "_ord") -> DataFrame:
    """One row a typed catalogue entry: deposit, expected, predicted, score, status (PASS from 0.5, FAIL, not_found), paper_id, matched_papers; failures first."""
    index = name_index(df, famous, row_id)
    typed = famous.where(F.coalesce("type", F.lit("")) != "").select(F.col("name").alias("deposit"), F.col("type").alias("expected"), F.upper("name").alias("_up"))
    exact = typed.join(index, F.col("_up") == F.col("name")).select("deposit", "row")
    names = index.groupBy("name").agg(F.min("row").alias("_at"))
    rest = typed.join(exact.select("deposit").distinct(), "deposit", "left_anti")
    near = rest.join(small(names), F.contains("name", "_up") | F.contains("_up", "name")).groupBy("deposit").agg(F.min_by("name", F.struct("_at", "name")).alias("name"))
    found = exact.unionByName(near.join(index, "name").select("deposit", "row"))
    scored = found.join(typed, "deposit").join(df.select(F.col(row_id).alias("row"), "deposit_type", "paper_id"), "row").withColumn("score", score_match(F.col("deposit_type"), F.col("expected"), strict))
    best = scored.groupBy("deposit").agg(F.max_by(F.struct(F.col("deposit_type").alias("predicted"), "paper_id", "score"), F.struct("score", (-F.col("row")).alias("o"))).alias("b"), F.count("*").alias("matched_papers"))
    out = typed.join(best, "deposit", "left")
    hit = F.col("b.score") > 0
    status = F.when(F.col("b").isNull(), "not_found").when(F.col("b.score") >= 0.5, "PASS").otherwise("FAIL")
    out = out.select("deposit", "expected", F.when(hit, F.col("b.predicted")).alias("predicted"), F.col("b.score").alias("score"), status.alias("status"), F.when(hit, F.left("b.paper_id", F.lit(60))).alias("paper_id"), F.coalesce("matched_papers", F.lit(0)).alias("matched_papers"))
    return out.orderBy(F.col("status") != "FAIL", "deposit")


def regression_report(results: DataFrame) -> DataFrame:
    tested = F.count_if(F.col("status").isin("PASS", "FAIL"))
    passed = F.count_if(F.col("status") == "PASS")
    return results.agg(F.count("*").alias("total"), tested.alias("testable"), F.count_if(F.col("status") == "not_found").alias("not_found"), passed.alias("passed"), F.count_if(F.col("status") == "FAIL").alias("failed"), F.when(tested > 0, F.round(passed / tested, 3)).otherwise(F.lit(0.0)).alias("pass_rate"))


def pass_by_prefix(results: DataFrame) -> DataFrame:
    rows = results.where(F.col("status").isin("PASS", "FAIL")).withColumn("prefix", F.substring_index("expected", "-", 1))
    return rows.groupBy("prefix").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "PASS").alias("passed")).orderBy(F.desc("total"), "prefix")


def on_topic(df: DataFrame, words, kinds=("porphyry",)) -> Column:
    """Any of the words anywhere in the record and any of the kinds in its type or text."""
    from ..functions.text import any_of

    whole = F.lower(F.to_json(F.struct(*df.columns)))
    return any_of(whole, [w.lower() for w in words]) & any_of(whole, [k.lower() for k in kinds])


def check_lines(df: DataFrame, most: int = 300) -> DataFrame:
    """(line): a checklist line a record, evidence cut short."""
    evidence = F.substring(F.coalesce("deposit_type_evidence", F.lit("")), 1, most)
    return df.select(F.format_string("- [ ] %s | %s | %.2f | %s", F.coalesce("paper_id", F.lit("")), F.coalesce("deposit_type", F.lit("null")), F.coalesce("deposit_type_conf", F.lit(0.0)), evidence).alias("line"))
