"""Operator 5: secret scan over a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: every match must contain,
for each clause, all trigrams of one of the clause's strings.  The index maps each trigram of the
rules' queries to the documents whose folded text has it, in blocks of BLOCK_IDS ids; a rule's query
unites and intersects these lists, and only its candidates are verified by the expression.  A rule
whose expression demands no trigram (like a bare character class) is run over every text.

The candidate table is written before use; Spark broadcasts it if its measured size is under the
session's threshold and shuffles otherwise.

Null texts count as empty; rows with a null doc_id can't be indexed and are scanned by every rule; equal
doc_ids share candidates, and verification keeps each row's own spans; repeated rows repeat their
result.  Spans that start together are ordered by kind as listed.  Texts are scanned whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import pick, staged

BLOCK_IDS = 4096
MOST_STRINGS = 24


@dataclass(frozen=True)
class Rule:
    """kind; Java and Python regular expression; least length of the group (0: the match) that a match must have; whether it is a base rule."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The base rules; what follows them adds spans of further kinds.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),  # all shorter runs fail
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def trigrams(text: str) -> list[str]:
    return [text[k : k + 3] for k in range(len(text) - 2)]


def trigram_query(regex: str) -> list[list[list[str]]]:
    """Clauses that all must hold; a clause holds if all trigrams of one of its strings are there. Folded to lower case.

    Walks the parsed expression and keeps the set of strings that the part since the last open end can be; where that set would
    grow past MOST_STRINGS, or an open end follows, the set becomes a clause if each of its strings has a trigram.
    """
    clauses: list[list[list[str]]] = []

    def flush(now: set[str]) -> None:
        if now and all(len(s) >= 3 for s in now):
            sets = {frozenset(trigrams(s)) for s in now}
            clauses.append(sorted(sorted(t) for t in sets if not any(o < t for o in sets)))  # a string that asks for more adds nothing

    def strings(node) -> set[str] | None:
        """All strings of a node if these are few, else None."""
        op, arg = node
        if op is C.LITERAL:
            return {chr(arg).lower()}
        if op is C.IN:
            out: set[str] = set()
            for kind, value in arg:
                if kind is C.LITERAL:
                    out.add(chr(value).lower())
                elif kind is C.RANGE and value[1] - value[0] < MOST_STRINGS:
                    out |= {chr(v).lower() for v in range(value[0], value[1] + 1)}
                else:
                    return None
            return out if len(out) <= 6 else None
        if op is C.SUBPATTERN:
            return sequence(arg[3])
        if op is C.BRANCH:
            parts = [sequence(x) for x in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is C.MAX_REPEAT and arg[1] is not C.MAXREPEAT and arg[1] <= 2:
            inner = sequence(arg[2])
            if inner is None:
                return None
            out, power = set(), {""}
            for k in range(arg[1] + 1):
                if k >= arg[0]:
                    out |= power
                power = {a + b for a in power for b in inner}
            return out
        return None

    def sequence(nodes) -> set[str] | None:
        now = {""}
        for node in nodes:
            found = strings(node)
            if found is None or len(now) * len(found) > MOST_STRINGS:
                return None
            now = {a + b for a in now for b in found}
        return now

    def walk(nodes) -> None:
        now = {""}
        for node in nodes:
            found = strings(node)
            if found is not None and len(now) * len(found) <= MOST_STRINGS:
                now = {a + b for a in now for b in found}
                continue
            flush(now)
            now = found if found is not None and len(found) <= MOST_STRINGS else {""}
            if found is None and node[0] is C.SUBPATTERN:
                walk(node[1][3])
            elif found is None and node[0] is C.MAX_REPEAT and node[1][0] >= 1:
                walk(node[1][2])
        flush(now)

    walk(parser.parse(regex))
    return clauses


def _folded(text: str) -> Column:
    return F.lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def build_index(docs: DataFrame, terms: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (block, trigram, ids): the documents of a block of ids that have the trigram."""
    rows = docs.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("id"), _folded(text).alias("folded"))
    has = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in terms]))
    postings = rows.select("id", F.explode(has).alias("trigram")).withColumn("block", F.floor(F.col("id") / BLOCK_IDS))
    return postings.groupBy("block", "trigram").agg(F.collect_set("id").alias("ids"))  # BLOCK_IDS ids at most


def _tagged(kind: str):
    return lambda i: F.struct(i.alias("id"), F.lit(kind).alias("kind"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """Rows (id, rules): the kinds whose trigram query the document meets."""
    blocks = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))  # a row for each trigram of the rules
    none = F.array().cast("array<bigint>")

    def ids(t: str) -> Column:
        return F.coalesce(F.try_element_at("lists", F.lit(t)), none)

    hits = []
    for rule in rules:
        clauses = trigram_query(rule.regex)
        if clauses:
            met = [reduce(F.array_union, [reduce(F.array_intersect, map(ids, s)) for s in clause]) for clause in clauses]
            hits.append(F.transform(reduce(F.array_intersect, met), _tagged(rule.kind)))
    return blocks.select(F.explode(F.flatten(F.array(*hits))).alias("h")).groupBy(F.col("h.id").alias("id")).agg(F.collect_set("h.kind").alias("rules"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind, base) of a rule's matches, in code points: gaps and matches alternate."""
    pattern = F.lit(rule.regex)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    kind = "array<struct<start:bigint,order:int,end:bigint,kind:string,base:boolean>>"
    steps = F.arrays_zip(
        F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda g: F.length(g)).alias("gap"),
        F.transform(found, lambda m: F.length(m)).alias("size"),
        F.transform(tested, lambda m: F.length(m)).alias("tested"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["gap"]
        b = a + x["size"]
        span = F.struct(a.alias("start"), F.lit(order).alias("order"), b.alias("end"), F.lit(rule.kind).alias("kind"), F.lit(rule.base).alias("base"))
        return F.struct(b.alias("at"), F.when(x["tested"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(steps, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(kind))


def find_secrets(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id and found, an array of (start, order, end, kind, base) by start, then kind."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    terms = sorted({t for q in queries.values() for clause in q for s in clause for t in s})
    docs = pick(docs, doc_id=key, text=text)
    rows = docs.withColumn("text", F.coalesce("text", F.lit("")))
    if terms:
        likely = staged(candidates(staged(build_index(docs, terms), "trigrams"), rules), "candidates")
        rows = rows.join(likely, rows["doc_id"] == likely["id"], "left")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<string>"))
    parts = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, order)
        if queries[rule.kind]:
            spans = F.when(F.col("doc_id").isNull() | F.array_contains("rules", rule.kind), spans)
        parts.append(F.coalesce(spans, F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string,base:boolean>>")))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("found"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: DataFrame, rules=RULES) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    base = F.filter("found", lambda s: s["base"])
    counts = {f"n_{r.kind}": F.size(F.filter("found", _of_kind(r.kind))).cast("long") for r in rules if r.base}
    return found.select("doc_id", *(c.alias(n) for n, c in counts.items()), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def matches(text: str, rules=RULES) -> list[tuple[int, int, int, str]]:
    """The plain version that tests compare with."""
    out = []
    for order, r in enumerate(rules):
        out += [(m.start(), order, m.end(), r.kind) for m in re.finditer(r.regex, text) if len(m[r.group]) >= r.least]
    return sorted(out)
