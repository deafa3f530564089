"""Operator 3: personal data by weak supervision.

Candidates are the matches of four base patterns and of looser ones (obfuscated addresses, local
phone numbers, social security and bank account numbers, titled names).  Labelers vote on each: its
own regular expression, a checksum or structure test, gazetteers, the words around it, its borders.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is and
how likely each pattern marks personal data; these posteriors train a logistic span classifier on
hashed features, which decides over every candidate.  Base matches always stay.

A candidate's expression finds it; the labeler's own one is stricter and says whether the span is written as such data usually is.  The
gazetteers of given names and of generic domain endings are parameters; a two-letter ending is a country's.

Training: vote patterns are counted over all candidates (there are at most kinds * 3**labelers of
them); the classifier is fitted on about SAMPLE_SPANS candidates drawn by hash (a documented bound).

Null and empty texts have no spans; texts are scanned whole by expressions that take linear time;
repeated rows and equal doc_ids each give their row; ties sort by kind as listed; an empty table gives
an empty result and an untrained classifier, which adds nothing; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import pick, staged
from .words import row_groups

BASE = ("email", "ip", "card", "phone")
MORE = ("hidden_email", "local_phone", "ssn", "iban", "person")
KINDS = BASE + MORE
LABELERS = ("regex", "structure", "gazetteer", "context", "contrary", "borders")
SAMPLE_SPANS, FEATURES, AROUND = 20_000, 1 << 12, 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HIDDEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]{1,63}+(?:(?:\.| ?[(\[](?:dot|DOT)[)\]] ?)[A-Za-z0-9-]{1,63}+)+")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_PERSON = re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")

#: How such data is usually written: the labeler `regex` holds a span against its kind's.
USUAL = {
    "email": r"[A-Za-z0-9](?:[._%+-]?[A-Za-z0-9])*@(?:[A-Za-z0-9](?:-?[A-Za-z0-9])*\.)+[A-Za-z]{2,24}",
    "hidden_email": r"[A-Za-z0-9](?:[._%+-]?[A-Za-z0-9])* ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]+(?: ?[(\[](?:dot|DOT)[)\]] ?[A-Za-z0-9-]+|\.[A-Za-z0-9-]+)*(?: ?[(\[](?:dot|DOT)[)\]] ?|\.)[A-Za-z]{2,24}",
    "ip": r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}",
    "card": r"[0-9]{16,19}|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}(?:\1[0-9]{1,3})?",
    "phone": r"\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}",
    "local_phone": r"\([2-9][0-9]{2}\) [0-9]{3}[.-][0-9]{4}|[2-9][0-9]{2}([ .-])[0-9]{3}\1[0-9]{4}",
    "ssn": r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
    "person": r"(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]+ [A-Z][a-z]+",
}
USUAL = {k: re.compile(v) for k, v in USUAL.items()}

#: Gazetteers and context words of the labelers.
DOMAIN_ENDS = frozenset("com org net edu gov mil int info biz name pro museum coop aero jobs mobi travel tel cat asia post app dev page blog shop online site store tech cloud email news wiki xyz".split())
GIVEN_NAMES = frozenset(
    """aaron adam ahmed aisha alan alberto alejandro alex alice amina amy ana andrea andrew angela anna anne antonio barbara ben bernd brian carla carlos carmen
    charles chen chloe christine claire claudia daniel david deborah diego dmitri donald dorothy edward elena elizabeth emily emma eric fatima felix fernando
    francesca frank gabriel george giulia giovanni grace hans hassan heidi helen helga henry hiroshi ibrahim igor ingrid irina isabel ivan jack jacques james
    jan jane javier jean jennifer jessica joan john jorge jose joseph juan julia julie juan karen karl katarina kenji kevin klaus laura li linda lisa louis
    lucia luis maja marco margaret maria marie mario mark martin mary matthew mei michael miguel mohammed monika nadia nancy natalia nicolas nina noah olga
    oliver olivia omar pablo patricia patrick paul pedro peter petra philippe pierre priya rachel raj ramon richard robert rosa ruth samuel sandra sara sarah
    sergei sofia sophie stefan steven susan sven takashi teresa thomas ursula victor wei william yuki yusuf""".split()
)
CONTEXT = {
    "email": "mail email contact write address reach",
    "hidden_email": "mail email contact write address reach",
    "ip": "ip host server address login client from",
    "card": "card visa mastercard credit payment number pay",
    "phone": "phone tel call mobile fax cell telephone",
    "local_phone": "phone tel call mobile fax cell telephone",
    "ssn": "ssn social security",
    "iban": "iban account bank transfer",
    "person": "name patient client signed author",
}
CONTEXT = {k: frozenset(v.split()) for k, v in CONTEXT.items()}
CONTRARY = frozenset("version release isbn issn doi order part invoice serial model build figure table section".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            last = m.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns that pass their test, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "at)" in text or "at]" in text or "AT)" in text or "AT]" in text:
        out += [("hidden_email", *m.span()) for m in _HIDDEN.finditer(text)]
    if _DIGIT.search(text):
        for kind, pattern in (("local_phone", _LOCAL_PHONE), ("ssn", _SSN), ("iban", _IBAN)):
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    out += [("person", *m.span()) for m in _PERSON.finditer(text)]
    return out


def _iban(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(kind: str, text: str, start: int, end: int, names: frozenset = GIVEN_NAMES, ends: frozenset = DOMAIN_ENDS) -> str:
    """A letter for each labeler: y, n or - for no opinion."""
    span, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    digits = _digits(span)
    structure = {
        "email": lambda: len(span) < 255,
        "hidden_email": lambda: len(span) < 120,
        "ip": lambda: span.split(".")[0].lstrip("0") != "",
        "card": lambda: digits[0] in "3456",
        "phone": lambda: len(digits) >= 10,
        "local_phone": lambda: digits[3] in "23456789",
        "ssn": lambda: digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000",
        "iban": lambda: _iban(span),
        "person": lambda: True,
    }[kind]()
    words = [w.lower() for w in _WORD.findall(span)]
    if kind in ("email", "hidden_email"):
        gazetteer = "y" if words and (words[-1] in ends or len(words[-1]) == 2) else "n"
    elif kind == "person":
        gazetteer = "y" if names & set(words) else "-"
    else:
        gazetteer = "-"
    near = {w.lower() for w in _WORD.findall(before)[-5:]} | {w.lower() for w in _WORD.findall(after)[:3]}
    outer = before[-1:] + after[:1]
    return "".join((
        "y" if USUAL[kind].fullmatch(span) else "n",
        "y" if structure else "n",
        gazetteer,
        "y" if near & CONTEXT[kind] else "-",
        "n" if near & CONTRARY else "-",
        "n" if any(c.isalnum() for c in outer) else "y",
    ))


def features(kind: str, vote: str, text: str, start: int, end: int) -> list[int]:
    """Hashed features of a span: kind, votes, shape, words beside it."""
    span = text[start : min(end, start + 64)]
    shape = re.sub(r"(.)\1+", r"\1", "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in span))[:24]
    left = _WORD.findall(text[max(0, start - AROUND) : start])[-2:]
    right = _WORD.findall(text[end : end + AROUND])[:2]
    names = [f"k{kind}", *(f"v{k}{i}{v}" for k in (kind,) for i, v in enumerate(vote)), f"s{kind}{shape}", *(f"l{w.lower()}" for w in left), *(f"r{w.lower()}" for w in right)]
    out = []
    for n in names:
        h = 2166136261
        for c in n.encode():
            h = (h ^ c) * 16777619 & 0xFFFFFFFF
        out.append((h ^ h >> 15) % FEATURES)
    return sorted(set(out))


def _scan(names: frozenset, ends: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text", 8 << 20):
            items = []
            for text in batch.column("text").to_pylist():
                own: list[str] = []
                if text:
                    base = base_spans(text)
                    taken = [(a, b) for _, a, b in base]
                    loose = [s for s in loose_spans(text) if not any(s[1] < b and a < s[2] for a, b in taken)]
                    for kind, a, b in base + loose:
                        v = votes(kind, text, a, b, names, ends)
                        own.append(f"{kind}|{a}|{b}|{v}|{' '.join(map(str, features(kind, v, text, a, b)))}")
                items.append(own)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(items, pa.list_(pa.string()))], names=["doc_id", "items"])

    return run


def estimate(counts: dict[tuple[str, str], int], rounds: int = 50) -> tuple[dict, np.ndarray]:
    """Posteriors of (kind, votes) patterns and each labeler's chance of y and n votes, given not personal and personal.

    Expectation-maximisation of a two-class mixture whose labelers vote independently within a class; no opinion says nothing.
    """
    if not counts:
        return {}, np.full((2, len(LABELERS), 2), 0.5)
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    yes = np.array([[c == "y" for c in v] for _, v in keys], float)
    no = np.array([[c == "n" for c in v] for _, v in keys], float)
    kind = np.array([KINDS.index(k) for k, _ in keys])
    p = np.clip((yes.sum(1) + 1) / (yes.sum(1) + no.sum(1) + 2), 0.05, 0.95)
    for _ in range(rounds):
        rates = []
        for q in (1 - p, p):
            w = n * q
            y, x = w @ yes, w @ no
            # a labeler is held to be right rather than wrong: pseudo-votes of its direction
            good = q is p
            rates.append(np.stack([(x + (1 if good else 4)) / (x + y + 5), (y + (4 if good else 1)) / (x + y + 5)]))
        prior = np.array([(np.sum((n * p)[kind == k]) + 1) / (np.sum(n[kind == k]) + 2) for k in range(len(KINDS))])[kind]
        score = np.log(prior) - np.log1p(-prior)
        score = score + yes @ np.log(rates[1][1] / rates[0][1]) + no @ np.log(rates[1][0] / rates[0][0])
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        p = np.clip(p, 1e-4, 1 - 1e-4)
    return dict(zip(keys, p.tolist(), strict=True)), np.stack([r.T for r in rates])


def fit(rows: list[list[int]], target: np.ndarray, epochs: int = 40, rate: float = 0.5, shrink: float = 1e-4) -> np.ndarray:
    """Weights of a logistic model on sets of features, the last one the bias, by full gradient steps with per-weight rates."""
    w, seen = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    if not rows:
        return w
    at = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    ids = np.array([i for r in rows for i in (*r, FEATURES)])
    for _ in range(epochs):
        score = np.bincount(at, w[ids], minlength=len(rows))
        gap = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - target
        g = np.bincount(ids, gap[at], minlength=FEATURES + 1) / len(rows) + shrink * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def _decide(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            out = []
            for items in batch.column("items").to_pylist():
                own = []
                for item in items or ():
                    kind, a, b, _, f = item.split("|")
                    score = float(sum(w[int(x)] for x in f.split()) + w[FEATURES])
                    if kind in BASE or score > 0:
                        own.append({"kind": kind, "start": int(a), "end": int(b), "probability": float(1 / (1 + np.exp(-max(-30.0, min(30.0, score))))), "base": kind in BASE})
                own.sort(key=lambda s: (KINDS.index(s["kind"]), s["start"]))
                out.append(own)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], names=["doc_id", "found"])

    return run


def find_pii(docs: DataFrame, text: str = "text", key: str = "doc_id", names: frozenset = GIVEN_NAMES, ends: frozenset = DOMAIN_ENDS) -> DataFrame:
    """One row per document: doc_id and found, an array of (kind, start, end, probability, base). names, ends: gazetteers of lower-case given names and domain endings."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    scanned = staged(rows.mapInArrow(_scan(frozenset(names), frozenset(ends)), "doc_id long, items array<string>"), "candidates")
    items = scanned.where(F.size("items") > 0).select("doc_id", F.explode("items").alias("item")).withColumn("part", F.split("item", r"\|"))
    patterns = items.groupBy(F.col("part")[0].alias("kind"), F.col("part")[3].alias("votes")).agg(F.count("*").alias("n"))
    counts = {(r["kind"], r["votes"]): r["n"] for r in patterns.collect()}  # a row for each pattern of votes
    posterior, _ = estimate(counts)
    # a threshold on the hash leaves about SAMPLE_SPANS of them, however many there are
    share = math.ceil((1 << 31) * min(1.0, SAMPLE_SPANS / max(1, sum(counts.values()))))
    sample = items.where(F.pmod(F.xxhash64(F.lit(11), "doc_id", "item"), F.lit(1 << 31)) < share).select("item").collect()
    parts = [r.split("|") for r in sorted(r["item"] for r in sample)]
    weights = fit([[int(x) for x in p[4].split()] for p in parts], np.array([posterior[p[0], p[3]] for p in parts]))
    return scanned.mapInArrow(_decide(spark.sparkContext.broadcast(weights)), "doc_id long, found array<struct<kind:string,start:bigint,end:bigint,probability:double,base:boolean>>")


def report(found: DataFrame) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str):
        return lambda s: s["kind"] == kind

    base = F.filter("found", lambda s: s["base"])
    return found.select("doc_id", *(F.size(F.filter("found", of(k))).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
