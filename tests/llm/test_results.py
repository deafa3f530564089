"""Operators against brute force, the reference libraries and held-out data."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataforge.llm import binary_search, bpe, components, exact_dedup, langid, lm_scoring, mixing, ngram_join, packed, pii, quality, queries, secrets, words

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


def noise(seed, n, letters, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_word_hashes_agree_with_split():
    texts = noise(1, 300, "aAbB \t\n\x0b\x85é漢") + ["", " ", "a" * 5000, "x y " * 2000]
    import pyarrow as pa

    old = words.PIECE_BYTES
    whole, counts = words.word_hashes(*words.text_buffer(pa.array(texts)))
    split = [[w for w in WORDS.findall(fold(t))] for t in texts]
    assert counts.tolist() == [len(s) for s in split]
    by = {}
    for w, h in zip(itertools.chain(*split), whole.tolist(), strict=True):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    words.PIECE_BYTES = 64  # pieces of long texts
    try:
        again, c = words.word_hashes(*words.text_buffer(pa.array(texts)))
    finally:
        words.PIECE_BYTES = old
    assert (again == whole).all() and (c == counts).all()


def test_pack():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = np.sort(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        assert (packed.unpack(packed.pack(keys)) == keys).all()


def test_bpe_matches_the_library(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.TOKENIZER)
    codec = bpe.Codec(open(queries.TOKENIZER, encoding="utf-8").read())
    texts = [r["text"] for r in rows] + noise(2, 500, "abc thing \n\t.1é漢'sS🙂") + ["<|endoftext|> a<|endoftext|>", "aaaa" * 500, "a  b   c \n d", "don't WE'LL"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [codec.encode(t) for t in texts] == expected
    assert [codec.decode(e) for e in expected] == [library.decode(e, skip_special_tokens=False) for e in expected]
    assert codec.decode([10**6, -1]) == ""


def test_bpe_query(spark, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.TOKENIZER)
    got = {r["doc_id"]: r for r in queries.op1_bpe(spark, SF).collect()}
    for r in rows:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids) and g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_encode_then_decode(spark):
    df = spark.createDataFrame([(1, "some text é"), (2, None)], "doc_id long, text string")
    got = bpe.decode(bpe.encode(df, queries.TOKENIZER), queries.TOKENIZER).orderBy("doc_id").collect()
    assert [r["decoded"] for r in got] == ["some text é", ""]


class PlainModel:
    """Trigrams with hierarchical Dirichlet smoothing, from the definition."""

    def __init__(self, texts, strengths):
        self.one, self.two, self.three, self.m, self.texts = collections.Counter(), collections.Counter(), collections.Counter(), strengths, len(texts)
        for ws in texts:
            self.one.update(ws)
            self.two.update(zip(["<s>", *ws], ws, strict=False))
            self.three.update(zip(["<s>", *ws], ws, ws[1:], strict=False))
        self.n = sum(self.one.values())

    def p(self, ws, k):
        p = (self.one[ws[k]] + 1) / (self.n + len(self.one) + 1)
        before = ws[k - 1] if k else "<s>"
        p = (self.two[before, ws[k]] + self.m[0] * p) / ((self.one[before] if k else self.texts) + self.m[0])
        if k:
            earlier = ws[k - 2] if k > 1 else "<s>"
            p = (self.three[earlier, before, ws[k]] + self.m[1] * p) / (self.two[earlier, before] + self.m[1])
        return p

    def score(self, ws):
        return sum(math.log10(self.p(ws, k)) for k in range(len(ws)))


def test_lm_base_and_sums(spark, rows):
    got = {r["doc_id"]: r for r in queries.op2_lm_scoring(spark, SF).collect()}
    tokens = {r["doc_id"]: [*WORDS.findall(fold(r["text"])), None] for r in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    m = PlainModel([ws for i, ws in tokens.items() if not held[i]], lm_scoring.STRENGTHS)
    p = lambda w: (m.one[w] + 1) / (m.n + len(m.one) + 1)
    for i, ws in tokens.items():
        g = got[i]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held[i], len(ws), sum(w in m.one for w in ws), m.n)
        assert math.isclose(g["base_score"], sum(math.log10(p(w)) for w in ws), abs_tol=2e-6)
        assert math.isclose(g["score"], m.score(ws), abs_tol=2e-6)
    out = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in out) > sum(g["base_score"] for g in out)  # better than single words on unseen texts


@pytest.mark.parametrize("steps", [1, 3, 128])
def test_automaton_in_parts_and_buckets(spark, monkeypatch, steps):
    """Texts read in parts, small chunks and many buckets give the same; a state's arcs, failure arcs and the root's all occur."""
    monkeypatch.setattr(lm_scoring, "STEPS", steps)
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 300)
    monkeypatch.setattr(lm_scoring, "BUCKET_KEYS", 50)
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 40))) for _ in range(60)] + ["A b c", "x y z a b", "a", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_scoring.score_texts(df, F.col("doc_id") % 3 == 0, (2.0, 1.0)).collect()}
    tokens = [[*WORDS.findall(fold(t)), None] for t in texts]
    m = PlainModel([ws for k, ws in enumerate(tokens) if k % 3], (2.0, 1.0))
    assert all(math.isclose(got[k]["score"], m.score(ws), abs_tol=1e-9) for k, ws in enumerate(tokens)) and len(got) == len(tokens)


def test_texts_that_occur_twice_score_apart(spark):
    path = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    often = collections.Counter(texts.values())
    got = [r for r in queries.op2_lm_scoring(spark, path).collect() if r["n_tokens"] > 60 and not r["held_out"]]
    by = {n: sorted(r["score"] / r["n_tokens"] for r in got if often[texts[r["doc_id"]]] == n) for n in (1, 2)}
    above = by[1][int(0.9 * len(by[1]))]
    assert len(by[2]) > 10 and sum(x > above for x in by[2]) > 0.6 * len(by[2])


def base_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]


def test_pii_base_spans(rows):
    texts = [r["text"] for r in rows] + noise(3, 4000, "aB1234567890.@+-  (%_)\n", 120) + ["4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "a@b@c.d"]
    assert all(pii.base_spans(t) == base_pii(t) for t in texts)


def test_pii_query(spark, rows):
    got = {r["doc_id"]: r for r in queries.op3_pii(spark, SF).collect()}
    for r in rows:
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in base_pii(r["text"]))
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()


def test_pii_adds_and_leaves(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["mail me: jo (at) example (dot) com now", "call phone (212) 555-0100 today", "plain words in a row", "contact Dr. Maria Lopez please", "mail x.y@example.org"] * 20)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.report(pii.find_pii(df)).collect()}
    assert got[0].startswith("hidden_email:9:") and got[1] == "local_phone:11:25" and got[2] == "" and got[3].startswith("person") and got[4] == "email:5:20"


def test_pii_recall_of_added_spans(spark):
    """Planted spans that the base patterns don't find, in prose, and look-alikes that are no personal data."""
    rng = random.Random(21)
    said = [
        ("hidden_email", lambda: (f"mail {rng.choice(['jo', 'k.lee', 'ann_b'])} (at) {rng.choice(['example', 'uni-x'])} (dot) {rng.choice(['com', 'de', 'org'])}", 5)),
        ("local_phone", lambda: (f"call {rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}", 5)),
        ("ssn", lambda: (f"social security {rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}", 16)),
        ("person", lambda: (f"patient Dr. {rng.choice(['Maria', 'Thomas', 'Yuki'])} {rng.choice(['Lopez', 'Stone', 'Weber'])}", 8)),
    ]
    rows, planted = [], {}
    for k in range(600):
        head = " ".join(rng.choice("red house of many doors stood near a hill".split()) for _ in range(rng.randrange(3, 20)))
        if k % 2:
            kind, make = said[k // 2 % 4]
            body, at = make()
            planted[k] = (kind, len(head) + 1 + at)
            rows.append((k, f"{head} {body} and more"))
        else:
            rows.append((k, f"{head} part order 12 of {rng.randrange(10)} and more"))
    got = {r["doc_id"]: r["spans"] for r in pii.report(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    caught = sum(f"{kind}:{at}:" in got[k] for k, (kind, at) in planted.items())
    assert caught >= 0.9 * len(planted) and not any(got[k] for k in got if k not in planted)


def test_usual_forms_vote():
    text = "x 010.001.2.3 y 10.1.2.3"
    assert pii.votes("ip", text, 2, 13)[0] == "n" and pii.votes("ip", text, 16, 24)[0] == "y"
    assert pii.votes("person", "Dr. Zork Blip", 0, 13, frozenset({"zork"}))[2] == "y" and pii.votes("person", "Dr. Zork Blip", 0, 13)[2] == "-"


def test_votes_are_weighed():
    good, bad = ("ssn", "-y-y-y"), ("ssn", "-n--nn")
    posterior, rates = pii.estimate({good: 90, bad: 10})
    assert posterior[good] > 0.9 > 0.1 > posterior[bad]
    assert rates[1][1][1] > rates[0][1][1]


def test_language_accuracy(spark):
    path = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = queries.op4_language_id(spark, path).collect()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) > 0.96 * len(out)
    assert sum(r["lang_rejected"] for r in got) < 0.02 * len(got)


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") == []
    assert secrets.trigram_query("AKIA[A-Z]+") == [[["aki", "kia"]]]
    clause = secrets.trigram_query(secrets.RULES[0].regex)[0]
    assert ["ken", "oke", "tok"] in clause and ["api", "ike", "key", "pik"] in clause


def test_secrets(spark, rows):
    texts = [r["text"] for r in rows] + noise(4, 1500, ["password", "PassWd", "=", ":", " ", "'", "token", "AKIA", "ABCDEFGHIJKLMN", "0123456789abcdef", "é", "漢", "\n", "api_key", "q"], 14)
    texts += ["password: secret = abcdefghijklmnop", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.report(secrets.find_secrets(df)).collect()}
    for k, t in enumerate(texts):
        found = secrets.matches(t)
        assert got[k]["spans"] == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)
        base = [f"{kind}:{a}:{b}" for a, o, b, kind in found if o < 3]
        assert got[k]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 63, 20_000, np.uint64))
    mph = exact_dedup.PerfectHash.load(exact_dedup.PerfectHash.build(keys).dump())
    assert sorted(mph.find(keys).tolist()) == list(range(len(keys)))


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_exact_dedup(spark, share):
    rng = random.Random(6)
    data = [(k, rng.choice(["a", "b", "", None, f"t{k}", f"u{k // 7}"])) for k in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    groups = collections.defaultdict(list)
    for k, t in data:
        groups[t or ""].append(k)
    for r in exact_dedup.exact_dedup(df, share).collect():
        g = groups[data[r["doc_id"]][1] or ""]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(g), len(g), r["doc_id"] == max(g))


def test_quality(spark):
    got = queries.op7_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic = 0")
    by = {r["quality"]: r["k"] for r in got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert by[1] > 0.95 and by[0] < 0.4


def test_quality_thresholds_use_every_trusted_row(spark):
    rare = F.col("id") % 600 == 0
    text = F.concat(F.when(rare, "zq xv ").otherwise("and the "), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 8))
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(rare, "rare").otherwise("common").alias("lang"))
    got = quality.rate_quality(docs, docs.select("doc_id")).where("lang = 'rare'")
    rows = got.withColumn("fits", quality._trains()).collect()
    own = [r["perplexity"] for r in rows if not r["fits"]]
    assert len(rows) == 100 and quality.LEAST_TRUSTED <= len(own) < 100
    assert {r["threshold"] for r in rows} == {max(own)}  # the 0.995 quantile of fewer than 200


def test_rare_language_leaves_other_dictionaries_whole(spark):
    texts = {lang: noise(seed, 400, letters + " ", 2000) for seed, (lang, letters) in enumerate({"aa": "abcdefgh", "bb": "mnopqrst"}.items())}
    rows = [(k, lang, t) for lang, found in texts.items() for k, t in enumerate(found) if t.strip()]
    schema = "doc_id long, lang string, text string"
    alone = langid.learn(spark.createDataFrame(rows, schema), F.lit(True))
    rare = langid.learn(spark.createDataFrame([*rows, (1, "zz", "uvw xyz uvw")], schema), F.lit(True))
    assert rare["zz"] == b"uvw xyz uvw" and {s: rare[s] for s in alone} == alone
    assert all(len(d) == langid.DICTIONARY_BYTES for d in alone.values())


def brute_perplexity(train, texts, order=4):
    """Interpolated modified Kneser-Ney over code points, from the definition."""
    levels = {order: collections.Counter(tuple(p[i : i + order]) for t in train for p in [[""] * (order - 1) + list(t)] for i in range(len(t)))}
    for k in range(order - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    size, cuts, contexts = len(levels[1]) + 1, {}, {}
    for k, level in levels.items():
        t = [max(1, sum(n == c for n in level.values())) for c in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1])
        cuts[k] = [max(0.05, min(c - 0.05, c - (c + 1) * y * t[c] / t[c - 1])) for c in (1, 2, 3)]
        for g, n in level.items():
            contexts.setdefault(g[:-1], []).append(n)

    def p(g):
        if not g:
            return 1 / size
        seen, cut = contexts.get(g[:-1], []), cuts[len(g)]
        if not seen:
            return p(g[1:])
        n = levels[len(g)].get(g, 0)
        return ((n - cut[min(n, 3) - 1] if n else 0) + sum(cut[min(x, 3) - 1] for x in seen) * p(g[1:])) / sum(seen)

    out = []
    for t in texts:
        padded = [""] * (order - 1) + list(t)
        out.append(math.exp(-sum(math.log(p(tuple(padded[i : i + order]))) for i in range(len(t))) / len(t)))
    return out


def test_quality_agrees_with_brute_force(spark, monkeypatch):
    words = {"ru": "не все дома белые ночи", "zh": "天地玄黄 宇宙洪荒 日月", "en": "the quick Brown fox ran", "el": "και το νερό είναι"}
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(words[lang].split()) for _ in range(rng.randrange(1, 40))), lang) for k in range(80) for lang in [rng.choice(list(words))]]
    rows += [(80 + k, t, "en") for k, t in enumerate(["THE QUICK", "ыыыы щщщ", "😀 x", "a", "地天黄玄", "Brown"])]
    monkeypatch.setattr(quality, "PIECE", 64)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.where("doc_id < 60").select("doc_id")
    fits = {r["doc_id"] for r in trusted.where(quality._trains()).collect()}
    got = {r["doc_id"]: r for r in quality.rate_quality(docs, trusted).collect()}
    want = brute_perplexity([t for k, t, _ in rows if k in fits], [t for _, t, _ in rows])
    assert [got[k]["n_symbols"] for k, _, _ in rows] == [len(t) for _, t, _ in rows]
    assert np.allclose([got[k]["perplexity"] for k, _, _ in rows], want, rtol=1e-4)


def test_kneser_ney_sums_to_one(spark):
    grams = spark.createDataFrame([(1 << 10 | 2 << 5 | 3, 5), (1 << 10 | 2 << 5 | 4, 1), (2 << 10 | 2 << 5 | 3, 2), (7, 3)], "gram long, n long")
    table = 10.0 ** quality.dense([tuple(r) for r in quality.kneser_ney(grams).collect()]).astype(float)
    sums = table.reshape(-1, 32).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)


def brute_components(texts, size=5, percent=75):
    sets = {}
    for k, t in texts.items():
        w = WORDS.findall(fold(t))
        sets[k] = set(zip(*(w[j:] for j in range(size)), strict=False)) if len(w) >= size else ({tuple(w)} if w else set())
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in texts}


@pytest.mark.parametrize("rounds", [0, 1, None])
def test_join_components(spark, rounds):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))] for _ in range(25)]
    boiler = [f"b{k}" for k in range(40)]
    texts = {}
    for k in range(260):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        texts[k] = " ".join(w + (boiler if rng.random() < 0.2 else []))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(df, rounds=rounds).collect()}
    assert got == brute_components(texts)


def test_components(spark):
    edges = [(k, k + 1) for k in range(200, 300)] + [(5, 9), (9, 7), (7, 5), (5, 7), (3, 300), (40, 40), (None, 40), (41, None)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0
    assert 41 not in got
    assert got[250] == got[200] == 3 and got[9] == got[7] == got[5] == 5 and 40 not in got


def test_prefix_lengths():
    dfs = np.array([2, 2, 50, 900], np.uint32)
    matches, at = ngram_join.prefix(10, dfs)
    assert at.tolist() == list(range(6, max(6, 10 - 8 + matches)))
    assert ngram_join.prefix(8, np.full(8, 3, np.uint32))[0] >= 1


def fill_targets(sizes, weights, most=3):
    target, left, open_ = {}, float(sum(sizes.values())), dict(weights)
    while open_:
        unit = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * unit > most * sizes[s]]
        if not full:
            return target | {s: w * unit for s, w in open_.items()}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
            del open_[s]
    return target


def order_sources(names):
    return sorted(n for n in names if n is not None) + [None] * (None in names)


@pytest.mark.parametrize("sizes", [{"é": 100, "a": 10, None: 10, "Z": 1}, {"a": 5}, {None: 3, "b": 0}, {f"s{k}": k * k for k in range(40)}])
def test_targets(spark, monkeypatch, sizes):
    monkeypatch.setattr(mixing, "PART_ROWS", 3)
    df = spark.createDataFrame([(k, " ".join(["w"] * n), s) for k, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
    want = fill_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order_sources(sizes))})
    got = {r["source"]: r for r in mixing.mix_sources(df).collect()}
    assert all(math.isclose(got[s]["target"], t, abs_tol=1e-9) and got[s]["source_size"] == sizes[s] for s, t in want.items())


def test_mixing_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 7)
    rng = random.Random(12)
    rows = [(rng.choice([None, None, 3, 3, 100 + k]), " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))), rng.choice(["x", "y", None])) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (collections.Counter(tuple(r) for r in mixing.mix_sources(d).collect()) for d in (df.coalesce(1), df.repartition(7)))
    assert one == two and sum(one.values()) == 120


def test_mixing(spark, docs, rows):
    got = mixing.mix_sources(docs).collect()
    size = {r["doc_id"]: len(WORDS.findall(r["text"])) for r in rows}
    source = {r["doc_id"]: r["source"] for r in rows}
    total = collections.Counter()
    for k, n in size.items():
        total[source[k]] += n
    names = order_sources(total)
    target = fill_targets(total, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)})
    taken = collections.Counter()
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[source[r["doc_id"]]] and math.isclose(r["target"], target[source[r["doc_id"]]])
        assert r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    longest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= 2 * longest for s in names)
    assert sum(taken.values()) <= sum(target.values()) < sum(taken.values()) + longest
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    # the plain version (one bin of shuffle keys): all copies by virtual finish time, taken while they fit
    keys = {r["doc_id"]: r["k"] for r in docs.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("k")).collect()}
    copies = []
    for s in names:
        cum = 0
        for k in sorted((k for k in size if source[k] == s), key=lambda k: (keys[k], k)):
            cum += size[k]
            copies += [((cum + c * total[s]) / target[s], k, c) for c in range(3) if size[k]]
    used, plain = 0, collections.Counter()
    for _, k, _ in sorted(copies):
        used += size[k]
        if used > sum(target.values()):
            break
        plain[k] += size[k]
    assert {k: plain[k] for k in size} == again


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_exact_dedup_keeps_one_row(spark, monkeypatch, hot):
    """Repeated rows and null ids too, whether groups count as hot or not."""
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot)
    monkeypatch.setattr(exact_dedup, "MAX_HOT", 10_000 if hot == 1 else 1)
    rows = [(5, "a"), (5, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "c"), (2, "d"), (3, None), (3, ""), (9, "e")]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert len(got) == len(rows) and set(kept.values()) == {1} and len(kept) == 6
    assert {(r["keep_id"], r["group_size"]) for r in got} == {(5, 4), (None, 2), (2, 1), (3, 2), (9, 1)}
    assert all(r["keep_id"] == r["doc_id"] for r in got if r["kept"])


@pytest.mark.parametrize("n", [1, 7, 300])
def test_binary_search_of_few(spark, n):
    rng = np.random.default_rng(n)
    code = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + rng.integers(0, 2, n, np.uint64)
    df = spark.createDataFrame([(k, int(c.astype(np.int64)), "x", 1) for k, c in enumerate(code)], "id long, code long, asked string, rank int")
    got = sorted(tuple(r) for r in binary_search.top_k(df, df.where("id % 100 = 0")).collect())
    want = [(q, r + 1, i, d) for q in range(0, n, 100) for r, (d, i) in enumerate(sorted((int(x), k) for k, x in enumerate(np.bitwise_count(code ^ code[q])))[:10])]
    assert got == want


def test_binary_search(spark):
    rng = np.random.default_rng(8)
    code = rng.integers(0, 1 << 63, 1500, np.uint64)
    code[:300] = code[0]
    code[300:600] = code[0] ^ (np.uint64(1) << rng.integers(0, 63, 300, np.uint64))
    df = spark.createDataFrame([(k, int(c.astype(np.int64))) for k, c in enumerate(code)], "id long, code long")
    got = collections.defaultdict(list)
    for r in binary_search.top_k(df, df.where("id % 50 = 0"), 10).orderBy("rank").collect():
        got[r["query_id"]].append((r["distance"], r["id"]))
    for q in range(0, 1500, 50):
        d = np.bitwise_count(code ^ code[q])
        assert got[q] == sorted((int(x), k) for k, x in enumerate(d))[:10]


def test_pipeline_stages(spark, docs):
    """Each stage against what it should keep of its own input."""
    columns, sf = docs.columns, "/root/testdata/sf0.001"
    one = corpus_pipeline.language_id(spark, docs, sf)
    verdict = {r["doc_id"]: r["lang_rejected"] for r in langid.identify(docs).collect()}
    assert one.columns == columns and sorted(r["doc_id"] for r in one.collect()) == sorted(k for k, v in verdict.items() if not v)
    two = corpus_pipeline.exact(spark, docs, sf)
    last = {}
    for r in docs.collect():
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    assert two.columns == columns and sorted(r["doc_id"] for r in two.collect()) == sorted(last.values())
    three = corpus_pipeline.near(spark, docs, sf)
    plain = brute_components({r["doc_id"]: r["text"] for r in docs.collect()})
    assert three.columns == columns and sorted(r["doc_id"] for r in three.collect()) == sorted({c for _, c in plain.values()})
    four = corpus_pipeline.mix(spark, docs, sf)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs).collect()}
    assert four.columns == columns and collections.Counter(r["doc_id"] for r in four.collect()) == collections.Counter({k: c for k, c in copies.items() if c})
    assert corpus_pipeline.tokenize(spark, docs, sf).count() == docs.count()


def test_pipeline_end_to_end(spark, docs, rows):
    """The whole pipeline against its stages put together in plain Python; the mix, of documents that tests of op9 hold, by its own operator."""
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    told = plain_languages(rows, langid.learn(docs))
    left = [r for r in rows if told[r["doc_id"]][1] >= langid.MARGIN and told[r["doc_id"]][0] != "und"]
    last = {}
    for r in left:
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    left = {r["doc_id"]: r["text"] for r in left if last[r["text"]] == r["doc_id"]}
    left = {k: left[k] for k in {c for _, c in brute_components(left).values()}}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs.where(F.col("doc_id").isin(*left))).collect()}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.TOKENIZER)
    want = {(k, len(library.encode(t, add_special_tokens=False).ids), hashlib.sha256(t.encode()).hexdigest()): copies[k] for k, t in left.items() if copies[k]}
    assert got == collections.Counter(want) and len(want) > 50


def plain_languages(rows, dictionaries):
    """Language and margin by compressing each text's blocks with each dictionary, without the operator."""
    import zstandard

    out = {}
    for r in rows:
        text = re.sub(r"[\W\d_]+", " ", (r["text"] or "").lower()).encode()
        size = {}
        for lang, content in dictionaries.items():
            how = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
            size[lang] = sum(len(how.compress(text[k : k + langid.BLOCK_BYTES])) for k in range(0, len(text), langid.BLOCK_BYTES))
        best, second = sorted((n, lang) for lang, n in size.items())[:2]
        out[r["doc_id"]] = (best[1], (second[0] - best[0]) / max(1, second[0])) if any(c.isalpha() for c in r["text"] or "") else ("und", 0.0)
    return out


def test_languages_agree_with_plain_compression(spark, docs, rows):
    got = {r["doc_id"]: r for r in queries.op4_language_id(spark, SF).collect()}
    for k, (lang, margin) in plain_languages(rows, langid.learn(docs)).items():
        assert got[k]["lang_pred"] == lang and math.isclose(got[k]["score"], margin)
