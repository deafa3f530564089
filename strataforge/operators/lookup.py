"""Lookups of records in dimensions: exact, contained, n-gram, box, radius and polygon, each giving one best entry.

Containment is found by equi-joins: a key that a text contains has words or letters that the text has too, so texts and keys meet on these
and are compared only then, and Spark's size estimates tell whether a side is broadcast.  Where the keys are few they are broadcast and
compared with every text instead.  exact_or_contained() counts its names and broadcasts by that, not by estimates.  Dimensions that meet points or keywords by other conditions are broadcast while they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.collections import ngrams
from ..functions.text import contains_either, fold_dashes, planar_km, split_words, squeeze
from .fixed import STOPWORDS


#: Dimensions of at most this many rows are broadcast where no equality can join them.
SMALL_DIMENSION = 20_000


def small(dim: DataFrame, rows: int | None = None) -> DataFrame:
    """dim with a broadcast hint if it is known, or counted, to be small."""
    n = dim.count() if rows is None else rows
    return F.broadcast(dim) if n <= SMALL_DIMENSION else dim


#: Keys of at most this many rows are compared with every text, which costs less than cutting each text into its words and letters.
FEW_KEYS = 100


def few(keys: DataFrame) -> bool:
    return keys.limit(FEW_KEYS + 1).count() <= FEW_KEYS


#: Characters of names up to which a side that is counted to be small is broadcast.
SMALL_CHARS = 2_000_000


def _sent(side: DataFrame, rows: int, chars: int) -> DataFrame:
    """A counted side of an equi-join, broadcast if it is small, else sorted and merged whatever Spark takes its size for."""
    return F.broadcast(side) if rows <= SMALL_DIMENSION and chars <= SMALL_CHARS else side.hint("merge")


def first_entries(dim: DataFrame, *by: str) -> DataFrame:
    """The first row, by order, for each value of some columns; rows without a place in the order come last."""
    return dim.groupBy(*by).agg(F.min_by(F.struct(*dim.columns), _place()).alias("_first")).select("_first.*")


def _place(*before: Column) -> Column:
    return F.struct(*[b.alias(f"b{k}") for k, b in enumerate(before)], F.col("ord").isNull().alias("last"), F.col("ord").alias("at"))


def _runs(items: Column, n: int, between: str) -> Column:
    """The distinct runs of n consecutive items, joined: the items put beside those that come 1, 2, ... places later, so that items is made n times, not once a run."""
    left = F.greatest(F.size(items) - (n - 1), F.lit(0))
    out = F.slice(items, F.lit(1), left)
    for k in range(2, n + 1):
        out = F.zip_with(out, F.slice(items, F.lit(k), left), lambda x, y: F.concat(x, F.lit(between), y))
    return F.array_distinct(out)


def contained(texts: DataFrame, text: str, keys: DataFrame, key: str) -> DataFrame:
    """Each row of texts with each row of keys whose key its text contains, with the columns of both.

    Cut at spaces, the inner words of a key are whole words of any text that contains it, in the same order.  So keys of five words and more
    meet the texts on their second to fourth word, those of three and four on their second, shorter ones on their first three letters.  An
    empty key is contained in nothing here.
    """
    word, size = F.split(F.col(key), " "), F.size(F.split(F.col(key), " "))
    words, letters = F.split(F.col(text), " "), F.split(F.col(text), "")
    kinds = [
        (size >= 5, F.array_join(F.slice(word, 2, 3), " "), _runs(words, 3, " ")),
        (size.between(3, 4), word[1], F.array_distinct(words)),
        *((((size < 3) & (F.length(key) == n if n < 3 else F.length(key) >= 3)), F.substring(key, 1, n), _runs(letters, n, "")) for n in (1, 2, 3)),
    ]
    out = None
    for which, anchor, found in kinds:
        met = texts.withColumn("_anchor", F.explode(found)).join(keys.where(which).withColumn("_anchor", anchor), "_anchor")
        met = met.where(F.contains(F.col(text), F.col(key))).drop("_anchor")
        out = met if out is None else out.unionByName(met)
    return out


def each_pair(texts: DataFrame, text: str, keys: DataFrame, key: str, either: bool = False) -> DataFrame:
    """As contained(), with either also texts that a key contains: every text compared with every key."""
    meets = contains_either(text, key) if either else F.contains(F.col(text), F.col(key))
    return texts.where(F.col(text) != "").join(F.broadcast(keys.where(F.col(key) != "")), meets)


def by_anchors(texts: DataFrame, text: str, keys: DataFrame, key: str, either: bool = False) -> DataFrame:
    """As each_pair() by equi-joins; with either a pair can come twice."""
    out = contained(texts, text, keys, key)
    return out.unionByName(contained(keys, key, texts, text)) if either else out


def compared(texts: DataFrame, text: str, keys: DataFrame, key: str, either: bool = False) -> DataFrame:
    return (each_pair if few(keys) else by_anchors)(texts, text, keys, key, either)


def overlay(base: DataFrame, over: DataFrame, key: str = "name") -> DataFrame:
    """Entries of both, those of over winning; an entry keeps the place of its key's first occurrence."""
    both = base.withColumn("_layer", F.lit(0)).unionByName(over.withColumn("_layer", F.lit(1)), allowMissingColumns=True)
    values = [c for c in both.columns if c not in (key, "ord", "_layer")]
    best = both.groupBy(key).agg(F.max_by(F.struct(*values), F.struct("_layer", "ord")).alias("v"), F.min(F.struct("_layer", "ord")).alias("at"))
    return best.select(key, *[F.col(f"v.{c}").alias(c) for c in values], F.struct("at._layer", "at.ord").alias("_at")).withColumn("ord", F.row_number().over(W.orderBy("_at")) - 1).drop("_at")


def first_contained(df: DataFrame, text: Column, dim: DataFrame, key: str = "name", row_id: str = "_ord") -> DataFrame:
    """(row_id, hit): the first entry, by the dimension's order, whose folded key the text contains."""
    left = df.select(F.col(row_id), text.alias("_text"))
    hits = contained(left, "_text", dim.withColumn("_key", fold_dashes(key)).where("_key <> ''"), "_key")
    return hits.groupBy(row_id).agg(F.min_by(F.struct(*dim.columns), "ord").alias("hit"))


def longest_contained(df: DataFrame, text: Column, dim: DataFrame, key: str = "alias", either: bool = True, row_id: str = "_ord") -> DataFrame:
    """(row_id, hit, exact): an entry whose key is the text, else the longest key contained either way, the first among equals."""
    left = df.select(F.col(row_id), squeeze(text).alias("_text")).where("_text <> ''")
    right = dim.withColumn("_key", squeeze(key)).where("_key <> ''")
    hits = contained(left, "_text", right, "_key")
    if either:
        hits = hits.unionByName(contained(right, "_key", left, "_text"))
    hits = hits.withColumn("_exact", F.col("_text") == F.col("_key"))
    best = F.struct(F.col("_exact").cast("int").alias("e"), F.length("_key").alias("n"), (-F.col("ord")).alias("o"))
    return hits.groupBy(row_id).agg(F.max_by(F.struct(*dim.columns), best).alias("hit"), F.max("_exact").alias("exact"))


def exact_or_contained(df: DataFrame, text: Column, dim: DataFrame, key: str = "name", row_id: str = "_ord") -> DataFrame:
    """(row_id, hit, exact): by equality, and only for what has none by containment either way, first by order.

    Of entries with one key only the first can win, and rows with one text win the same: where the keys are many, distinct ones meet distinct texts.
    """
    left = df.select(F.col(row_id), fold_dashes(text).alias("_text")).where("_text <> ''")
    right = dim.withColumn("_key", fold_dashes(key)).where("_key <> ''")
    if few(right.select("_key").distinct()):
        hits = each_pair(left, "_text", first_entries(right, "_key"), "_key", either=True)
        hits = hits.select(row_id, F.struct(*dim.columns).alias("hit"), (F.col("_text") == F.col("_key")).alias("exact"), "ord")
    else:
        hits = _by_names(left, right.select("_key", F.struct(*dim.columns).alias("hit"), "ord")).select(row_id, "hit", "exact", "hit.ord")
    best = hits.groupBy(row_id).agg(F.min_by(F.struct("hit", "exact"), _place(~F.col("exact"))).alias("b"))
    return best.select(row_id, "b.hit", "b.exact")


def _by_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """left, of each text in _text, with the hit of its name: of equal ones the first (_key, hit, ord) of right, else the first contained either way.

    Names are counted before they meet: Spark's estimates are of compressed files, and by them it would send the driver millions of short
    names.  Where every text has its equal, nothing is cut into words and letters.
    """
    both = right.withColumn("_at", _place()).unionByName(left.select(F.col("_text").alias("_key")), allowMissingColumns=True)
    names = both.groupBy("_key").agg(F.min_by("hit", "_at").alias("hit"), F.max(F.col("_at").isNull()).alias("_asked"))
    entry, missed = F.col("hit").isNotNull(), F.col("hit").isNull()
    n_keys, key_chars, n_rest, rest_chars = (n or 0 for n in names.agg(*[f(F.when(w, F.length("_key"))) for w in (entry, missed) for f in (F.count, F.sum)]).first())
    best = names.where(entry & F.col("_asked")).select(F.col("_key").alias("_text"), "hit", F.lit(True).alias("exact"))
    if n_rest:
        keys, rest = names.where(entry).select("_key", "hit"), names.where(missed).select(F.col("_key").alias("_text"))
        near = contained(rest, "_text", _sent(keys, n_keys, key_chars), "_key").unionByName(contained(keys, "_key", _sent(rest, n_rest, rest_chars), "_text"))
        first = near.withColumn("ord", F.col("hit.ord")).groupBy("_text").agg(F.min_by("hit", _place()).alias("hit"))
        best = best.unionByName(first.withColumn("exact", F.lit(False)))
    return left.join(_sent(best, n_keys + n_rest, key_chars + rest_chars), "_text")


def first_of_array(df: DataFrame, items: str, dim: DataFrame, key: str, row_id: str = "_ord") -> DataFrame:
    """(row_id, hit): of the first item of an array that the dimension has."""
    left = df.select(F.col(row_id), F.posexplode(items).alias("_pos", "_item"))
    return left.join(dim, F.col("_item") == F.col(key)).groupBy(row_id).agg(F.min_by(F.struct(*dim.columns), "_pos").alias("hit"))


def country_fits(claimed: Column, country: Column) -> Column:
    """Any claimed country contains the entry's or is contained in it; an entry without one fits all."""
    own = F.lower(F.coalesce(country, F.lit("")))
    return F.exists(claimed, lambda c: F.contains(own, c) | F.contains(c, own))


def claimed_countries(c: Column | str) -> Column:
    return F.array_distinct(F.transform(F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))))


def named_in(df: DataFrame, text: Column, countries: Column, dim: DataFrame, key: str = "name", row_id: str = "_ord") -> DataFrame:
    """(row_id, hit): the first entry whose name is in the text and whose country fits, if countries are claimed.

    Whether the country fits is told while grouping: a filter above the join can be put below it by Spark 4.1, where the country isn't known.
    """
    left = df.select(F.col(row_id), text.alias("_text"), countries.alias("_claimed"))
    right = first_entries(dim.withColumn("_key", F.lower(key)).where("_key <> ''"), "_key", "country")
    fits = (F.size("_claimed") == 0) | country_fits(F.col("_claimed"), F.col("country"))
    hits = compared(left, "_text", right, "_key")
    return hits.groupBy(row_id).agg(F.min_by(F.struct(*dim.columns), F.when(fits, _place())).alias("hit")).where(F.col("hit").isNotNull())


def long_words(text: Column, least: int = 5, stopwords=STOPWORDS) -> Column:
    stop = F.array(*map(F.lit, stopwords))
    return F.filter(split_words(text), lambda w: (F.length(w) >= least) & ~F.array_contains(stop, w))


def phrase_index(dim: DataFrame, key: str = "name", longest: int = 3, least: int = 5, stopwords=STOPWORDS) -> DataFrame:
    """(phrase, and dim's columns): an entry under its lower-case name and each run of up to three of its words that is long enough and no stopword."""
    low = F.lower(key)
    stop = F.array(*map(F.lit, stopwords))
    runs = F.filter(ngrams(F.filter(F.split(low, r"\s+"), lambda w: w != ""), longest), lambda p: (F.length(p) >= least) & ~F.array_contains(stop, p))
    return dim.withColumn("phrase", F.explode(F.array_distinct(F.concat(F.array(low), runs))))


def trusted_entries(dim: DataFrame, keywords: DataFrame, known: DataFrame, key: str = "name") -> DataFrame:
    """Entries whose name contains a trusted keyword and isn't known already."""
    hits = dim.join(small(keywords), F.contains(F.lower(key), F.col("keyword")), "left_semi")
    return hits.join(small(known.select(key)), key, "left_anti")


def match_phrases(df: DataFrame, text: Column, countries: Column, dim: DataFrame, keywords: DataFrame, key: str = "name", row_id: str = "_ord", least: float = 0.6) -> DataFrame:
    """(row_id, hit, phrase, score): the entry with the best share of its name in the record's text.

    Candidates are trusted keywords that the text contains and runs of one to three of its longer words without stopwords, looked up
    in the phrase index by equality.  Claimed countries must fit; without any, the phrase must be a trusted keyword.  The full name
    adds 0.3.  The best score wins, then the longer phrase, the phrase, and the entry's order.
    """
    low = F.lower(text)
    stop = F.array(*map(F.lit, STOPWORDS))
    left = df.select(F.col(row_id), low.alias("_text"), countries.alias("_claimed"))
    tokens = left.select(row_id, "_claimed", long_words(F.col("_text")).alias("_tokens"))  # a column: within ngrams() they were made anew for each run
    grams = tokens.select(row_id, "_claimed", F.explode(F.array_distinct(ngrams("_tokens"))).alias("phrase"))
    trusted = keywords.select(F.lower("keyword").alias("_kw")).distinct()
    named = compared(left, "_text", trusted.where("_kw <> ''"), "_kw").select(row_id, "_claimed", F.col("_kw").alias("phrase"))
    found = grams.unionByName(named).where(~F.array_contains(stop, F.col("phrase")))
    index = phrase_index(first_entries(dim, key, "country"), key).join(small(trusted), F.col("phrase") == F.col("_kw"), "left")
    hits = found.join(small(index), "phrase")
    ok = F.when(F.size("_claimed") > 0, country_fits(F.col("_claimed"), F.col("country"))).otherwise(F.col("_kw").isNotNull())
    score = F.length("phrase") / F.greatest(F.length(key), F.lit(1)) + F.when(F.col("phrase") == F.lower(key), 0.3).otherwise(0.0)
    rank = F.struct("score", F.length("phrase").alias("n"), F.col("phrase"), (-F.col("ord")).alias("o"))
    best = hits.withColumn("score", score).groupBy(row_id).agg(F.max_by(F.struct(F.struct(*dim.columns).alias("hit"), "phrase", "score"), F.when(ok, rank)).alias("b"))
    return best.select(row_id, "b.hit", "b.phrase", "b.score").where(F.col("score") >= least)


def match_ratio(df: DataFrame, words: Column, countries: Column, dim: DataFrame, key: str = "name", row_id: str = "_ord", least: float = 0.4) -> DataFrame:
    """(row_id, hit, score): the entry whose name shares the greatest ratio of length with a word, contained either way."""
    left = df.select(F.col(row_id), countries.alias("_claimed"), F.explode(F.array_distinct(words)).alias("_word"))
    right = first_entries(dim.withColumn("_key", F.lower(key)).where("_key <> ''"), "_key", "country")
    fits = (F.size("_claimed") == 0) | (F.coalesce(F.col("country"), F.lit("")) == "") | country_fits(F.col("_claimed"), F.col("country"))
    hits = compared(left.where("_word <> ''"), "_word", right, "_key", either=True).withColumn("score", F.length("_word") / F.length("_key"))
    rank = F.when(fits, F.struct("score", (-F.col("ord")).alias("o")))
    best = hits.groupBy(row_id).agg(F.max_by(F.struct(F.struct(*dim.columns).alias("hit"), "score"), rank).alias("b"))
    return best.select(row_id, "b.hit", "b.score").where(F.col("score") > least)


def boxes_around(df: DataFrame, lat: Column, lon: Column, boxes: DataFrame, row_id: str = "_ord") -> DataFrame:
    """(row_id, countries): all boxes that hold the point, by the boxes' order."""
    left = df.select(F.col(row_id), lat.alias("_lat"), lon.alias("_lon"))
    hits = left.join(small(boxes), F.col("_lat").between(F.col("lat_lo"), F.col("lat_hi")) & F.col("_lon").between(F.col("lon_lo"), F.col("lon_hi")))
    return hits.groupBy(row_id).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "country"))), lambda x: x["country"]).alias("countries"))


def within_radius(df: DataFrame, lat: Column, lon: Column, circles: DataFrame) -> DataFrame:
    """df joined with the circles that hold its point, with distance_km; circles prune by a box first."""
    left = df.withColumns({"_lat": lat, "_lon": lon})
    box = (F.abs(F.col("_lat") - F.col("lat")) <= F.col("radius_km") / 111) & (F.abs(F.col("_lon") - F.col("lon")) <= F.col("radius_km") / (111 * 0.8))
    hits = left.join(small(circles), box).withColumn("distance_km", planar_km("_lat", "_lon", "lat", "lon"))
    return hits.where("distance_km <= radius_km").drop("_lat", "_lon")


def in_ring(ring: Column, lon: Column, lat: Column) -> Column:
    """Whether a point is inside a ring of (lon, lat) structs: a ray to the east crosses its edges an odd number of times."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    edges = F.zip_with(F.slice(closed, F.lit(1), F.size(ring)), F.slice(closed, F.lit(2), F.size(ring)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < (b["lon"] - a["lon"]) * (lat - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"])

    return F.size(F.filter(edges, crossed)) % 2 == 1


def containing_polygon(df: DataFrame, lat: Column, lon: Column, polygons: DataFrame, row_id: str = "_ord") -> DataFrame:
    """(row_id, country): the first polygon (ord, country, ring) that holds the point; its bounding box is tested first."""
    shapes = polygons.withColumns({f"_{n}_{k}": f(F.transform("ring", _part(n))) for n in ("lat", "lon") for k, f in (("lo", F.array_min), ("hi", F.array_max))})
    left = df.select(F.col(row_id), lat.alias("_lat"), lon.alias("_lon"))
    near = left.join(small(shapes), F.col("_lat").between(F.col("_lat_lo"), F.col("_lat_hi")) & F.col("_lon").between(F.col("_lon_lo"), F.col("_lon_hi")))
    return near.where(in_ring(F.col("ring"), F.col("_lon"), F.col("_lat"))).groupBy(row_id).agg(F.min_by("country", "ord").alias("country"))


def _part(name: str):
    return lambda p: p[name]


def rounded_place(df: DataFrame, lat: Column, lon: Column, places: DataFrame) -> DataFrame:
    """df with country from a table (lat2, lon2, country) of places rounded to two decimals."""
    keyed = df.withColumns({"lat2": F.round(lat, 2), "lon2": F.round(lon, 2)})
    return keyed.join(places.select("lat2", "lon2", "country"), ["lat2", "lon2"], "left").drop("lat2", "lon2")
