"""String functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def fold_dashes(c: Column | str) -> Column:
    """Lower case with en, em and figure dashes as hyphens."""
    return F.lower(F.translate(_col(c), "–—‒", "---"))


def squeeze(c: Column | str) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(_col(c), r"\s+", " ")))


def contains_either(a: Column | str, b: Column | str) -> Column:
    return F.contains(_col(a), _col(b)) | F.contains(_col(b), _col(a))


def any_of(c: Column | str, words) -> Column:
    """Whether any of the literal words is in c: one regular expression, words quoted."""
    return _col(c).rlike("|".join(sorted(f"\\Q{w}\\E" for w in words)))


def first_of(c: Column | str, words) -> Column:
    """The first word of the list that c contains."""
    return F.coalesce(*[F.when(F.contains(_col(c), F.lit(w)), F.lit(w)) for w in words])


def split_words(c: Column | str) -> Column:
    """Pieces between white space, dashes, underscores, slashes, full stops, brackets and list marks."""
    return F.split(_col(c), r"[\s\-_/\.\(\),;:]+")


def head(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def braced_object(c: Column | str) -> Column:
    """From the first opening to the last closing brace; null if there is none."""
    return F.nullif(F.regexp_extract(_col(c), r"\{[\s\S]*\}", 0), F.lit(""))


def bracketed_list(c: Column | str) -> Column:
    """From the first opening to the last closing bracket, so that brackets within strings don't end it."""
    return F.nullif(F.regexp_extract(_col(c), r"\[[\s\S]*\]", 0), F.lit(""))


def unfence(c: Column | str) -> Column:
    """Without a Markdown code fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(_col(c)), r"^```(?:html|json)?\s*\n?", ""), r"\n?```\s*$", ""))


REFERENCE_MARKERS = ("# References", "## References", "# REFERENCES")


def cut_at_first_listed(c: Column | str, markers=REFERENCE_MARKERS) -> Column:
    """Cut at the first marker of the list that occurs after the text's start, wherever other markers are."""
    c = _col(c)
    return F.coalesce(*[F.when(F.instr(c, m) > 1, F.substring_index(c, m, 1)) for m in markers], c)


def cut_at_earliest(c: Column | str, markers=REFERENCE_MARKERS) -> Column:
    """Cut at whichever marker comes first after the text's start."""
    c = _col(c)
    for m in markers:
        c = F.when(F.instr(c, m) > 1, F.substring_index(c, m, 1)).otherwise(c)
    return c


def title_case(c: Column | str) -> Column:
    """Upper case after anything that isn't a letter, lower case after letters (also after hyphens and digits)."""
    pieces = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def capitalized(c: Column | str) -> Column:
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def without_trailing(c: Column | str, mark: str = ".") -> Column:
    return F.rtrim(_col(c), F.lit(mark))


def article(c: Column | str) -> Column:
    """'an' before a vowel letter, else 'a'."""
    return F.when(F.lower(F.left(_col(c), F.lit(1))).isin(*"aeiou"), "an").otherwise("a")


def number(c: Column | str) -> Column:
    """A double, or null where the text isn't one."""
    return _col(c).try_cast("double")


def not_number(c: Column | str) -> Column:
    """Given but not a number."""
    return _col(c).isNotNull() & _col(c).try_cast("double").isNull()


def planar_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance on a plane of 111 km a degree, longitudes shortened by a fifth."""
    a, b, c, d = map(_col, (lat1, lon1, lat2, lon2))
    return F.sqrt(F.pow((a - c) * 111, F.lit(2)) + F.pow((b - d) * 111 * 0.8, F.lit(2)))


#: Device names that file systems reserve.
RESERVED = ("CON", "PRN", "AUX", "NUL", *(f"COM{k}" for k in range(1, 10)), *(f"LPT{k}" for k in range(1, 10)))
LONGEST_NAME = 200


def safe_name(c: Column | str) -> Column:
    """A file name from an id: no way up, no separators, no reserved device, letters of file names only, at most 200 characters."""
    c = _col(c)
    s = F.replace(F.replace(c, F.lit("../"), F.lit("")), F.lit("..\\"), F.lit(""))
    s = F.translate(s, "/\\\0", "__")
    stem = F.upper(F.substring_index(s, ".", 1))
    s = F.when(stem.isin(*RESERVED), F.concat(F.lit("file_"), s)).otherwise(s)
    s = head(F.regexp_replace(s, r"[^A-Za-z0-9_\-. ]", "_"), LONGEST_NAME)
    return F.when(c.isNull() | (c == ""), "unknown").otherwise(s)


def base_name(c: Column | str) -> Column:
    return F.regexp_extract(_col(c), r"([^/\\]*)$", 1)


def stem(c: Column | str) -> Column:
    """The base name without its last extension."""
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]*$", "")


def short_id(*parts: Column | str, n: int = 12, joint: str = "::") -> Column:
    """The first n hex digits of the MD5 of the parts."""
    return head(F.md5(F.concat_ws(joint, *parts)), n)


def fill(template: str, **slots: Column | str) -> Column:
    """A template's {name} slots filled with columns; null if one is null."""
    import re

    parts = []
    for k, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if k % 2:
            parts.append(_col(slots[piece]).cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
