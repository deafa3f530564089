"""Functions on arrays, maps, structs and JSON as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c: Column | str, kind: T.DataType) -> Column:
    """Whether a value counts as given: not null, "", 0, false, [] or {}."""
    c = _col(c)
    if isinstance(kind, T.StringType):
        test = c != ""
    elif isinstance(kind, T.BooleanType):
        test = c
    elif isinstance(kind, T.NumericType):
        test = c != 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def truthy_field(df, name: str) -> Column:
    """truthy() of a column by its type in df."""
    return truthy(F.col(f"`{name}`"), df.schema[name].dataType)


def join_first(c: Column | str, n: int | None = None, joint: str = ", ") -> Column:
    c = _col(c)
    return F.array_join(c if n is None else F.slice(c, 1, n), joint)


def item(c: Column | str, k: int, default: Column | str | None = None) -> Column:
    """The k-th item from 1, or from the end if negative; default where there is none."""
    found = F.try_element_at(_col(c), F.lit(k))
    return found if default is None else F.coalesce(found, F.lit(default) if isinstance(default, str) else default)


def with_any(c: Column | str, words) -> Column:
    """Items that contain one of the words, case aside."""
    pattern = "|".join(f"\\Q{w}\\E" for w in words)
    return F.filter(_col(c), lambda x: F.lower(x).rlike(pattern))


def categories(c: Column | str, groups: dict) -> Column:
    """Sorted names of the groups whose words occur in any item."""
    c = _col(c)
    return F.array_sort(F.array_compact(F.array(*[F.when(F.exists(c, _has(words)), F.lit(name)) for name, words in groups.items()])))


def _has(words):
    pattern = "|".join(f"\\Q{w}\\E" for w in words)
    return lambda x: F.lower(x).rlike(pattern)


def ngrams(tokens: Column | str, longest: int = 3) -> Column:
    """All runs of 1 to longest tokens, longest first at each place, joined by a space."""
    tokens = _col(tokens)
    sizes = F.sequence(F.lit(longest), F.lit(1), F.lit(-1))
    places = F.when(F.size(tokens) > 0, F.sequence(F.lit(1), F.size(tokens))).otherwise(F.array().cast("array<int>"))
    runs = F.transform(places, lambda i: F.transform(F.filter(sizes, lambda n: i + n - 1 <= F.size(tokens)), lambda n: F.array_join(F.slice(tokens, i, n), " ")))
    return F.flatten(runs)


def parse_loose(c: Column | str, schema: str) -> Column:
    """The object between the outer braces of a text by a schema; nulls where it isn't JSON."""
    from .text import braced_object

    return F.from_json(braced_object(c), schema, {"mode": "PERMISSIVE"})


def canonical_json(df, leave_out=()) -> Column:
    """A record as JSON text with keys in order; nulls are written, so null differs from absent only where the columns differ."""
    names = sorted(c for c in df.columns if not c.startswith("_") and c not in leave_out)
    return F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})


def canonical_raw(raw: Column | str, leave_out=("paper_id",)) -> Column:
    """Raw JSON text of a record with its keys in order and without those left out or starting with _; absent and null keys differ."""
    fields = F.try_parse_json(_col(raw)).cast("map<string,variant>")
    kept = F.map_filter(fields, lambda k, v: ~k.startswith("_") & ~k.isin(*leave_out))
    ordered = F.array_sort(F.transform(F.map_keys(kept), lambda k: k))
    return F.concat(F.lit("{"), F.array_join(F.transform(ordered, lambda k: F.concat(F.lit('"'), k, F.lit('":'), F.coalesce(F.to_json(F.try_element_at(kept, k)), F.lit("null")))), ","), F.lit("}"))


def set_default(c: Column | str, default: Column, name: str, value: Column) -> Column:
    """A struct, or default where it is null, with one field set."""
    return F.coalesce(_col(c), default).withField(name, value)


def appended(c: Column | str, *flags: Column) -> Column:
    """An array of strings with those flags appended that aren't null."""
    return F.concat(F.coalesce(_col(c), F.array().cast("array<string>")), F.array_compact(F.array(*flags)))
