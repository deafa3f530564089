"""Gate: declarative rules that give flags, and a status from the flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.collections import truthy_field
from ..functions.text import number
from .fixed import DEPOSIT_CLASSES, DETAIL_FIELDS

AGE = (0.0, 4600.0)
LATITUDE, LONGITUDE = (-90.0, 90.0), (-180.0, 180.0)


def out_of_range(value: Column, bounds) -> Column:
    """Not between the bounds; NaN isn't either."""
    return value.isNotNull() & ~value.between(*map(F.lit, bounds))


def _flag(when: Column, label: str, value: Column | None = None) -> Column:
    return F.when(when, F.lit(label) if value is None else F.concat(F.lit(f"{label}="), value.cast("string")))


def _range_flags(name: str, raw: Column, bounds) -> Column:
    v = number(raw.cast("string"))
    bad = raw.isNotNull() & v.isNull()
    return F.coalesce(_flag(bad, f"FAIL:{name}_not_numeric", raw), _flag(out_of_range(v, bounds), f"FAIL:{name}_out_of_range", v))


def _age_flag(ages: Column) -> Column:
    """Of the first age that is out of range or no number."""
    text = F.transform(ages, lambda a: a.cast("string"))
    bad = F.filter(text, lambda a: a.try_cast("double").isNull() | ~a.try_cast("double").between(*map(F.lit, AGE)))
    first = F.try_element_at(bad, F.lit(1))
    n = number(first)
    none = F.size(bad) > 0
    return F.when(none & n.isNotNull(), F.concat(F.lit("WARN:age_out_of_range="), n.cast("string"))).when(none, F.concat(F.lit("WARN:age_not_numeric="), F.coalesce(first, F.lit("None"))))


def gate_flags(df: DataFrame) -> Column:
    """The flags of a record with the legacy columns; columns that df lacks count as null."""

    def col(name: str) -> Column:
        return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")

    pid = col("paper_id").cast("string")
    conf = number(col("deposit_type_conf").cast("string"))
    details = []
    for f in DETAIL_FIELDS:
        if f in df.columns:
            given = truthy_field(df, f)
            if df.schema[f].dataType.simpleString() == "string":
                given = given & ~F.lower(f).isin("null", "none", "")
            details.append(given)
    typed = col("deposit_type").isNotNull()
    flags = [
        _flag(col("deposit_class").isNotNull() & ~col("deposit_class").isin(*DEPOSIT_CLASSES), "WARN:unknown_deposit_class", col("deposit_class")),
        _range_flags("lat", col("coord_lat"), LATITUDE),
        _range_flags("lon", col("coord_lon"), LONGITUDE),
        _age_flag(F.col("ages_ma")) if "ages_ma" in df.columns else F.lit(None).cast("string"),
        F.coalesce(_flag(out_of_range(conf, (0.0, 1.0)), "WARN:conf_out_of_range", conf), _flag((conf < 0.5) & typed, "FLAG:low_confidence")),
        _flag(typed & ~F.greatest(F.lit(False), F.lit(False), *details), "FLAG:deposit_type_but_no_details"),
    ]
    return F.when(pid.isNull() | (F.trim(pid) == ""), F.array(F.lit("FAIL:no_paper_id"))).otherwise(F.array_compact(F.array(*flags)))


def gate_status(flags: Column | str) -> Column:
    """fail, warn or pass: whether any flag fails, any warns."""
    flags = F.col(flags) if isinstance(flags, str) else flags
    fails = F.exists(flags, lambda f: f.startswith("FAIL:"))
    warns = F.exists(flags, lambda f: f.startswith("WARN:") | f.startswith("FLAG:"))
    return F.when(fails, "fail").when(warns, "warn").otherwise("pass")


def gate(df: DataFrame, dedup: bool = True, order: str = "_ord") -> DataFrame:
    """df with _gate_flags and _gate_status; first of each id only if dedup."""
    from .dedup import keep_first_by_id

    rows = keep_first_by_id(df, order=order) if dedup else df
    return rows.withColumn("_gate_flags", gate_flags(rows)).withColumn("_gate_status", gate_status("_gate_flags"))


def gate_report(gated: DataFrame, status: str = "_gate_status") -> DataFrame:
    """Counts by status and the share that passes, 0 for no rows."""
    n = F.count("*")
    passed = F.count_if(F.col(status) == "pass")
    return gated.agg(n.alias("total"), passed.alias("passed"), F.count_if(F.col(status) == "warn").alias("warned"), F.count_if(F.col(status) == "fail").alias("failed"), F.when(n > 0, F.round(passed / n, 4)).otherwise(F.lit(0.0)).alias("pass_rate"))


def flag_histogram(gated: DataFrame, flags: str = "_gate_flags") -> DataFrame:
    return gated.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "flag")


def check_contract(values, required, forbidden=()) -> None:
    """Raise unless a vocabulary holds all required values and none of the forbidden ones."""
    values = set(values)
    missing, extra = set(required) - values, set(forbidden) & values
    if missing or extra:
        raise ValueError(f"vocabulary lacks {sorted(missing)}, must not hold {sorted(extra)}")
