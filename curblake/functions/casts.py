"""Casts that give null in place of an error, values that must agree, and rules by region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curblake.functions.rx import has

# Fixed values (D25): former municipality -> prohibited times and by-law of its winter rule.
REGIONAL_WINTER_RULES = {
    "SCARBOROUGH": ("2:00 a.m. to 6:00 a.m. from Nov. 1 to Mar. 31", "Scarborough Code § 214-34"),
    "ETOBICOKE": ("2:00 a.m. to 6:00 a.m. from Oct. 16 to Apr. 14", "Etobicoke Code § 240-27"),
    "NORTH YORK": ("2:00 a.m. to 6:00 a.m. from Dec. 1 to Mar. 31", "Toronto Municipal Code § 950-400D(9)"),
}


def regional_winter_rule(municipality: Column) -> Column:
    """Struct (times, bylaw) of a former municipality's winter rule, in any case; null elsewhere."""
    name, out = F.upper(municipality), F.lit(None).cast("struct<times:string,bylaw:string>")
    for place, (times, bylaw) in REGIONAL_WINTER_RULES.items():
        out = F.when(name == place, F.struct(F.lit(times).alias("times"), F.lit(bylaw).alias("bylaw"))).otherwise(out)
    return out


def unique_or_null(value: str) -> Column:
    """an aggregate: the only value that isn't null or empty; null if there are none or several."""
    v = F.nullif(F.col(value), F.lit(""))
    return F.when(F.min(v) == F.max(v), F.min(v))


def safe_float(text: Column) -> Column:
    """a number in text, white space around it allowed; null if it isn't one."""
    return F.trim(text).try_cast("double")


def safe_int(text: Column) -> Column:
    """a whole number in text; "7.9" isn't one."""
    return F.when(has(text, r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("long"))


def flag(text: Column) -> Column:
    """1 for any text, 0 for none and for the empty one."""
    return F.coalesce(F.length(text) > 0, F.lit(False)).cast("int")
