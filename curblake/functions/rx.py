"""Regular expressions as Columns, with the matching rules of the by-law texts: no case, Unicode classes, `.` stops at line feeds only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAGS = "(?iuUd)"


def has(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(FLAGS + pattern), F.lit(False))


def group(c: Column, pattern: str, i: int = 1) -> Column:
    """Group ``i`` of the first match, null if there is none or the group took no part."""
    return F.nullif(F.regexp_extract(c, FLAGS + pattern, i), F.lit(""))


def sub(c: Column, *rewrites: tuple[str, str]) -> Column:
    """Ordered rewrites, each to all its matches."""
    return reduce(lambda t, r: F.regexp_replace(t, FLAGS + r[0], r[1]), rewrites, c)


def blank(c: Column) -> Column:
    """Null, NaN text aside: null or white space only."""
    return c.isNull() | (F.length(F.regexp_replace(c.cast("string"), r"(?U)\s+", "")) == 0)


def first(*cases: tuple[Column, Column], default: Column | None = None) -> Column:
    """The value of the first true case: an ordered decision list."""
    out = F.lit(None) if default is None else default
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def truthy(c: Column) -> Column:
    """Null for null and the empty string, so that alternatives are tried as with ``or``."""
    return F.when(c != "", c)


def norm_cell(c: Column) -> Column:
    """Key form of a cell: null to '', trimmed, without case."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")))


def unfused(value, build):  # noqa: ANN001, ANN201
    """``build(value)`` evaluated outside whole-stage code, whose methods a long decision list would outgrow."""
    return F.transform(F.array(value), build)[0]


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, however often later steps refer to them.

    A plain projection would be merged into its consumers, and a costly expression repeated in each.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
