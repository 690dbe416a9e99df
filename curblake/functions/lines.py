"""Linear referencing on polylines held as array<struct<x, y>> in metres (L04-L08, L10, L12, L13, L16, L17, G03, G04, C02, C06, C13), all Columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.functions.rx import computed

POINT = "struct<x:double,y:double>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def distance(p: Column, q: Column) -> Column:
    return F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))


def segments(line: Column) -> Column:
    """array<struct<p, q, at, m>>: the segments of two points or more, with the distance at which each begins, and its length."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(line) - 1, F.lit(1))), lambda i: F.struct(F.get(line, i - 1).alias("p"), F.get(line, i).alias("q")))
    start = F.struct(F.lit(0.0).alias("at"), F.array().cast(f"array<struct<p:{POINT},q:{POINT},at:double,m:double>>").alias("out"))
    return F.aggregate(
        F.filter(pairs, lambda s: s["q"].isNotNull()), start,
        lambda a, s: F.struct((a["at"] + distance(s["p"], s["q"])).alias("at"), F.concat(a["out"], F.array(F.struct(s["p"].alias("p"), s["q"].alias("q"), a["at"].alias("at"), distance(s["p"], s["q"]).alias("m")))).alias("out")), lambda a: a["out"],
    )


@dataclass(frozen=True)
class Measured:
    """A line whose segments and length are columns already; all functions here take one in place of a line."""

    line: Column
    segments: Column
    length: Column


def measured(df: DataFrame, line: str = "line") -> tuple[DataFrame, Measured]:
    """``df`` with the line's segments and length computed once a row (columns _segments and _length)."""
    df = computed(df, _segments=segments(F.col(line)))
    df = computed(df, _length=F.aggregate("_segments", F.lit(0.0), lambda t, s: t + s["m"]))
    return df, Measured(F.col(line), F.col("_segments"), F.col("_length"))


def _pieces(line: Column | Measured) -> Column:
    return line.segments if isinstance(line, Measured) else segments(line)


def _points(line: Column | Measured) -> Column:
    return line.line if isinstance(line, Measured) else line


def length(line: Column | Measured) -> Column:
    if isinstance(line, Measured):
        return line.length
    return F.aggregate(segments(line), F.lit(0.0), lambda t, s: t + s["m"])


def interpolate(line: Column | Measured, at: Column) -> Column:
    """The point ``at`` metres along; clamped to the ends."""
    on = F.slice(F.filter(_pieces(line), lambda s: (s["at"] + s["m"] >= at) & (s["m"] > 0)), 1, 1)

    def place(s: Column) -> Column:
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (at - s["at"]) / s["m"]))
        return point(s["p"]["x"] + t * (s["q"]["x"] - s["p"]["x"]), s["p"]["y"] + t * (s["q"]["y"] - s["p"]["y"]))

    return F.coalesce(F.get(F.transform(on, place), F.lit(0)), F.element_at(_points(line), -1))


def nearest(line: Column | Measured, p: Column) -> Column:
    """struct<d, at>: distance of the point from the line, and the place along it; the first of equally near places."""

    def one(s: Column) -> Column:
        dx, dy = s["q"]["x"] - s["p"]["x"], s["q"]["y"] - s["p"]["y"]
        long = dx * dx + dy * dy
        t = F.when(long > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - s["p"]["x"]) * dx + (p["y"] - s["p"]["y"]) * dy) / long))).otherwise(0.0)
        foot = point(s["p"]["x"] + t * dx, s["p"]["y"] + t * dy)
        return F.struct(distance(p, foot).alias("d"), (s["at"] + t * F.sqrt(long)).alias("at"))

    return F.array_min(F.transform(_pieces(line), one))


def project(line: Column | Measured, p: Column) -> Column:
    return nearest(line, p)["at"]


def clamp(line: Column | Measured, at: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(length(line), at))


def substring(line: Column | Measured, d0: Column, d1: Column) -> Column:
    """The part between two places, in the line's direction."""
    lo, hi = F.least(clamp(line, d0), clamp(line, d1)), F.greatest(clamp(line, d0), clamp(line, d1))
    inner = F.transform(F.filter(_pieces(line), lambda s: (s["at"] > lo) & (s["at"] < hi)), lambda s: s["p"])
    return F.concat(F.array(interpolate(line, lo)), inner, F.array(interpolate(line, hi)))


def tangent(line: Column | Measured, at: Column, reach: float = 1.0) -> Column:
    a, b = interpolate(line, clamp(line, at - reach)), interpolate(line, clamp(line, at + reach))
    return point(b["x"] - a["x"], b["y"] - a["y"])


def compass_vector(word: Column) -> tuple[Column, Column]:
    w = F.lower(word)
    return F.when(w == "east", 1.0).when(w == "west", -1.0).otherwise(0.0), F.when(w == "north", 1.0).when(w == "south", -1.0).otherwise(0.0)


def offset_sign(line: Column | Measured, at: Column, word: Column) -> Column:
    """+1 if the line runs the compass word's way at the place, else -1; +1 for other words."""
    x, y = compass_vector(word)
    t = tangent(line, at)
    return F.when(t["x"] * x + t["y"] * y >= 0, 1.0).otherwise(-1.0)


def signed_offset(line: Column | Measured, at: Column, metres: Column, word: Column) -> Column:
    """Clamped."""
    return clamp(line, at + offset_sign(line, at, word) * metres)


def reflected_offset(line: Column | Measured, at: Column, metres: Column, word: Column) -> Column:
    """An offset that overshoots the line goes the other way, at 0 at least."""
    sign = offset_sign(line, at, word)
    raw = at + sign * metres
    return F.when((raw < 0) | (raw > length(line)), F.greatest(F.lit(0.0), at - sign * metres)).otherwise(raw)


def relative_extension(line: Column | Measured, at: Column, d1: Column, d2: Column, word: Column) -> tuple[Column, Column]:
    """Both ends of "d1 metres, and d2 metres further"; when the far end is clamped onto the near one, the span ends at the line's end."""
    near, far = signed_offset(line, at, d1, word), signed_offset(line, at, d1 + d2, word)
    stuck = F.abs(near - far) < 0.001
    return F.when(stuck, clamp(line, far - offset_sign(line, at, word) * d2)).otherwise(near), far


def point_zone(line: Column | Measured, at: Column, zone: float = 5.0) -> tuple[Column, Column]:
    """A zone of that length around a place, shifted to lie inside the line."""
    long = length(line)
    lo = F.greatest(F.lit(0.0), F.least(at - zone / 2, long - zone))
    return lo, F.least(long, lo + zone)


def terminus(line: Column | Measured, word: Column, samples: int = 20) -> Column:
    """The place of the line's extreme sample towards a compass word; of a diagonal one east and west count first."""
    w = F.lower(word)
    score = lambda p: F.when(w.contains("east"), p["x"]).when(w.contains("west"), -p["x"]).when(w.contains("north"), p["y"]).otherwise(-p["y"])
    places = F.transform(F.sequence(F.lit(0), F.lit(samples)), lambda i: F.struct((-score(interpolate(line, length(line) * i / samples))).alias("s"), i.alias("i")))
    return F.array_min(places)["i"] * length(line) / samples


def chainage(line: Column | Measured, step: float = 2.0) -> Column:
    """Places every ``step`` metres or less, three at least."""
    n = F.greatest(F.lit(3), (F.floor(length(line) / step) + 1).cast("int"))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: length(line) * i / (n - 1))


def compass8(dx: Column, dy: Column) -> Column:
    """The 8-way compass word of a displacement."""
    names = F.array(*map(F.lit, ("north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest")))
    sector = F.floor(F.pmod(F.degrees(F.atan2(dx, dy)) + 22.5, F.lit(360.0)) / 45).cast("int")
    return F.get(names, sector % 8)


def joined(parts: Column) -> Column:
    """Consecutive lines as one; shared joints once."""
    return F.aggregate(parts, F.array().cast(f"array<{POINT}>"), lambda a, p: F.concat(a, F.when((F.size(a) > 0) & (F.element_at(F.concat(a, p), F.size(a)) == F.get(p, F.lit(0))), F.slice(p, 2, F.size(p))).otherwise(p)))
