"""Which curb a rule is on (T27-T30, F10): one decision list over the Side text; run it on distinct texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.functions.distinct import distinct_apply
from curblake.functions.rx import blank, computed, first, has, sub

RING8 = ("north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest")
# What makes a side special, in order.
SPECIAL = (
    ("island", r"\bislands?\b"), ("median", r"\bmedians?\b"), ("lay_by", r"\blay(?:\s*|-)?bys?\b"), ("cul_de_sac", r"\bcul(?:\s*|-)+de(?:\s*|-)+sacs?\b"), ("leg", r"\blegs?\b"),
    ("roadway", r"\broadways?\b|\b(?:north|south|east|west)bound\b"), ("end", r"\b(?:north|south|east|west)\s+end\b"), ("centre", r"\bcentre\b"),
)
RINGS = tuple((rf"\b{word}\s+{shape}\b", ring, shape) for shape, pairs in (("perimeter", (("inner", "inner"), ("inside", "inner"), ("outer", "outer"), ("outside", "outer"))), *((s, (("inner", "inner"), ("outer", "outer"))) for s in ("circle", "radius", "side"))) for word, ring in pairs)


def tidy(raw: Column) -> Column:
    """T27."""
    out = F.translate(F.lower(F.trim(raw)), "–—−‘’.;", "---''  ")
    return F.trim(sub(out, (r"\bperimiter\b", "perimeter"), (r"\bcenter\b", "centre"), ("&", " and "), (",", " and "), (r"\s*/\s*", " and "), (r"\b(north|south)\s*-\s*(east|west)\b", "$1$2"), (r"\b(north|south)\s+(east|west)\b", "$1$2"), (r"(?:\s*\band\s*)+", " and "), (r"\s+", " "), (r"^\s*(?:and\s+)+|(?:\s+and)+\s*$", "")))


def directions(text: Column) -> Column:
    """Compass words in order, each once, without those of legs, ends, bounds and medians."""
    masked = sub(text, (r"\b(?:north|south|east|west)(?:\s+leg|bound|\s+end|\s+of\s+the\s+median)\b", " "))
    words = F.regexp_extract_all(masked, F.lit(r"\b((?:north|south)(?:east|west)|north|south|east|west)(?:ern|erly)?\b(?!bound)"), F.lit(1))
    return F.array_distinct(words)


def sides(texts: DataFrame, side: str = "side") -> DataFrame:
    """Adds mode, normalized, directions, parity, ring, special and wrapping to distinct texts."""
    rows = computed(texts, _t=tidy(F.col(side)))
    rows = computed(rows, _d=F.coalesce(directions(F.col("_t")), F.array().cast("array<string>")))
    t, d, none = F.col("_t"), F.col("_d"), F.lit(None).cast("string")
    empty = blank(F.col(side)) | F.lower(F.trim(side)).isin("nan", "none", "<na>", "<nat>")
    special = first(*[(has(t, p), F.lit(k)) for k, p in SPECIAL], default=none)
    ring, shape = first(*[(has(t, p), F.lit(r)) for p, r, _ in RINGS], default=none), first(*[(has(t, p), F.lit(s)) for p, _, s in RINGS], default=none)
    all4 = F.size(F.array_intersect(d, F.array(*map(F.lit, ("north", "south", "east", "west"))))) == 4
    place = lambda i: F.array_position(F.array(*map(F.lit, RING8)), F.get(d, F.lit(i)))
    opposite = (F.size(d) == 2) & (F.abs(place(0) - place(1)) == 4)
    rows = computed(rows, _empty=empty, _special=special, ring=ring, _shape=shape, _opposite=opposite, _all=all4)
    special, ring, opposite, all4 = F.col("_special"), F.col("ring"), F.col("_opposite"), F.col("_all")
    whole = lambda word: has(t, rf"^{word}$")
    both, every, odd, even = whole(r"both(?:\s+sides?)?"), whole(r"all(?:\s+sides?)?"), whole(r"odd(?:(?:\s+numbered)?\s+sides?)?"), whole(r"even(?:(?:\s+numbered)?\s+sides?)?")
    mode = first((F.col("_empty"), F.lit("unresolved")), (special.isNotNull(), F.lit("specialized")), (both | every, F.lit("multi")), (odd | even, F.lit("parity")), ((F.size(d) == 0) & ring.isNotNull(), F.lit("perimeter")), (F.size(d) == 0, F.lit("unresolved")), (F.size(d) == 1, F.lit("single")), (all4 | opposite, F.lit("multi")), default=F.lit("wrapping"))
    name = first((F.col("_empty"), none), (special.isNotNull(), F.regexp_replace(special, "_", " ")), (both, F.lit("both")), (every | all4, F.lit("all")), (odd, F.lit("odd")), (even, F.lit("even")), ((F.size(d) == 0) & ring.isNotNull(), F.concat_ws(" ", ring, F.when(F.col("_shape") == "side", "perimeter").otherwise(F.col("_shape")))), (F.size(d) == 0, none), default=F.array_join(d, " and "))
    return computed(rows, mode=mode, normalized=name, directions=d, parity=F.when(odd, F.lit("odd")).when(even, F.lit("even")), special=special).drop("_t", "_d", "_empty", "_special", "_shape", "_opposite", "_all")


def parse_sides(rows: DataFrame, side: str = "side") -> DataFrame:
    return distinct_apply(rows, [side], lambda t: sides(t, side))


def parity_side(parity: Column, left: Column, right: Column) -> Column:
    """Left or right from the parity codes of an edge; null when both or neither fit."""
    want = F.when(parity == "odd", F.lit("O")).when(parity == "even", F.lit("E"))
    fits = lambda code: F.coalesce(F.upper(F.trim(code)).isin("OE", "EO") | (F.upper(F.trim(code)) == want), F.lit(False)) & want.isNotNull()
    return F.when(fits(left) & ~fits(right), F.lit("left")).when(fits(right) & ~fits(left), F.lit("right"))
