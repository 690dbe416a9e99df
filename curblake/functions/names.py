"""Street names: keys, roots, abbreviations and search tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curblake.functions.rx import blank, first, group, has, sub

# Fixed values (T07): whole words and their short forms, in order.
SHORT = (
    ("street", "st"), ("road", "rd"), ("avenue", "ave"), ("boulevard", "blvd"), ("drive", "dr"), ("crescent", "cres"), ("court", "ct"), ("place", "pl"), ("square", "sq"), ("terrace", "terr"), ("trail", "trl"), ("circle", "crcl"),
    ("parkway", "pkwy"), ("gate", "gt"), ("lawn", "lwn"), ("gardens", "gdns"), ("grove", "grv"), ("heights", "hts"), ("crest", "crct"), ("west", "w"), ("east", "e"), ("north", "n"), ("south", "s"),
)
SPELLED = ("gate", "lawn", "gardens", "parkway")
CARDINALS = ("north", "south", "east", "west")
# Words that end a street name.
TYPES = (
    "street st road rd avenue ave boulevard blvd drive dr crescent cres court ct place pl square sq terrace terr trail trl circle crcl parkway pkwy "
    "gate gt lawn lwn gardens gdns lane ln way mews path close heights height hill view walk line grove grv garden crest crct alley bridge bdge ramp circuit"
).split()
_type = "(?:" + "|".join(TYPES) + ")"
_leg = r"\s*\([^)]*\b(?:legs?|branch(?:es)?|roadways?|sections?)\b[^)]*\)"


def short_name(name: Column, keep: tuple[str, ...] = ()) -> Column:
    """T07; with ``keep`` (T08) those words stay spelled out."""
    words = [(rf"\b{a}\b", b) for a, b in SHORT if a not in keep]
    return F.trim(sub(F.regexp_replace(F.trim(F.lower(name)), r"\.", ""), *words, (r"\s+", " ")))


def legal_key(name: Column) -> Column:
    """T13."""
    return F.trim(sub(F.trim(F.lower(name)), (r"\s*\([a-z]{2}\)\s*$", ""), (r"\bst\.\s*", "st "), (r"\s+", " ")))


def without_leg(name: Column) -> Column:
    """Without trailing leg or borough parentheses."""
    return F.trim(sub(name, (rf"(?:\s*\((?:TO|NY|ON)\)|{_leg})+\s*$", "")))


def lookup_key(name: Column) -> Column:
    """Without any trailing parenthesis or descriptor."""
    return legal_key(sub(F.trim(name), (r"(?:\s*\([^)]+\))+\s*$", ""), (r"(?:\s+(?:cul-de-sac|bus\s+loop|traffic\s+circle))+\s*$", "")))


def root(name: Column) -> Column:
    """Without the types (and cardinals after a type) that end the name."""
    return F.trim(sub(legal_key(without_leg(name)), (rf"(?:(?:^|\s+){_type}(?:\s+(?:north|south|east|west))?)+\s*$", "")))


def tokens(name: Column) -> tuple[Column, Column, Column]:
    """(base words, type or null, cardinal or null)."""
    key = lookup_key(name)
    cardinal = group(key, r"\s(north|south|east|west)$")
    rest = F.when(cardinal.isNotNull(), sub(key, (r"\s+(?:north|south|east|west)$", ""))).otherwise(key)
    kind = group(rest, rf"(?:^|\s)({_type})$")
    return F.when(kind.isNotNull(), F.trim(sub(rest, (rf"(?:^|\s+){_type}$", "")))).otherwise(rest), kind, cardinal


def leg_compass(name: Column) -> Column:
    """The compass word of a leg parenthesis."""
    inside = group(F.trim(name), r"\(([^)]+)\)\s*$")
    leg = has(inside, r"\b(?:legs?|branch(?:es)?|roadways?|sections?)\b")
    return F.when(leg, first(*[(has(inside, rf"\b{c}\b"), F.lit(c)) for c in CARDINALS], default=F.lit(None).cast("string")))


def strip_prefixes(name: Column) -> Column:
    """T09."""
    out = sub(F.trim(name), (r"^\s*from\s+", ""), (r"^\s*the\s+(?:east|west|north|south)\s+curb\s+line\s+of\s+", ""), (r"^\s*the\s+(?:east|west|north|south)(?:ern|erly)?\s+(?:branch|side|leg)\s+of\s+", ""), (r"^\s*the\s+(?:east|west|north|south)erly\s+terminus\s+street\b\s*", ""))
    rest = group(out, r"^\s*the\s+(.+)$")
    tail = has(rest, rf"(?:^|\s){_type}(?:\s+(?:w|e|n|s|west|east|north|south))?$") & ~has(rest, r"^(?:north|south|east|west|northern|southern|eastern|western)\b.*\bleg\s+of\b")
    return F.trim(F.when(F.coalesce(tail, F.lit(False)), rest).otherwise(out))


def compact(*parts: Column, most: int = 12) -> Column:
    """First-seen distinct, without nulls and empties."""
    return F.slice(F.array_distinct(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != ""))), 1, most)


def search_tokens(name: Column, legal: Column | None = None, alias: Column | None = None) -> Column:
    """What to look for in intersection descriptions, best first; legal is the resolved key, alias a curated token."""
    raw = strip_prefixes(name)
    plain = short_name(raw)
    legal = F.lit(None).cast("string") if legal is None else legal
    alias = F.lit(None).cast("string") if alias is None else alias
    bases = compact(F.coalesce(alias, plain), legal, F.when(short_name(legal) != plain, short_name(legal)), short_name(raw, SPELLED + CARDINALS), short_name(raw, SPELLED), plain)
    variants = F.flatten(F.transform(bases, lambda t: F.array(
        F.when(t.contains("'"), F.trim(F.regexp_replace(t, "'", ""))), F.when(t.endswith(" ct"), F.regexp_replace(t, " ct$", " crt")),
        F.when(t.rlike(r"\bst clair ave [ew]\b"), F.regexp_replace(t, r"\bst clair ave ([ew])\b", "st clair $1")), F.when(t.rlike(r"\bst clair [ew]\b(?! ave\b)"), F.regexp_replace(t, r"\bst clair ([ew])\b(?! ave\b)", "st clair ave $1")),
    )))
    return F.slice(F.array_distinct(F.filter(F.concat(bases, variants), lambda x: x.isNotNull() & (x != ""))), 1, 12)


def cross_names(cross: Column) -> Column:
    """The names that a cross-street phrase may mean."""
    text = strip_prefixes(cross)
    leg = r"(?:north/south|east/west|north|south|east|west)\s+leg\s+of\s+"
    stem = group(text, rf"^\s*the\s+(?:(?:north|south|east|west)(?:ern|erly)?\s+)?{leg}(.+)$")
    inner = group(text, rf"{leg}(.+?)(?:\s*$|\s+and\b)")
    halves = F.when(text.contains("/") & ~F.lower(text).contains("leg of"), F.split(text, "/")).otherwise(F.array().cast("array<string>"))
    every = F.concat(F.array(text, stem, inner), halves)
    return F.array_distinct(F.filter(F.transform(every, lambda x: strip_prefixes(x)), lambda x: x.isNotNull() & (x != "")))


def description_legs(desc: Column) -> Column:
    """T25."""
    return F.filter(F.transform(F.split(desc, "/"), F.trim), lambda x: x != "")


def is_lane_placeholder(highway: Column, between: Column) -> Column:
    """T20."""
    h = F.lower(F.trim(highway))
    return (h == "lane") | has(h, r"\blane(?:way)?\b.*\b(?:first|second|third|north|south|east|west)\b") | (h.isin("laneway", "ln") & ~blank(between))


# Taxonomies (B.7): ordered, the first that fits names the text.
def highway_kind(highway: Column) -> Column:
    """T21."""
    h = F.lower(F.trim(highway))
    return first(
        (blank(highway), F.lit("empty")), (h == "lane", F.lit("generic_lane_highway")), (has(h, r"\blane\b.*\bfirst\b"), F.lit("lane_position_in_highway")), (has(h, r"\blaneway\b"), F.lit("laneway_phrase")),
        (h.contains("running parallel") | h.contains("parallel to"), F.lit("misleading_highway_phrase")), (has(h, r"\([^)]*\b(?:legs?|branch(?:es)?|roadways?|sections?)\b[^)]*\)"), F.lit("leg_branch_paren")),
        (has(h, r"\b(?:cul-de-sac|bus loop|traffic circle)\b"), F.lit("descriptor_in_name")), (h.contains("("), F.lit("parenthetical_qualifier")), (h.contains("service road") | h.contains("off-ramp") | has(h, r"\bramp\b"), F.lit("ramp_service_parallel")),
        (h.contains("/") | h.contains(" and "), F.lit("compound_or_slash_highway")), (has(h, r"\b(?:one-way|(?:east|west|north|south)bound)\b"), F.lit("parenthetical_qualifier")), default=F.lit("plain_name"),
    )


def cross_kind(cross: Column) -> Column:
    """T22."""
    c, t = F.lower(F.trim(cross)), F.trim(cross)
    return first(
        (blank(cross), F.lit("empty")), (has(c, r"\b(?:north|south|east|west)(?:erly)?\s+end\s+of\b"), F.lit("street_end_phrase")), (has(c, r"^a point\b") | (c.contains(" metres ") & (c.contains("point") | c.contains("opposite"))), F.lit("point_metres_fragment")),
        (c.contains("leg of") | c.contains("north/south"), F.lit("leg_phrase")), (c.contains("lane") | has(c, r"\bln\b") | c.contains("ramp"), F.lit("lane_description")), (c.contains("adjacent to"), F.lit("adjacent_to")),
        (c.contains("intersection)") | c.contains("(east") | c.contains("(west"), F.lit("parenthetical_intersection")), (t.endswith(" and"), F.lit("trailing_and")), (has(c, r"\bst\.\s"), F.lit("abbrev_with_period")), (t.contains("'"), F.lit("apostrophe_name")),
        (c.contains("parkway") & ~has(c, r"parkway\s+\w+\s+(?:drive|dr|road|rd)\b"), F.lit("parkway_spelling")), (has(c, r"\bgate\b") & ~c.contains("gateway"), F.lit("gate_spelling")), (has(c, r"\blawn\b"), F.lit("lawn_spelling")), (has(c, r"\bgardens\b"), F.lit("gardens_spelling")),
        (c.contains("expressway") | c.contains("gardiner") | c.contains("don valley"), F.lit("major_roadway")), (c.startswith("the ") & c.contains(" the "), F.lit("leading_the")), default=F.lit("normal_street_name"),
    )


def between_kind(between: Column) -> Column:
    """T23."""
    b = F.lower(F.trim(between))
    joined = b.contains(" and ")
    return first(
        (blank(between) | (b == "nan"), F.lit("empty")), (has(b, r"\blane\b") & (b.contains("first") | has(b, r"(?:north|south|east|west) of")), F.lit("lane_first")), (b.contains("leg of") | has(b, r"\b(?:north|south)/(?:north|south)\b"), F.lit("leg")), (b.contains("("), F.lit("parenthetical")),
        (b.contains("end of"), F.lit("street_end")), (b.contains("opposite") & joined, F.lit("point_opposite_and")), (b.contains("a point") & joined & b.contains("intersection"), F.lit("dual_intersection_paren")), (b.contains("a point") & joined, F.lit("point_and_street")),
        (b.contains("/") & ~joined, F.lit("slash_cross")), (joined, F.lit("simple_and")), (has(b, r"\b(?:north|south|east|west)\b"), F.lit("directional")), default=F.lit("other_plain"),
    )


def attribution(kind: Column, cross: Column) -> Column:
    """V02."""
    return first(
        (kind.isin("abbrev_with_period", "parkway_spelling", "gate_spelling", "lawn_spelling", "gardens_spelling", "apostrophe_name"), F.lit("normalization_unresolved")), (kind == "point_metres_fragment", F.lit("regex_misparse")),
        (kind.isin("street_end_phrase", "leg_phrase", "trailing_and", "adjacent_to", "parenthetical_intersection"), F.lit("new_rule_or_geometry")), (kind == "lane_description", F.lit("mixed")), (cross.contains("/"), F.lit("slash_compound")),
        (kind == "normal_street_name", F.lit("true_missing_or_complex")), default=F.lit("investigate"),
    )


def cross_of_detail(detail: Column) -> Column:
    """The cross street of a ledger detail such as "start_intersection='X'"."""
    return group(detail, r"_(?:intersection|street)=['\"]?([^'\"]+)")
