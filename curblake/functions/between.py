"""The location grammar: where along its street a rule holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.functions.distinct import distinct_apply
from curblake.functions.grammar import Grammar, Rule
from curblake.functions.rx import FLAGS, blank, computed, first, group, has, sub, unfused

# The words of the by-laws.
CARDINAL = "north|south|east|west"
COMPASS = "north|south|east|west|northeast|northwest|southeast|southwest"
ENDS = COMPASS + "|northerly|southerly|easterly|westerly"
NUMBER = r"\d+(?:\.\d+)?"
COMPOUND = rf"(?:{COMPASS})(?:\s+and\s+(?:{COMPASS})|\s+(?:{COMPASS}))?"
STREET_TYPES = "street|st|avenue|ave|road|rd|drive|dr|boulevard|blvd|crescent|cres|court|ct|way|gate|grove|lane|ln"
STREET_HEAD = rf"[A-Za-z][A-Za-z'.-]*(?:\s+[A-Za-z'.-]+)*?\s+(?:{STREET_TYPES}|circle|terrace|place|square|trail|parkway|gardens|park|hill|heights)(?:\s+(?:{CARDINAL}))?"

# Fixed values (T01): ordered rewrites of the text, spelling repairs and wording.
REPAIRS = (
    (r"^between\s+", ""), (r"^from\s+a\s+point\b", "a point"), (r"^adjacent\s+.+?\s+between\s+", ""), (r"[ .]+$", ""),
    (rf"\b({CARDINAL})-({CARDINAL})\b", "$1$2"), (r"\bmetres\s+metres\b", "metres"), (rf"\ba\s+point\s+of\s+({NUMBER})\s+metres\b", "a point $1 metres"),
    (rf"\b({NUMBER})m\s+({COMPASS})\b", "$1 metres $2"), (r"\bthereof\s+thereof\b", "thereof"), (rf"\b({CARDINAL}),\s*({CARDINAL})\b", "$1 and $2"),
    (rf"\b({CARDINAL})erly/({CARDINAL})erly\b", "$1 and $2"), (r"(\d)(metres\b)", "$1 $2"), (r"\bmetres(?=[a-z])", "metres "),
    (r"\bppposite\b", "opposite"), (r"\boposite\b", "opposite"), (r"\booint\b", "point"), (r"\bappoint\b", "a point"), (r"\bnother\b", "north"),
    (r"\bnroth\b", "north"), (r"\beas\s+tof\b", "east of"), (r"\btherof\b", "thereof"), (r"\bmetes\b", "metres"),
    (rf"\b({NUMBER})\s+metre\s+({CARDINAL})\b", "$1 metres $2"), (r"\bmeters\b", "metres"), (rf"\band\s+a\s+({NUMBER})\s+metres\b", "and a point $1 metres"),
    (rf"\band\s+a\s+point\s+({NUMBER})\s+({CARDINAL})\s*$", "and a point $1 metres $2"), (r"\s+and\s*$", ""), (r"\band\s+and\b", "and"),
    (rf"\(({CARDINAL})\s+intersection(?!\))", "($1 intersection)"), (r"\)\s+(?:added|on the inside perimeter|to)\s*$", ")"),
    (r"\beaster\s+thereof\b", "east thereof"), (r"\ba point\s+a point\b", "a point"), (r"\band point (\d)", "and a point $1"), (r"^point (\d)", "a point $1"),
    (rf"\b({NUMBER})\s+(?!metres\b)({COMPASS})\s+of\b", "$1 metres $2 of"), (rf"\b({CARDINAL})/({CARDINAL})\b", "$1 and $2"),
    (rf"\bmetres\s+({COMPOUND})\s+(?!of\b)((?-i:[A-Z])[A-Za-z'.,-]*)", "metres $1 of $2"),
)
AT_A_POINT = tuple((rf"\bat\s+a\s+point\s+(?:approximately )?({NUMBER})\s+metres\s+({COMPOUND}){tail}", f"and a point $1 metres $2{kept}") for tail, kept in ((r"\s+of\b", " of"), (r"\s+thereof\b", " thereof"), (r"\s*$", "")))
CLOCK = r"\d{1,2}:\d{2}\s*[ap]\.m\."


def preprocess(text: Column) -> Column:
    """T01."""
    out = sub(F.trim(text), *REPAIRS)
    whole_block = has(out, rf"\bmetres\s+(?:south|north)\s+and\s+(?-i:[A-Z])(?:[A-Za-z'.,-]+\s+)*(?:{STREET_TYPES})\b")
    out = F.when(whole_block, out).otherwise(sub(out, (r"\bmetres\s+(south|north)\s+and\s+((?-i:[A-Z])[A-Za-z'.,-]*)", "metres $1 and east of $2")))
    out = sub(out, *AT_A_POINT)
    return F.trim(F.when(has(out, CLOCK) | has(out, r"^\s*adjacent\s+to\b"), out).otherwise(sub(out, (r"\s+to\s+", " and "))))


_METRIC = rf"^\s*a\s+point\s+(?:approximately )?({NUMBER})\s+metres\s+({COMPOUND})"
METRIC_OF, METRIC_ONLY = _METRIC + r"\s+of\s+(.+?)\s*$", _METRIC + r"\s*$"


def anchor(text: Column) -> Column:
    """The street that a phrase such as "a point opposite the east limit of X" stands on."""
    t = F.trim(text)
    forms = ((METRIC_OF, 3), (rf"^the\s+(?:{ENDS})\s+end\s+of\s+(.+)$", 1), (r"^a\s+point\s+opposite\s+the\s+.+?\blimit\s+of\s+(.+)$", 1), (r"^a\s+point\s+opposite\s+(.+)$", 1), (r"^the\s+.+?\blimit\s+of\s+(.+)$", 1))
    return F.coalesce(*[F.trim(group(t, p, i)) for p, i in forms], t)


def primary_compass(direction: Column) -> Column:
    """The first compass word, without "-erly"."""
    return F.regexp_replace(F.element_at(F.split(F.trim(F.lower(direction)), r"\s+"), 1), "^(north|south|east|west|northeast|northwest|southeast|southwest)erly$", "$1")


def qualifier(text: Column) -> tuple[Column, Column]:
    """(name, trailing parenthesis or null)."""
    pattern = r"^(.+?)\s*\(([^)]+)\)\s*$"
    return F.coalesce(F.trim(group(F.trim(text), pattern, 1)), F.trim(text)), F.trim(group(F.trim(text), pattern, 2))


def starts_with_a_point(t: Column) -> Column:
    return has(t, r"^\s*a point\b")


def names_an_end(t: Column) -> Column:
    return has(t, rf"\b(?:{ENDS})\s+end\s+of\b")


def is_block_side(t: Column) -> Column:
    """B37."""
    lane_point = F.lower(t).contains("lane") & F.lower(t).contains("point")
    return ~blank(t) & ~names_an_end(t) & ~has(t, r"\([^)]*intersection[^)]*\)") & ~starts_with_a_point(t) & ~lane_point


PIECES = {
    "+": ".+?", "*": ".*?", "+()": r".+?(?:\s*\([^)]+\))?",
    "dist": NUMBER, "distance": NUMBER, "dir": COMPOUND, "direction": COMPOUND, "end_word": ENDS, "compass": COMPASS,
    "about": "(?:approximately )?", "qualifier": "[^)]+", "head": STREET_HEAD, "lane_dir": CARDINAL,
    "further": rf"(?:further {COMPOUND}(?:\s+thereof)?|{COMPOUND} thereof)", "limit": r"(?:the\s+.+?\blimit\s+of\s+)?",
    "opoint": r"(?:an?\s*o?point\s+)?", "nth": r"(?:(?:first|second|third)\s+)?", "the": r"(?:the\s+)?", "other": rf"(?!the\s+(?:{ENDS})\s+end\s+of|a\s+point).+?",
}
GUARDS = {
    "side": is_block_side, "given": lambda t: ~blank(anchor(t)), "anchor_street": lambda t: ~blank(anchor(t)) & ~names_an_end(anchor(t)),
    "no_point": lambda t: ~F.lower(t).contains("point") & ~F.lower(t).contains("metres"), "no_and": lambda t: ~F.lower(t).contains(" and "),
    "plain_start": lambda t: ~has(t, r"^a point\s+.*\bmetres\b"), "not_point": lambda t: ~starts_with_a_point(t), "not_end": lambda t: ~names_an_end(t),
    "no_of": lambda t: ~F.lower(t).contains(" of "), "no_metres": lambda t: ~F.lower(t).contains("metres"), "opposite": lambda t: has(t, "^a point opposite") & ~blank(anchor(t)),
}
TRANSFORMS = {"raw": lambda t: t, "primary": primary_compass, "anchor": anchor}

_start, _end = ("start_intersection", "raw"), ("end_intersection", "raw")
_of = "a point <about>{dist1} metres {dir1} of {start_intersection+()} and"
_metric = "a point <about>{distance} metres {direction}"
_end_of = "the {end_word} end of {terminus_street+} and"
_terminus = {"terminus_direction": ("end_word", "primary")}
_bearing = {"direction": ("direction", "primary")}
_sides = (("side", "start_intersection"), ("side", "end_intersection"))

# B01-B35, in order; the first rule that fits gives the parse.
RULES = [
    Rule("offset_span", f"{_of} a point <about>{{dist2}} metres {{dir2}}"),
    Rule("offset_span", "a point <about>{dist1} metres {dir1} and a point <about>{dist2} metres {dir2} of {start_intersection+()}"),
    Rule("offset_to_intersect", _metric + " of {start_intersection+()} and a point opposite <limit>{end_intersection+}", {"end_intersection": ("end_intersection", "anchor"), **_bearing}, (("given", "end_intersection"),)),
    Rule("dual_anchor", f"{_of} <about>{{dist2}} metres {{dir2}} of {{end_intersection+}}"),
    Rule("perfect_offset", "a point opposite {start_intersection+} and " + _metric),
    Rule("block", r"a point opposite the .+?\blimit of {start_intersection+} and {end_intersection+}", {}, _sides),
    Rule("block", "a point opposite {start_intersection+} and {end_intersection+}", {"start_intersection": ("start_intersection", "anchor"), "end_intersection": ("end_intersection", "anchor")}, (("anchor_street", "start_intersection"), ("anchor_street", "end_intersection"))),
    Rule("block", "{start_intersection+} and a point opposite {end_intersection+}", {"end_intersection": ("end_intersection", "anchor")}, (("side", "start_intersection"), ("given", "end_intersection"))),
    Rule("terminus_to_terminus", "the {end_word1} end of {terminus_street+()} and <the>{end_word2} end of {terminus_street2+()}", {"terminus_start_dir": ("end_word1", "raw"), "terminus_end_dir": ("end_word2", "raw")}),
    Rule("terminus_end_metric", f"{_end_of} {_metric}", {**_terminus, **_bearing}),
    Rule("block_to_terminus", f"{_end_of} a point opposite <limit>{{end_intersection+}}", {**_terminus, "start_intersection": ("end_intersection", "anchor"), "end_intersection": None}, (("given", "end_intersection"),)),
    Rule("terminus_end_metric", f"{_end_of} {_metric} of the {{end_word2}} end of {{terminus_street2+}}", {**_terminus, **_bearing}, (("same_street", ""),)),
    Rule("block_to_terminus", f"{_end_of} {_metric} of {{offset_anchor+}}", {**_terminus, "start_intersection": ("offset_anchor", "anchor"), "distance": None, "direction": None}, (("given", "offset_anchor"),)),
    Rule("block_to_terminus", f"{_end_of} {{other}}", {**_terminus, "start_intersection": ("other", "raw")}),
    Rule("block_to_terminus", "{start_intersection*} and the {end_word} end of {terminus_street*}", {"terminus_direction": ("end_word", "raw")}),
    Rule("block_to_terminus", "{start_intersection+} and {end_word} end of {terminus_street+}", _terminus, (("side", "start_intersection"),)),
    Rule("parenthetical_to_terminus", r"{start_intersection*}\s*\({qualifier1}\)\s*and the {compass} end of {terminus_street*}", {"terminus_direction": ("compass", "raw"), "start_intersection_qualifier": ("qualifier1", "raw")}),
    Rule("parenthetical_end_block", r"{start_intersection*} and {end_intersection*}\s*\({qualifier2}\)\s*", {"end_intersection_qualifier": ("qualifier2", "raw")}, (("side", "start_intersection"),)),
    Rule("parenthetical_dual_block", r"{start_intersection*}\s*\({qualifier1}\)\s*and\s*{end_intersection*}\s*\({qualifier2}\)\s*", {"start_intersection_qualifier": ("qualifier1", "raw"), "end_intersection_qualifier": ("qualifier2", "raw")}, _sides),
    Rule("relative_extension", f"{_of} a point <about>{{dist2}} metres <further>"),
    Rule("intersect_thereof_block", "{start_intersection*} and " + _metric + " thereof and {end_intersection+}", {}, _sides),
    Rule("perfect_offset", r"{start_intersection+} and <opoint><about>{distance} metres? {direction}", {}, (("plain_start", "start_intersection"),)),
    Rule("perfect_offset", "{start_intersection*} and " + _metric, {}, (("plain_start", "start_intersection"),)),
    Rule("intersect_to_offset", "{start_intersection*} and " + _metric + " of {offset_intersection*}", {}, (("not_point", "start_intersection"), ("not_end", "start_intersection"))),
    Rule("intersect_to_offset", "{start_intersection+} and a point <about>{distance} metres further {direction} of {offset_intersection+}", _bearing, (("side", "start_intersection"),)),
    Rule("perfect_offset", _metric + " and {start_intersection+}", _bearing, (("not_point", "start_intersection"), ("not_end", "start_intersection"), ("no_of", "start_intersection"))),
    Rule("intersect_extension", "{start_intersection*} and " + _metric + " thereof", {}, (("not_point", "start_intersection"),)),
    Rule("dual_anchor", f"{_of} a point <about>{{dist2}} metres {{dir2}} of {{end_intersection+()}}"),
    Rule("offset_to_intersect", _metric + " of {start_intersection+()} and {end_intersection*}", {}, (("not_point", "end_intersection"), ("no_metres", "end_intersection"), ("not_end", "end_intersection"))),
    Rule("parenthetical_block", r"{start_intersection*}\s*\({qualifier1}\)\s*and\s*{end_intersection*}", {"start_intersection_qualifier": ("qualifier1", "raw")}, _sides),
    Rule("parenthetical_block", r"{start_intersection*}\s*\({qualifier1}\)\s*and\s*{end_intersection*}", {"start_intersection_qualifier": ("qualifier1", "raw"), "end_intersection": ("end_intersection", "anchor")}, (("side", "start_intersection"), ("opposite", "end_intersection"))),
    Rule("block", "{start_intersection+} and {end_intersection+}, <nth>{lane_dir} of {lane_anchor+}", {}, (("no_point", ""), *_sides)),
    Rule("block", "{head1} {head2}", {"start_intersection": ("head1", "raw"), "end_intersection": ("head2", "raw")}, (("no_point", ""), ("no_and", ""))),
    Rule("block", "{start_intersection*} and {end_intersection*}", {}, (("no_point", ""), *_sides)),
    Rule("intersect_extension", "{start_intersection*} and a point <about>{distance} metres further {direction}", {}, (("plain_start", "start_intersection"),)),
    Rule("entire_length", "entire length"),
]
_twice = rf"^the (?:{ENDS}) end of (.+?) and a point (?:approximately )?{NUMBER} metres {COMPOUND} of the (?:{ENDS}) end of \1$".replace(" ", r"\s+")
GUARDS["same_street"] = lambda t: has(t, _twice)
GRAMMAR = Grammar(RULES, PIECES, GUARDS, TRANSFORMS)

FIELDS = ("start_intersection", "end_intersection", "offset_intersection", "start_intersection_qualifier", "end_intersection_qualifier", "terminus_direction", "terminus_street", "terminus_start_dir", "terminus_end_dir", "distance", "direction", "dist1", "dist2", "dir1", "dir2")
ANCHORS = ("start_intersection", "end_intersection", "offset_intersection", "terminus_street")


def parse_texts(texts: DataFrame, text: str = "between") -> DataFrame:
    """B00 and T00 for distinct texts: adds rule_number, rule_type and the fields."""
    rows = computed(texts, _t=unfused(F.col(text), lambda t: F.when(~blank(t), preprocess(t))))
    rows = computed(rows, rule_number=unfused(F.col("_t"), GRAMMAR.number))
    parsed = unfused(F.struct(F.col("_t").alias("t"), F.col("rule_number").alias("n")), lambda r: F.struct(*[v.alias(k) for k, v in GRAMMAR.values(r["t"], r["n"], FIELDS).items()]))
    rows = computed(rows, rule_type=GRAMMAR.kinds(F.col("rule_number")), _p=parsed).select(*rows.columns, "rule_type", "_p.*")
    # Trailing parentheses of anchors are qualifiers
    for a in ("start_intersection", "end_intersection", "offset_intersection"):
        name, found = qualifier(F.col(a))
        moved = {a: name}
        if f"{a}_qualifier" in FIELDS:
            moved[f"{a}_qualifier"] = F.coalesce(F.nullif(F.trim(f"{a}_qualifier"), F.lit("")), found)
        rows = rows.withColumns(moved)
    rows = rows.withColumns({a: F.trim(F.regexp_replace(a, FLAGS + r"\s+and\s*$", "")) for a in ("start_intersection", "end_intersection", "offset_intersection")})
    rows = _upgrade(rows)
    rows = rows.withColumns({d: primary_compass(F.col(d)) for d in ("direction", "dir1", "dir2", "terminus_direction")})
    rows = rows.withColumns({a: anchor(F.col(a)) for a in ANCHORS})
    return rows.withColumns({d: F.col(d).try_cast("double") for d in ("distance", "dist1", "dist2")}).drop("_t")


def _upgrade(rows: DataFrame) -> DataFrame:
    """Block parses whose anchor is really an offset."""
    kind, start, end = F.col("rule_type"), F.col("start_intersection"), F.col("end_intersection")
    of_start, of_end = has(start, METRIC_OF), has(end, METRIC_OF)
    only_start, only_end = has(start, METRIC_ONLY) & ~of_start, has(end, METRIC_ONLY) & ~of_end
    cases = {
        "pb": (kind == "parenthetical_block") & of_start,
        "peb_of": (kind == "parenthetical_end_block") & of_end,
        "peb": (kind == "parenthetical_end_block") & only_end,
        "bt_of": (kind == "block_to_terminus") & of_start,
        "bt": (kind == "block_to_terminus") & only_start,
    }
    case = first(*[(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in cases.items()], default=F.lit(""))
    rows = rows.withColumn("_case", case)
    at = lambda *names: F.col("_case").isin(*names)
    metric = lambda i: F.when(at("pb", "bt_of"), group(start, METRIC_OF, i)).when(at("peb_of"), group(end, METRIC_OF, i)).when(at("peb"), group(end, METRIC_ONLY, i)).when(at("bt"), group(start, METRIC_ONLY, i))
    street = F.coalesce(F.nullif(F.trim("terminus_street"), F.lit("")), start)
    return rows.withColumns({
        "rule_type": F.when(at("pb"), F.lit("offset_to_intersect")).when(at("peb_of"), F.lit("intersect_to_offset")).when(at("peb"), F.lit("perfect_offset")).otherwise(kind),
        "start_intersection": F.when(at("pb", "bt_of"), group(start, METRIC_OF, 3)).when(at("bt"), street).otherwise(start),
        "offset_intersection": F.when(at("peb_of"), group(end, METRIC_OF, 3)).otherwise(F.col("offset_intersection")),
        "end_intersection": F.when(~at("peb_of", "peb"), end),
        "end_intersection_qualifier": F.when(~at("peb_of", "peb"), F.col("end_intersection_qualifier")),
        "distance": F.coalesce(metric(1), F.col("distance")),
        "direction": F.coalesce(metric(2), F.col("direction")),
    }).drop("_case")


# The fields that each rule type needs.
NEEDS = {
    "entire_length": ((), ()), "block": (("start_intersection", "end_intersection"), ()), "block_to_terminus": (("start_intersection", "terminus_direction"), ()),
    "terminus_end_metric": (("terminus_street", "terminus_direction", "direction"), ("distance",)), "terminus_to_terminus": (("terminus_start_dir", "terminus_end_dir", "terminus_street"), ()),
    "parenthetical_block": (("start_intersection", "end_intersection"), ()), "parenthetical_end_block": (("start_intersection", "end_intersection"), ()),
    "parenthetical_dual_block": (("start_intersection", "end_intersection"), ()), "parenthetical_to_terminus": (("start_intersection", "terminus_direction"), ()),
    "intersect_extension": (("start_intersection", "direction"), ("distance",)), "perfect_offset": (("start_intersection", "direction"), ("distance",)),
    "intersect_to_offset": (("start_intersection", "offset_intersection", "direction"), ("distance",)), "offset_to_intersect": (("start_intersection", "end_intersection", "direction"), ("distance",)),
    "intersect_thereof_block": (("start_intersection", "end_intersection", "direction"), ("distance",)), "relative_extension": (("start_intersection", "dir1"), ("dist1", "dist2")),
    "offset_span": (("start_intersection", "dir1"), ("dist1", "dist2")), "dual_anchor": (("start_intersection", "end_intersection", "dir1", "dir2"), ("dist1", "dist2")),
}
BEARINGS = {
    "direction": ("perfect_offset", "intersect_extension", "intersect_to_offset", "offset_to_intersect", "intersect_thereof_block"),
    "dir1": ("relative_extension", "offset_span", "dual_anchor"), "dir2": ("dual_anchor",), "terminus_direction": ("block_to_terminus", "parenthetical_to_terminus"),
    "terminus_start_dir": ("terminus_to_terminus",), "terminus_end_dir": ("terminus_to_terminus",),
}


def _anchor_ok(t: Column) -> Column:
    lane = F.lower(t).contains("lane") & (F.lower(t).contains("point") | F.lower(t).contains("metres"))
    tail = has(t, rf",\s*(?:(?:first|second|third)\s+)?(?:{CARDINAL})\s+of\s+")
    return ~blank(t) & ~has(t, r"^\s*a point\s+.*\bmetres\b") & ~(starts_with_a_point(t) & F.lower(t).contains("metres")) & ~lane & ~tail


def parse_error(row: Column) -> Column:
    """the first failed test of a parse (a struct of rule_type and the fields), null if it is valid."""
    kind = row["rule_type"]
    tests = [(blank(kind), F.lit("missing rule_type")), (~kind.isin(*NEEDS), F.concat(F.lit("unknown rule_type="), kind))]
    for name in FIELDS:
        of = [k for k, (strings, _) in NEEDS.items() if name in strings]
        if of:
            tests.append((kind.isin(*of) & blank(row[name]), F.lit(f"missing {name}")))
            if name in ANCHORS:
                tests.append((kind.isin(*of) & ~_anchor_ok(row[name]), F.concat(F.lit(f"invalid anchor {name}="), F.substring(row[name], 1, 80))))
    for name in ("distance", "dist1", "dist2"):
        of = [k for k, (_, floats) in NEEDS.items() if name in floats]
        value = row[name]
        tests += [(kind.isin(*of) & value.isNull(), F.lit(f"missing or non-numeric {name}")), (kind.isin(*of) & (F.isnan(value) | (F.abs(value) == float("inf"))), F.lit(f"non-finite {name}")), (kind.isin(*of) & (value < 0), F.lit(f"negative {name}"))]
    for name, of in BEARINGS.items():
        tests.append((kind.isin(*of) & ~F.lower(F.trim(row[name])).isin(*COMPASS.split("|")), F.concat(F.lit(f"invalid {name}="), row[name])))
    tests.append(((kind == "offset_span") & ~blank(row["dir2"]) & ~F.lower(F.trim(row["dir2"])).isin(*COMPASS.split("|")), F.concat(F.lit("invalid dir2="), row["dir2"])))
    for name in ("start_intersection_qualifier", "end_intersection_qualifier"):
        tests.append(((kind == "parenthetical_dual_block") & blank(row[name]), F.lit(f"missing {name}")))
    return first(*[(F.coalesce(c, F.lit(False)), v) for c, v in tests], default=F.lit(None).cast("string"))


def valid_flag(c: Column) -> Column:
    """a blank flag counts as true."""
    return blank(c) | F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes")


def parse_rows(rows: DataFrame, text: str = "between") -> DataFrame:
    """The rows with their parse, parse_error and reason (PARSE_EMPTY_BETWEEN, PARSE_NO_MATCH, PARSE_INVALID or null)."""
    out = distinct_apply(rows, [text], lambda t: parse_texts(t, text).withColumn("parse_error", F.when(F.col("rule_number").isNotNull(), unfused(F.struct(*[F.col(c) for c in ("rule_type", *FIELDS)]), parse_error))))
    reason = first((blank(F.col(text)), F.lit("PARSE_EMPTY_BETWEEN")), (F.col("rule_number").isNull(), F.lit("PARSE_NO_MATCH")), (F.col("parse_error").isNotNull(), F.lit("PARSE_INVALID")), default=F.lit(None).cast("string"))
    return out.withColumn("reason_code", reason)
