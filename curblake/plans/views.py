"""Inputs derived from the driver's tables, by SQL that Spark and DuckDB compute alike.

A view is SQL with the tables it reads in braces.  For Spark they become Parquet paths, for DuckDB names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from curblake.operators.clean import CATEGORY_OF

NAMES = (*CATEGORY_OF, "Schedule 99: Something Else", "Schedule 98: Unknown")
_name = "CASE o_orderkey % 28 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES)) + " END"
STREET = "translate(n_name, '0123456789_', 'abcdefghij ')"


def case(by: str, values: list[str]) -> str:
    return f"CASE {by} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def text(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''").replace("{", "<").replace("}", ">") + "'"


#: (text, its truth at a slot, as SQL); {h} and {k} are hours of the morning and afternoon.
TIMES = (
    ("Anytime", "TRUE"),
    ("{h}:00 a.m. to {k}:30 p.m.", "minuteOfDay >= h * 60 AND minuteOfDay < k * 60 + 750"),
    ("{h}:00 a.m. to {k}:30 p.m., Mon. to Fri.", "minuteOfDay >= h * 60 AND minuteOfDay < k * 60 + 750 AND dayOfWeek BETWEEN 1 AND 5"),
    ("{h}:00 a.m. to {k}:00 p.m., Mon. to Sat.", "minuteOfDay >= h * 60 AND minuteOfDay < k * 60 + 720 AND dayOfWeek >= 1"),
    ("{h}:00 a.m. to {k}:00 p.m., Sat.", "minuteOfDay >= h * 60 AND minuteOfDay < k * 60 + 720 AND dayOfWeek = 6"),
    ("{h}:00 a.m. to {k}:00 p.m., Mon. to Fri., except public holidays", "minuteOfDay >= h * 60 AND minuteOfDay < k * 60 + 720 AND dayOfWeek BETWEEN 1 AND 5 AND NOT holiday"),
    ("2:00 a.m. to 6:00 a.m. from Dec. 1 to Mar. 31", "minuteOfDay >= 120 AND minuteOfDay < 360 AND (month = 12 OR month <= 3)"),
    ("Major Snow Storm Conditions", "majorSnowStorm"),
    ("Anytime, except 8:00 a.m. to 6:00 p.m., Mon. to Fri.", "NOT (minuteOfDay >= 480 AND minuteOfDay < 1080 AND dayOfWeek BETWEEN 1 AND 5)"),
    ("9:00 p.m. of one day to 7:00 a.m. of the next following day", "minuteOfDay >= 1260 OR minuteOfDay < 420"),
    ("July and August", "month IN (7, 8)"),
    ("{h}:00 a.m. to {k}:00 p.m., from the 1st day to the 15th day of each month", "minuteOfDay >= h * 60 AND minuteOfDay < k * 60 + 720 AND dayOfMonth <= 15"),
    ("{h}:00 a.m. to {k}:00 p.m., from the 16th day to the last day of each month", "minuteOfDay >= h * 60 AND minuteOfDay < k * 60 + 720 AND dayOfMonth >= 16"),
    ("Anytime, Apr. 1 to Nov. 30", "minuteOfDay < 1439 AND month BETWEEN 4 AND 11"),
    ("7:00 a.m. to 9:00 a.m. and 4:00 p.m. to 6:00 p.m., Mon. to Fri.", "(minuteOfDay >= 420 AND minuteOfDay < 540) OR (minuteOfDay >= 960 AND minuteOfDay < 1080 AND dayOfWeek BETWEEN 1 AND 5)"),
    ("on alternate afternoons", "FALSE"),
    (None, "FALSE"),
    ("Sat. and Sun.", "minuteOfDay < 1439 AND dayOfWeek IN (0, 6) AND NOT holiday"),
    ("8:00 a.m. to 6:00 p.m., except July and August", "minuteOfDay >= 480 AND minuteOfDay < 1080 AND month NOT IN (7, 8)"),
    ("6:00 p.m. Fri. to 7:00 a.m. Mon.", "(dayOfWeek = 5 AND minuteOfDay >= 1080 AND minuteOfDay < 1439) OR (dayOfWeek IN (0, 6) AND minuteOfDay < 1439) OR (dayOfWeek = 1 AND minuteOfDay < 420)"),
)
_AM, _PM, _WEEK = "h * 60", "k * 60 + 720", "1,2,3,4,5"
#: The windows that are expected of each time text, as SQL of h and k.
TIMES_WINDOWS = ((), ((_AM, "k * 60 + 750"),), ((_AM, "k * 60 + 750"),), ((_AM, _PM),), ((_AM, _PM),), ((_AM, _PM),), ((120, 360),), (), ((480, 1080),), ((1260, 420),), (), ((_AM, _PM),), ((_AM, _PM),), ((0, 1439),), ((420, 540), (960, 1080)), (), (), ((0, 1439),), ((480, 1080),), ((1080, 1439), (0, 1439), (0, 420)))
_EVERY = "0,1,2,3,4,5,6"
_TIMES_DAYS = ((), (_EVERY,), (_WEEK,), ("1,2,3,4,5,6",), ("6",), (_WEEK,), (_EVERY,), (), (_WEEK,), (_EVERY,), (), (_EVERY,), (_EVERY,), (_EVERY,), (_EVERY, _WEEK), (), (), ("0,6",), (_EVERY,), ("5", "6,0", "1"))
_TIMES_STATUS = ("anytime", "ok", "ok", "ok", "ok", "ok", "ok", "conditional", "ok", "ok", "anytime", "ok", "ok", "ok", "ok", "failed", "failed", "ok", "ok", "ok")
_TIMES_CALENDAR = {6: '"monthRanges":[<"startMonth":12,"startDay":1,"endMonth":3,"endDay":31>]', 10: '"months":[7,8]', 11: '"dayOfMonthRanges":[<"start":1,"end":15>]', 12: '"dayOfMonthRanges":[<"start":16,"end":"last">]', 13: '"monthRanges":[<"startMonth":4,"startDay":1,"endMonth":11,"endDay":30>]', 18: '"months":[1,2,3,4,5,6,9,10,11,12]'}


def _times_json(i: int) -> str:
    """The JSON that is expected of a time text, as SQL; its braces are written < and >."""
    calendar = f',"calendar":<{_TIMES_CALENDAR[i]}>' if i in _TIMES_CALENDAR else ""
    windows = ",".join(f"""<"days":[{days}],"startMinute":' || ({a}) || ',"endMinute":' || ({b}) || ',"crossesMidnight":{'true' if i == 9 else 'false'}{calendar}>""" for days, (a, b) in zip(_TIMES_DAYS[i], TIMES_WINDOWS[i], strict=True))
    more = {7: ',"condition":"major_snowstorm_declared","is_snow_route":true', 8: ',"inverted":true'}.get(i, "")
    after = {5: ',"flags":<"exceptPublicHolidays":true>', 17: ',"flags":<"exceptPublicHolidays":true>', 10: calendar, 15: ',"unparsedClauses":["on alternate afternoons"]'}.get(i, "")
    whole = f"""'<"v":1,"status":"{_TIMES_STATUS[i]}","source":"' || coalesce(times, '') || '"{more},"windows":[{windows}]{after}>'"""
    return f"translate({whole}, '<>', '{{{{}}}}')"


TIMES_JSON = case("template", [_times_json(i) for i in range(len(TIMES))])
_hours = "CAST(7 + o_orderkey % 4 AS STRING)", "CAST(3 + o_orderkey % 4 AS STRING)"
TIMES_TEXT = f"replace(replace({case('o_orderkey % 20', [text(t) for t, _ in TIMES])}, '<h>', {_hours[0]}), '<k>', {_hours[1]})"

#: Location texts and the parse that is expected of each (rule_type, start, end, offset street, terminus street, terminus direction, number 1, number 2, bearing).
PLACES = (
    ("{a} Street and {b} Avenue", "block", "{a} Street", "{b} Avenue", None, None, None, None, None, None),
    ("{a} Street and a point {m} metres north", "perfect_offset", "{a} Street", None, None, None, None, "{m}", None, "north"),
    ("A point {m} metres east of {a} Street and {b} Avenue", "offset_to_intersect", "{a} Street", "{b} Avenue", None, None, None, "{m}", None, "east"),
    ("{a} Street and a point {m} metres west of {b} Avenue", "intersect_to_offset", "{a} Street", None, "{b} Avenue", None, None, "{m}", None, "west"),
    ("{a} Street and a point {m} metres south thereof", "intersect_extension", "{a} Street", None, None, None, None, "{m}", None, "south"),
    ("A point {m} metres north of {a} Street and a point {n} metres further north", "relative_extension", "{a} Street", None, None, None, None, "{m}", "{n}", "north"),
    ("A point {m} metres north of {a} Street and a point {n} metres south", "offset_span", "{a} Street", None, None, None, None, "{m}", "{n}", "north"),
    ("A point {m} metres east of {a} Street and a point {n} metres west of {b} Avenue", "dual_anchor", "{a} Street", "{b} Avenue", None, None, None, "{m}", "{n}", "east"),
    ("{a} Street and the north end of {b} Avenue", "block_to_terminus", "{a} Street", None, None, "{b} Avenue", "north", None, None, None),
    ("The south end of {b} Avenue and {a} Street", "block_to_terminus", "{a} Street", None, None, "{b} Avenue", "south", None, None, None),
    ("The north end of {b} Avenue and a point {m} metres south", "terminus_end_metric", None, None, None, "{b} Avenue", "north", "{m}", None, "south"),
    ("The north end of {b} Avenue and the south end of {b} Avenue", "terminus_to_terminus", None, None, None, "{b} Avenue", None, None, None, None),
    ("{a} Street (north intersection) and {b} Avenue", "parenthetical_block", "{a} Street", "{b} Avenue", None, None, None, None, None, None),
    ("{a} Street and {b} Avenue (west intersection)", "parenthetical_end_block", "{a} Street", "{b} Avenue", None, None, None, None, None, None),
    ("Entire length", "entire_length", None, None, None, None, None, None, None, None),
    ("Between {a} Street and a ppposite lane", "block", "{a} Street", "a opposite lane", None, None, None, None, None, None),
    ("{a} Street and {m}m north of {b} Avenue", None, None, None, None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None, None),
    ("A point opposite {a} Street and a point {m} metres east", "perfect_offset", "{a} Street", None, None, None, None, "{m}", None, "east"),
    ("{a} Street and a point {m} metres north-east thereof and {b} Avenue", "intersect_thereof_block", "{a} Street", "{b} Avenue", None, None, None, "{m}", None, "northeast"),
)
_A, _B = STREET, "translate(r_name, '0123456789_', 'abcdefghij ')"
_M, _N = "CAST(10 + o_orderkey % 40 AS STRING)", "CAST(5 + o_orderkey % 3 AS STRING)"


def fill(sql: str, pairs: tuple) -> str:
    for k, v in pairs:
        sql = f"replace({sql}, '<{k}>', {v})"
    return sql


_PAIRS = (("a", _A), ("b", _B), ("m", _M), ("n", _N))
PLACE_TEXT = fill(case("o_orderkey % 20", [text(p[0]) for p in PLACES]), _PAIRS)


def place_field(i: int) -> str:
    return fill(case("o_orderkey % 20", [text(p[i]) for p in PLACES]), _PAIRS)


_ORDERS = "{orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"

#: Rules with their fields apart, as the oracles read them.
RULES = f"""
SELECT o_orderkey AS id, {_name} AS name,
       CASE o_orderkey % 10 WHEN 0 THEN 'Repealed' WHEN 1 THEN NULL ELSE 'Amended' END AS action,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {STREET} || ' Street' END AS highway,
       {case("o_orderkey % 4", [text(None), text("North"), text("Both"), text("East")])} AS side,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_B} || ' Road and Anytime Lane' END AS place,
       {case("o_orderkey % 6", [text(None), text("Anytime"), text("8:00 a.m. to 6:00 p.m."), text(None), text("Mon. to Fri."), text("")])} AS times,
       {case("o_orderkey % 3", [text(None), text("2 hours"), text("30 minutes")])} AS period,
       CASE WHEN o_orderkey % 7 = 0 THEN 'Location' ELSE 'Between' END AS place_key,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Side Parking' ELSE 'Side' END AS side_key,
       CASE WHEN o_orderkey % 8 < 4 THEN 'Prohibited Times and/or Days' ELSE 'Hours' END AS times_key,
       o_orderkey % 17 AS shape
FROM {_ORDERS}"""


def _entry(key: str, value: str) -> str:
    return f"'{{{{''key'': ''' || {key} || ''', ''linearId'': 7, ''value'': ' || coalesce('''' || {value} || '''', 'None') || '}}}}'"


_cell = " || ', ' || ".join([_entry("'Highway'", "highway"), _entry("side_key", "side"), _entry("place_key", "place"), _entry("times_key", "times"), _entry("'Maximum Period Permitted'", "period")])
RAW = f"""
SELECT id AS _id, name AS scheduleName, action AS Latest_Action,
       CASE WHEN shape = 0 THEN '' WHEN shape = 1 THEN '[]' WHEN shape = 2 THEN 'no list' WHEN shape IN (3, 4, 5) THEN '"[' || {_cell} || ']"' ELSE '[' || {_cell} || ']' END AS ByLaw_Table
FROM ({RULES}) AS r"""
PLACES_VIEW = f"SELECT o_orderkey AS id, o_orderkey % 20 AS template, {PLACE_TEXT} AS between FROM {_ORDERS}"
TIMES_VIEW = f"SELECT o_orderkey AS id, {_name} AS name, o_orderkey % 20 AS template, 7 + o_orderkey % 4 AS h, 3 + o_orderkey % 4 AS k, {TIMES_TEXT} AS times FROM {{orders}}"
HOLIDAYS_2024 = "(month, dayOfMonth) IN ((1, 1), (2, 19), (3, 29), (5, 20), (7, 1), (9, 2), (10, 14), (12, 25), (12, 26))"
SLOTS = """
SELECT DISTINCT CAST(event_id % 7 AS INT) AS dayOfWeek, CAST((event_id % 24) * 60 + 30 AS INT) AS minuteOfDay, CAST(1 + event_id % 12 AS INT) AS month,
       CAST(1 + event_id % 28 AS INT) AS dayOfMonth, 2024 AS year, event_id % 7 = 3 AS majorSnowStorm FROM {events}"""

_TABLE = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The view as a DataFrame."""
    return spark.sql(_TABLE.sub(lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", sql).replace("{{", "{").replace("}}", "}"))


def oracle(sql: str, **views: str) -> str:
    """DuckDB SQL: ``sql`` over the named views."""
    duck = lambda s: _TABLE.sub(r"\1", s).replace("{{", "{").replace("}}", "}")
    heads = ", ".join(f"{name} AS ({duck(v)})" for name, v in views.items())
    return (f"WITH {heads} " if heads else "") + duck(sql)


def category_case(name: str = "name") -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in CATEGORY_OF.items()) + " ELSE 'other' END"
