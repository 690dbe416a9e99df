"""Queries of the clean, location, time and membership stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curblake.functions import between as B
from curblake.functions import clock, schedule
from curblake.operators import clean as C
from curblake.operators.membership import active_at
from curblake.plans import views as V

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return V.frame(spark, sf, V.RAW)


_ACTIVE = "action IS DISTINCT FROM 'Repealed' AND name NOT LIKE 'Schedule 9%'"
_CODE = "CASE WHEN shape = 0 THEN 'UNPACK_EMPTY_TABLE' WHEN shape = 1 THEN 'UNPACK_EMPTY_TABLE' WHEN shape = 2 THEN 'UNPACK_PARSE_ERROR' WHEN highway IS NULL THEN 'UNPACK_MISSING_HIGHWAY' END"
_CLEAN = f"""
SELECT *, {V.category_case()} AS cat FROM rules WHERE {_ACTIVE} AND {_CODE} IS NULL"""
_SIDE = "CASE WHEN side IS NULL AND cat IN ('winter_maintenance', 'snow_route', 'snow_streetcar') THEN 'Both' ELSE side END"
_TIMES = f"""CASE WHEN cat = 'winter_maintenance' THEN '{C.WINTER_TIMES}' WHEN cat IN ('snow_route', 'snow_streetcar') THEN '{C.SNOW_TIMES}' WHEN cat = 'car_share' THEN 'Anytime'
  WHEN (times IS NULL OR times = '') AND place IS NOT NULL THEN 'Anytime' WHEN times = '' AND times_key = 'Hours' THEN NULL ELSE nullif(times, '') END"""


@query(V.oracle(f"SELECT id AS _id, name AS schedule FROM rules WHERE {_ACTIVE}", rules=V.RULES))
def clean_active_filter(spark, sf):  # noqa: ANN001, ANN201
    """Projection and null-safe filter right after the scan."""
    return C.active_rules(_raw(spark, sf)).select("_id", F.col("scheduleName").alias("schedule"))


@query(V.oracle(f"SELECT {V.category_case()} AS category, count(*) AS rules FROM rules GROUP BY 1", rules=V.RULES))
def clean_category_counts(spark, sf):  # noqa: ANN001, ANN201
    """F02, A06."""
    return _raw(spark, sf).groupBy(C.category(F.col("scheduleName")).alias("category")).agg(F.count("*").alias("rules"))


@query(V.oracle("SELECT id AS _id, highway, nullif(side, '') AS side, place, times, period FROM rules WHERE shape > 2", rules=V.RULES))
def clean_unpack_fields(spark, sf):  # noqa: ANN001, ANN201
    """F03-F06."""
    rows = C.unpack(_raw(spark, sf)).where(F.size("fields") > 0)
    f = F.col("fields")
    return rows.select("_id", f["Highway"].alias("highway"), C.side(F.lit("other")).alias("side"), C.between().alias("place"), F.coalesce(f["Prohibited Times and/or Days"], f["Hours"]).alias("times"), C.max_period().alias("period"))


@query(V.oracle(f"SELECT {_CODE} AS reason_code, count(*) AS n FROM rules WHERE {_ACTIVE} AND {_CODE} IS NOT NULL GROUP BY 1", rules=V.RULES))
def clean_unpack_failures(spark, sf):  # noqa: ANN001, ANN201
    """Ledger rows of the clean stage by reason."""
    return C.split_unpacked(C.unpack(C.active_rules(_raw(spark, sf))))[1].groupBy("reason_code").agg(F.count("*").alias("n"))


@query(V.oracle(f"SELECT id AS _id, {_TIMES} AS times, coalesce({_TIMES}, CASE WHEN cat IN ('no_parking', 'no_stopping', 'no_standing') THEN 'Anytime' END) AS used FROM c", rules=V.RULES, c=_CLEAN))
def clean_times_defaults(spark, sf):  # noqa: ANN001, ANN201
    """F07, F11."""
    rows = C.split_unpacked(C.unpack(C.active_rules(_raw(spark, sf))))[0]
    times = F.nullif(F.col("`Prohibited Times and/or Days`"), F.lit(""))
    return rows.select("_id", times.alias("times"), F.coalesce(times, C.empty_times_default(F.col("schedule_category"))).alias("used"))


@query(V.oracle(f"SELECT id AS _id, cat AS category, {_SIDE} AS side, place FROM c", rules=V.RULES, c=_CLEAN))
def clean_side_between_coalesce(spark, sf):  # noqa: ANN001, ANN201
    """F04, F05, F08."""
    rows = C.split_unpacked(C.unpack(C.active_rules(_raw(spark, sf))))[0]
    return rows.select("_id", F.col("schedule_category").alias("category"), F.col("Side").alias("side"), F.col("Between").alias("place"))


@query(V.oracle(f"SELECT min(id) AS _id FROM c GROUP BY lower(highway), lower(coalesce({_SIDE}, '')), lower(coalesce(place, '')), lower(coalesce({_TIMES}, '')), lower(coalesce(period, '')), cat", rules=V.RULES, c=_CLEAN))
def clean_dedup_lowest_id(spark, sf):  # noqa: ANN001, ANN201
    """The whole clean stage."""
    return C.clean(_raw(spark, sf))[0].select("_id")


_PLACE_FIELDS = {"rule_type": 1, "start_street": 2, "end_street": 3, "offset_street": 4, "terminus_street": 5, "terminus_direction": 6, "number1": 7, "number2": 8, "bearing": 9}


def _places(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.parse_rows(V.frame(spark, sf, V.PLACES_VIEW))
    return rows.select("id", "template", "reason_code", "rule_type", F.col("start_intersection").alias("start_street"), F.col("end_intersection").alias("end_street"), F.col("offset_intersection").alias("offset_street"), "terminus_street", "terminus_direction", F.coalesce("distance", "dist1").alias("number1"), F.col("dist2").alias("number2"), F.coalesce("direction", "dir1").alias("bearing"))


def _expected(*names: str) -> str:
    cells = {n: f"CAST({V.place_field(i)} AS DOUBLE)" if n.startswith("number") else V.place_field(i) for n, i in _PLACE_FIELDS.items()}
    return ", ".join(f"{cells[n]} AS {n}" for n in names)


def _places_oracle(*names: str) -> str:
    return V.oracle(f"SELECT o_orderkey AS id, {_expected(*names)} FROM {V._ORDERS} ")


@query(V.oracle(f"SELECT {V.case('o_orderkey % 20', [V.text(p[1]) for p in V.PLACES])} AS rule_type, count(*) AS n FROM {V._ORDERS} GROUP BY 1"))
def between_rule_types(spark, sf):  # noqa: ANN001, ANN201
    """Rule types by count (expected by template)."""
    return _places(spark, sf).groupBy("rule_type").agg(F.count("*").alias("n"))


@query(_places_oracle("rule_type", "start_street", "end_street"))
def between_fields_block(spark, sf):  # noqa: ANN001, ANN201
    """B06-B08, B18, B19, B30-B33, T02, T05 (expected by template)."""
    return _places(spark, sf).select("id", "rule_type", "start_street", "end_street")


@query(_places_oracle("rule_type", "start_street", "offset_street", "number1", "number2", "bearing"))
def between_fields_offset(spark, sf):  # noqa: ANN001, ANN201
    """B01-B05, B20-B29, B34, T03, T04 (expected by template)."""
    return _places(spark, sf).select("id", "rule_type", "start_street", "offset_street", "number1", "number2", "bearing")


@query(_places_oracle("rule_type", "start_street", "terminus_street", "terminus_direction"))
def between_fields_terminus(spark, sf):  # noqa: ANN001, ANN201
    """B09-B17 (expected by template)."""
    return _places(spark, sf).select("id", "rule_type", "start_street", "terminus_street", "terminus_direction")


@query(V.oracle("SELECT CASE o_orderkey % 20 WHEN 16 THEN 'PARSE_NO_MATCH' WHEN 17 THEN 'PARSE_EMPTY_BETWEEN' ELSE 'ok' END AS outcome, count(*) AS n FROM {orders} GROUP BY 1"))
def between_failures(spark, sf):  # noqa: ANN001, ANN201
    """Failure codes of the location stage."""
    return _places(spark, sf).groupBy(F.coalesce("reason_code", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("n"))


@query()
def between_preprocess(spark, sf):  # noqa: ANN001, ANN201
    """T01 over whole documents (rows only: RE2 has no look-around)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", F.length(B.preprocess(F.col("text"))).alias("n"))


_SLOT_ORACLE = f"SELECT s.*, {V.HOLIDAYS_2024} AS holiday FROM ({V.SLOTS}) AS s"
_ACTIVE_CASE = V.case("template", [f"({t[1]})" for t in V.TIMES])


def _rules_at_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct schedules with their number by category, beside each distinct slot they are active at."""
    rules = V.frame(spark, sf, V.TIMES_VIEW).withColumn("category", C.category(F.col("name"))).groupBy("category", "times").agg(F.count("*").alias("rules"))
    parsed = schedule.parse_rows(rules).select("category", "rules", "schedule")
    return active_at(parsed, V.frame(spark, sf, V.SLOTS))


_RULES_ORACLE = f"SELECT {V.category_case()} AS category, template, h, k, count(*) AS rules FROM t GROUP BY ALL"
_AT = f"SELECT r.category, r.rules, s.* FROM r, s WHERE {_ACTIVE_CASE}"


def _membership_oracle(sql: str) -> str:
    return V.oracle(sql, t=V.TIMES_VIEW, r=_RULES_ORACLE, s=_SLOT_ORACLE, a=_AT)


@query(_membership_oracle("SELECT category AS schedule_category, CAST(sum(rules) AS BIGINT) AS active_rules FROM a GROUP BY 1"))
def membership_active_counts(spark, sf):  # noqa: ANN001, ANN201
    """D17-D21, the flagship: active rules by category over all slots."""
    return _rules_at_slots(spark, sf).groupBy(F.col("category").alias("schedule_category")).agg(F.sum("rules").alias("active_rules"))


@query(_membership_oracle("SELECT category, CAST(minuteOfDay // 60 AS INT) AS hour, CAST(sum(rules) AS BIGINT) AS active_rules FROM a GROUP BY 1, 2"))
def membership_by_category_hour(spark, sf):  # noqa: ANN001, ANN201
    """D21 by hour."""
    return _rules_at_slots(spark, sf).groupBy("category", F.floor(F.col("minuteOfDay") / 60).cast("int").alias("hour")).agg(F.sum("rules").alias("active_rules"))


@query(_membership_oracle("SELECT month, dayOfMonth, CAST(sum(rules) AS BIGINT) AS active_rules FROM a WHERE holiday GROUP BY 1, 2"))
def membership_holiday(spark, sf):  # noqa: ANN001, ANN201
    """Rules active on public holidays."""
    at = _rules_at_slots(spark, sf).where(clock.is_public_holiday(F.col("year"), F.col("month"), F.col("dayOfMonth")))
    return at.groupBy("month", "dayOfMonth").agg(F.sum("rules").alias("active_rules"))


@query(_membership_oracle("SELECT majorSnowStorm, category, CAST(sum(rules) AS BIGINT) AS active_rules FROM a GROUP BY 1, 2"))
def membership_snow(spark, sf):  # noqa: ANN001, ANN201
    """D21 with and without a declared storm."""
    return _rules_at_slots(spark, sf).groupBy("majorSnowStorm", "category").agg(F.sum("rules").alias("active_rules"))


_STATUS = V.case("template", [V.text(s) for s in ("anytime", *["ok"] * 6, "conditional", "ok", "ok", "anytime", *["ok"] * 4, "failed", "failed", "ok", "ok", "ok")])


@query(V.oracle(f"SELECT {_STATUS} AS status, count(*) AS n, count(*) FILTER (WHERE template IN (8)) AS inverted FROM t GROUP BY 1", t=V.TIMES_VIEW))
def schedule_status_counts(spark, sf):  # noqa: ANN001, ANN201
    """D01, A07 (expected by template)."""
    rows = schedule.parse_rows(V.frame(spark, sf, V.TIMES_VIEW))
    return rows.groupBy(F.col("schedule_status").alias("status")).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("schedule.inverted"), F.lit(False))).alias("inverted"))


@query(V.oracle("SELECT id, CAST(w[1] AS INT) AS startMinute, CAST(w[2] AS INT) AS endMinute FROM (SELECT id, unnest(w) AS w FROM (SELECT id, " + V.case("template", [f"[{', '.join(f'[{a}, {b}]' for a, b in w)}]::BIGINT[][]" for w in V.TIMES_WINDOWS]) + " AS w FROM t))", t=V.TIMES_VIEW))
def schedule_windows_exploded(spark, sf):  # noqa: ANN001, ANN201
    """A row a window (expected by template)."""
    rows = schedule.parse_rows(V.frame(spark, sf, V.TIMES_VIEW))
    return rows.select("id", F.explode("schedule.windows").alias("w")).select("id", "w.startMinute", "w.endMinute")


@query(V.oracle("SELECT id, CASE template WHEN 6 THEN '12-1:3-31' WHEN 13 THEN '4-1:11-30' ELSE '' END AS month_ranges, CASE template WHEN 11 THEN '1:15' WHEN 12 THEN '16:last' ELSE '' END AS days, CASE template WHEN 10 THEN '7,8' WHEN 18 THEN '1,2,3,4,5,6,9,10,11,12' ELSE '' END AS months FROM t", t=V.TIMES_VIEW))
def schedule_calendar(spark, sf):  # noqa: ANN001, ANN201
    """D04, D05, D12, A13, U05 (expected by template)."""
    rows = schedule.parse_rows(V.frame(spark, sf, V.TIMES_VIEW))
    c = F.coalesce(F.col("schedule.calendar"), F.get(F.col("schedule.windows"), F.lit(0))["calendar"])
    text = lambda a: F.coalesce(F.array_join(a, ","), F.lit(""))
    ranges = F.transform(c["monthRanges"], lambda r: F.format_string("%d-%d:%d-%d", r["startMonth"], r["startDay"], r["endMonth"], r["endDay"]))
    days = F.transform(c["dayOfMonthRanges"], lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"]))
    return rows.select("id", text(ranges).alias("month_ranges"), text(days).alias("days"), text(c["months"].cast("array<string>")).alias("months"))


@query(V.oracle("SELECT template, count(*) AS n, count(*) FILTER (WHERE template = 8) AS inverted FROM t GROUP BY 1", t=V.TIMES_VIEW))
def schedule_inverted(spark, sf):  # noqa: ANN001, ANN201
    """D11."""
    rows = schedule.parse_rows(V.frame(spark, sf, V.TIMES_VIEW))
    return rows.groupBy("template").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("schedule.inverted"), F.lit(False))).alias("inverted"))


@query(V.oracle(f"SELECT id, {V.TIMES_JSON} AS json FROM t", t=V.TIMES_VIEW))
def schedule_json(spark, sf):  # noqa: ANN001, ANN201
    """Compact JSON (expected by template)."""
    return schedule.parse_rows(V.frame(spark, sf, V.TIMES_VIEW)).select("id", F.col("schedule_json").alias("json"))


@query(V.oracle("""SELECT o_orderkey AS id, CAST(CASE m WHEN 'noon' THEN 720 WHEN 'midnight' THEN CASE WHEN h = 12 THEN 0 ELSE h * 60 END ELSE (h % 12 + CASE m WHEN 'p.m.' THEN 12 ELSE 0 END) * 60 END + n AS INT) AS minutes
  FROM (SELECT o_orderkey, 1 + o_orderkey % 12 AS h, o_orderkey % 60 AS n, CASE o_orderkey % 4 WHEN 0 THEN 'a.m.' WHEN 1 THEN 'p.m.' WHEN 2 THEN 'noon' ELSE 'midnight' END AS m FROM {orders})"""))
def clock_to_minutes(spark, sf):  # noqa: ANN001, ANN201
    """D13."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    m = F.element_at(F.array(*map(F.lit, ("a.m.", "p.m.", "noon", "midnight"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), clock.clock_minutes(1 + F.col("o_orderkey") % 12, F.col("o_orderkey") % 60, m).alias("minutes"))


@query(V.oracle("SELECT o_orderkey AS id, CAST(CASE o_orderkey % 4 WHEN 0 THEN (1 + o_orderkey % 5) * 60 WHEN 1 THEN 1 + o_orderkey % 5 WHEN 2 THEN 1 + o_orderkey % 5 END AS INT) AS minutes FROM {orders}"))
def max_period_minutes(spark, sf):  # noqa: ANN001, ANN201
    """D14."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    unit = F.element_at(F.array(*map(F.lit, (" hours", " minutes.", " mins", " fortnights"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), clock.max_minutes(F.concat((1 + F.col("o_orderkey") % 5).cast("string"), unit)).alias("minutes"))


_RANGE = "CAST(1 + o_custkey % 12 AS INT) AS sm, CAST(1 + o_custkey % 28 AS INT) AS sd, CAST(1 + o_orderkey % 12 AS INT) AS em, CAST(1 + o_orderkey % 28 AS INT) AS ed, CAST(1 + (o_orderkey * 7) % 12 AS INT) AS m, CAST(1 + (o_orderkey * 5) % 28 AS INT) AS d"


@query(V.oracle(f"SELECT o_orderkey AS id, CASE WHEN sm * 32 + sd <= em * 32 + ed THEN m * 32 + d BETWEEN sm * 32 + sd AND em * 32 + ed ELSE m * 32 + d >= sm * 32 + sd OR m * 32 + d <= em * 32 + ed END AS inside FROM (SELECT o_orderkey, {_RANGE} FROM {{orders}})"))
def month_range_wrap(spark, sf):  # noqa: ANN001, ANN201
    """D15."""
    rows = V.frame(spark, sf, f"SELECT o_orderkey, {_RANGE} FROM {{orders}}")
    return rows.select(F.col("o_orderkey").alias("id"), clock.in_month_range(*[F.col(c) for c in ("m", "d", "sm", "sd", "em", "ed")]).alias("inside"))


@query(V.oracle("SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 5 = 0 THEN 31 ELSE day(last_day(make_date(CAST(2000 + o_orderkey % 30 AS INT), CAST(1 + o_orderkey % 12 AS INT), 1))) END AS INT) AS last FROM {orders}"))
def dom_last_range(spark, sf):  # noqa: ANN001, ANN201
    """D16."""
    k = F.col("o_orderkey")
    year = F.when(k % 5 != 0, (2000 + k % 30).cast("int"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("id"), clock.last_day(year, (1 + k % 12).cast("int")).alias("last"))


@query(V.oracle("SELECT o_orderkey AS id, CASE WHEN e > s THEN m >= s AND m < e ELSE m >= s OR m < e END AS inside FROM (SELECT o_orderkey, (o_orderkey * 37) % 1440 AS m, (o_orderkey * 11) % 1440 AS s, (o_orderkey * 13) % 1440 AS e FROM {orders})"))
def minute_window(spark, sf):  # noqa: ANN001, ANN201
    """D18."""
    k = F.col("o_orderkey")
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("id"), clock.minute_in_window(k * 37 % 1440, k * 11 % 1440, k * 13 % 1440, F.lit(False)).alias("inside"))


_EASTER = "(SELECT y, make_date(y, CAST(n // 31 AS INT), CAST(n % 31 + 1 AS INT)) AS easter FROM (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n, a FROM (SELECT y, a, h, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c, (19 * (y % 19) + y // 100 - (y // 100) // 4 - ((y // 100) - ((y // 100) + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM years))))"


@query(V.oracle(f"SELECT CAST(y AS INT) AS year, CAST(easter - 2 AS VARCHAR) AS good_friday, CAST(make_date(y, 9, 1) + CAST((8 - isodow(make_date(y, 9, 1))) % 7 AS INT) AS VARCHAR) AS labour_day FROM {_EASTER}", years="SELECT DISTINCT CAST(2000 + o_custkey % 60 AS INT) AS y FROM {orders}"))
def holiday_flag(spark, sf):  # noqa: ANN001, ANN201
    """Two movable holidays of each year."""
    years = V.frame(spark, sf, "SELECT DISTINCT CAST(2000 + o_custkey % 60 AS INT) AS year FROM {orders}")
    days = clock.public_holidays(F.col("year"))
    pick = lambda month, dow: F.filter(days, lambda d: (F.month(d).isin(*month)) & (F.dayofweek(d) == dow))[0]
    return years.select("year", F.date_sub(clock.easter(F.col("year")), 2).cast("string").alias("good_friday"), pick((9,), 2).cast("string").alias("labour_day"))
