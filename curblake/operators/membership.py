"""Is a rule active at a slot? (D17-D21): one Column over the schedule struct and the slot's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curblake.functions.clock import in_month_range, is_public_holiday, last_day, minute_in_window

_I = T.IntegerType()
_range = T.StructType([T.StructField(n, _I) for n in ("startMonth", "startDay", "endMonth", "endDay")])
_days = T.StructType([T.StructField("start", _I), T.StructField("end", T.StringType())])
CALENDAR = T.StructType([T.StructField("months", T.ArrayType(_I)), T.StructField("monthRanges", T.ArrayType(_range)), T.StructField("dayOfMonthRanges", T.ArrayType(_days))])
WINDOW = T.StructType([T.StructField("days", T.ArrayType(_I)), T.StructField("startMinute", _I), T.StructField("endMinute", _I), T.StructField("crossesMidnight", T.BooleanType()), T.StructField("calendar", CALENDAR)])
SCHEDULE = T.StructType([
    T.StructField("v", _I), T.StructField("status", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("inverted", T.BooleanType()), T.StructField("condition", T.StringType()), T.StructField("is_snow_route", T.BooleanType()),
    T.StructField("windows", T.ArrayType(WINDOW)), T.StructField("calendar", CALENDAR),
    T.StructField("flags", T.StructType([T.StructField("exceptPublicHolidays", T.BooleanType())])), T.StructField("unparsedClauses", T.ArrayType(T.StringType())),
])
#: Columns of a slot.
SLOT = ("dayOfWeek", "minuteOfDay", "month", "dayOfMonth", "year", "majorSnowStorm")


def schedule_of(json: Column) -> Column:
    """The schedule struct of its JSON text; null if it can't be read."""
    return F.from_json(json, SCHEDULE, {"mode": "PERMISSIVE"})


def schedule_json(schedule: Column) -> Column:
    """Compact JSON without absent keys."""
    return F.to_json(schedule, {"ignoreNullFields": "true"})


def in_calendar(c: Column) -> Column:
    """Months and every day-of-month range and every month range; an absent calendar holds always."""
    month, day, year = F.col("month"), F.col("dayOfMonth"), F.col("year")
    months = c["months"].isNull() | F.array_contains(c["months"], month)

    def day_fits(r: Column) -> Column:
        end = F.when(r["end"] == "last", last_day(year, month)).otherwise(r["end"].try_cast("int"))
        return (day >= r["start"]) & (day <= end)

    days = F.coalesce(F.forall(c["dayOfMonthRanges"], day_fits), F.lit(True))
    ranges = F.coalesce(F.forall(c["monthRanges"], lambda r: in_month_range(month, day, r["startMonth"], r["startDay"], r["endMonth"], r["endDay"])), F.lit(True))
    return F.coalesce(months & days & ranges, F.lit(True))


def _holiday() -> Column:
    return is_public_holiday(F.col("year"), F.col("month"), F.col("dayOfMonth"))


def _time_and_day(w: Column, schedule: Column) -> Column:
    calendar = F.when(w["calendar"].isNotNull(), in_calendar(w["calendar"])).otherwise(in_calendar(schedule["calendar"]))
    return calendar & F.array_contains(w["days"], F.col("dayOfWeek")) & minute_in_window(F.col("minuteOfDay"), w["startMinute"], w["endMinute"], w["crossesMidnight"])


def is_active(s: Column) -> Column:
    """The membership query.  The slot is the row's columns named in SLOT."""
    windows = F.coalesce(s["windows"], F.array().cast(T.ArrayType(WINDOW)))
    except_holidays = F.coalesce(s["flags"]["exceptPublicHolidays"], F.lit(False))
    matched = F.exists(windows, lambda w: _time_and_day(w, s)) & ~(except_holidays & _holiday())
    excepted = F.exists(windows, lambda w: _time_and_day(w, s)) | (except_holidays & _holiday() & (F.size(windows) > 0))
    inverted = F.when(F.size(windows) == 0, s["status"] == "anytime").otherwise(~excepted)
    answer = (
        F.when(s["status"] == "failed", False)
        .when(~in_calendar(s["calendar"]), False)
        .when(F.coalesce(s["inverted"], F.lit(False)), inverted)
        .when(s["status"] == "conditional", (s["condition"] == "major_snowstorm_declared") & F.coalesce(F.col("majorSnowStorm"), F.lit(False)))
        .when(s["status"] == "anytime", True)
        .otherwise(matched)
    )
    return F.coalesce(answer, F.lit(False))


def cells(s: Column) -> Column:
    """Where a schedule may be active: numbers of weekday x hour.  Windows give theirs, any other schedule all 168, a failed one none."""
    windows = F.coalesce(s["windows"], F.array().cast(T.ArrayType(WINDOW)))

    def of(w: Column) -> Column:
        end = F.when(F.coalesce(w["crossesMidnight"], F.lit(False)) | (w["endMinute"] <= w["startMinute"]), w["endMinute"] + 1440).otherwise(w["endMinute"])
        hours = F.sequence(F.floor(w["startMinute"] / 60).cast("int"), F.floor((F.greatest(end, w["startMinute"] + 1) - 1) / 60).cast("int"))
        return F.flatten(F.transform(w["days"], lambda d: F.transform(hours, lambda h: (d * 24 + h % 24).cast("int"))))

    by_windows = ~F.coalesce(s["inverted"], F.lit(False)) & ~s["status"].isin("anytime", "conditional")
    own = F.array_distinct(F.flatten(F.transform(F.filter(windows, lambda w: w["days"].isNotNull() & w["startMinute"].isNotNull() & w["endMinute"].isNotNull()), of)))
    return F.when(s["status"] == "failed", F.array().cast("array<int>")).when(by_windows, own).otherwise(F.sequence(F.lit(0), F.lit(7 * 24 - 1)))


def active_at(schedules: DataFrame, slots: DataFrame, schedule: str = "schedule") -> DataFrame:
    """D21 for tables: the rows of ``schedules`` beside each of the ``slots`` (columns of SLOT) they are active at.

    Both meet on weekday and hour, so only a schedule's own hours are looked at; a pair meets once.
    """
    at = slots.select(*SLOT, (F.col("dayOfWeek") * 24 + F.floor(F.col("minuteOfDay") / 60)).cast("int").alias("_cell"))
    where = schedules.withColumn("_cell", F.explode(cells(F.col(schedule))))
    return where.join(at, "_cell").where(is_active(F.col(schedule))).drop("_cell")
