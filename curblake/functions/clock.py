"""Clock and calendar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curblake.functions.rx import FLAGS, first

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def clock_minutes(hour: Column, minute: Column, meridiem: Column) -> Column:
    """Minute of day of a 12-hour time; noon is hour 12, 12 midnight hour 0."""
    m = F.lower(F.regexp_replace(meridiem, r"\.", ""))
    h = F.when(m == "am", hour % 12).when(m == "pm", hour % 12 + 12).otherwise(hour)
    h = F.when(m == "noon", 12).when((m == "midnight") & (hour == 12), 0).otherwise(h)
    return (h * 60 + minute).cast("int")


def max_minutes(text: Column) -> Column:
    """D14: "2 hours" -> 120."""
    pattern = FLAGS + r"^\s*(\d+)\s*(hours?|hrs?|mins?|minutes?)\b"
    n, unit = F.regexp_extract(text, pattern, 1).try_cast("int"), F.lower(F.regexp_extract(text, pattern, 2))
    return F.when(unit.startswith("h"), n * 60).when(unit != "", n)


def in_month_range(month: Column, day: Column, sm: Column, sd: Column, em: Column, ed: Column) -> Column:
    """Inclusive; wraps over the year's end."""
    at, lo, hi = month * 32 + day, sm * 32 + sd, em * 32 + ed
    return F.when(lo <= hi, (at >= lo) & (at <= hi)).otherwise((at >= lo) | (at <= hi))


def last_day(year: Column, month: Column) -> Column:
    """31 when the year isn't known."""
    return F.coalesce(F.day(F.last_day(F.make_date(year, month, F.lit(1)))), F.lit(31))


def minute_in_window(minute: Column, start: Column, end: Column, crosses: Column) -> Column:
    """The end is exclusive; wraps if flagged or if it doesn't end after its start."""
    wraps = F.coalesce(crosses, F.lit(False)) | (end <= start)
    return F.when(wraps, (minute >= start) | (minute < end)).otherwise((minute >= start) & (minute < end))


def month_number(token: Column) -> Column:
    """Number of a month name or its abbreviation of three letters or more, with or without a point."""
    t = F.lower(F.regexp_replace(F.trim(token), r"\.$", ""))
    return first(*[((t == m) | (t == m[:3]) | ((t == "sept") if m == "september" else F.lit(False)), F.lit(i)) for i, m in enumerate(MONTHS, 1)], default=F.lit(None).cast("int"))


def easter(year: Column) -> Column:
    """Date of Easter Sunday (Gregorian computus)."""
    q = lambda a, b: F.floor(a / b).cast("int")
    a, b, c = year % 19, q(year, 100), year % 100
    h = (19 * a + b - q(b, 4) - q(b - q(b + 8, 25) + 1, 3) + 15) % 30
    w = (32 + 2 * (b % 4) + 2 * q(c, 4) - h - c % 4) % 7
    m = q(a + 11 * h + 22 * w, 451)
    n = h + w - 7 * m + 114
    return F.make_date(year, q(n, 31), n % 31 + 1)


def public_holidays(year: Column) -> Column:
    """The province's public holidays of a year (observed dates): an array of dates."""
    day = lambda m, d: F.make_date(year, F.lit(m), F.lit(d))
    monday = lambda m, nth: F.date_add(F.next_day(F.date_sub(day(m, 1), 1), "Mon"), 7 * (nth - 1))
    dow = F.dayofweek

    def observed(d: Column) -> Column:
        return F.when(dow(d) == 7, F.date_add(d, 2)).when(dow(d) == 1, F.date_add(d, 1))

    christmas, boxing = day(12, 25), day(12, 26)
    # one substitute day: a Christmas on Sunday is observed on the 26th, on Saturday on the 27th
    return F.array_distinct(F.array_compact(F.array(
        day(1, 1), observed(day(1, 1)), monday(2, 3), F.date_sub(easter(year), 2), F.date_sub(F.next_day(day(5, 24), "Mon"), 7),
        day(7, 1), observed(day(7, 1)), monday(9, 1), monday(10, 2), christmas, boxing, observed(christmas),
        F.when(dow(boxing) == 7, F.date_add(boxing, 2)),
    )))


def is_public_holiday(year: Column, month: Column, day: Column) -> Column:
    """False when the year isn't known."""
    return F.coalesce(F.array_contains(public_holidays(year), F.make_date(year, month, day)), F.lit(False))
