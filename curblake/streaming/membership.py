"""Rules active at the slots of a stream: beyond the batch operators, on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curblake.operators.membership import is_active


def slots_of(events: DataFrame, at: str = "ts") -> DataFrame:
    """Slot columns of a time."""
    t = F.col(at)
    return events.withColumns({
        "dayOfWeek": F.dayofweek(t) - 1, "minuteOfDay": F.hour(t) * 60 + F.minute(t), "month": F.month(t),
        "dayOfMonth": F.day(t), "year": F.year(t), "majorSnowStorm": F.lit(False),
    })


def active_rules(events: DataFrame, rules: DataFrame, key: str = "area", lateness: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Active rules by window, key and category: each event meets the rules(key, category, schedule) of its own key."""
    asked = slots_of(events).withWatermark("ts", lateness).join(rules, key)
    return asked.where(is_active(F.col("schedule"))).groupBy(F.window("ts", window), key, "category").agg(F.count("*").alias("active"))
