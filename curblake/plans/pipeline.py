"""The stages as one plan (V10, K02): raw rules to clean rows with their schedule, place and resolved street, and one ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curblake.functions import between, schedule
from curblake.operators import clean, triage
from curblake.operators.membership import is_active, schedule_json
from curblake.operators.resolve import NameIndex, resolve_names


def stages(raw: DataFrame, index: NameIndex) -> tuple[DataFrame, DataFrame]:
    """(rules with schedule, parse and resolved street; ledger).  Nothing is written between the stages."""
    rows, failed = clean.clean(raw)
    rows = rows.select("_id", "schedule_category", F.col("Highway").alias("highway"), F.col("Side").alias("side"), F.col("Between").alias("between"), F.coalesce(F.nullif(F.trim("Prohibited Times and/or Days"), F.lit("")), clean.empty_times_default(F.col("schedule_category"))).alias("times"))
    rows = schedule.parse_rows(rows)
    no_times = rows.where("times IS NULL").select(F.col("_id").alias("row_id"), F.lit("schedule").alias("stage"), F.lit("SCHEDULE_EMPTY").alias("reason_code"), "highway", "between")
    rows = between.parse_rows(rows)
    no_place = rows.where("reason_code IS NOT NULL").select(F.col("_id").alias("row_id"), F.lit("parse").alias("stage"), "reason_code", F.col("parse_error").alias("detail"), "highway", "between")
    rows = resolve_names(rows.where("reason_code IS NULL").drop("reason_code"), index)
    no_street = rows.where("NOT resolve_valid").select(F.col("_id").alias("row_id"), F.lit("resolve").alias("stage"), F.lit("RESOLVE_STREET_NOT_FOUND").alias("reason_code"), "highway", "between")
    return rows, triage.ledger(failed, no_times, no_place, no_street)


def register(spark: SparkSession) -> None:
    """SQL functions of the engine, and explode_windows(schedule_json) as a table function."""
    from pyspark.sql.functions import udtf

    from curblake.functions.schedule import _document

    spark.udf.register("parse_schedule_json", lambda source, repaired: _document(source, repaired), "string")

    class ExplodeWindows:
        def eval(self, document: str):  # noqa: ANN201
            import json

            for w in json.loads(document or "{}").get("windows", []):
                for day in w["days"]:
                    yield day, w["startMinute"], w["endMinute"]

    spark.udtf.register("explode_windows", udtf(ExplodeWindows, returnType="day int, startMinute int, endMinute int"))


__all__ = ["is_active", "register", "schedule_json", "stages"]
