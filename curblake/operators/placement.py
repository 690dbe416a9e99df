"""Pieces of streets onto curbs, as one call (C01, C05, C07, C08, C10, C11, C14, C18, F20, J17): a row a rule, with its curb line and QA fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.functions.lines import compass8, point
from curblake.functions.rx import computed
from curblake.operators import curbs

NO_SIDE = ("specialized", "unresolved")


def _points(side: str) -> Column:
    """The curb's points on one side, in order of the samples: hits where there are any, else at the offset."""
    return F.transform(
        F.filter("_rays", lambda r: r["side"] == side),
        lambda r: point(r["o"]["x"] + r["d"]["x"] * F.coalesce(F.when(F.col("method") == "road_edge", r["hit"]), F.col("_offset")), r["o"]["y"] + r["d"]["y"] * F.coalesce(F.when(F.col("method") == "road_edge", r["hit"]), F.col("_offset"))),
    )


def place(rows: DataFrame, walls: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """rows(row_id, piece, mode, directions) and walls(wall_id, p, q) -> rows with side_found, method, confidence, coverage,
    warnings and curb (array of lines: one a side).

    Special and unresolved sides keep the centreline with confidence 0, unless overrides(row_id, method) names a side
    (left, right or both) to offset to.
    """
    samples = curbs.rays(rows.select(F.col("row_id").alias("line_id"), F.col("piece").alias("line")))
    hits = curbs.cast(samples, walls)
    rays = samples.select("line_id", F.explode("rays").alias("_r")).select("line_id", "_r.s", "_r.o", "_r.d", F.explode(F.array(F.lit("left"), F.lit("right"))).alias("side"))
    way = F.when(F.col("side") == "left", 1.0).otherwise(-1.0)
    rays = rays.withColumn("d", point(way * F.col("d.x"), way * F.col("d.y")))
    full = rays.hint("merge").join(hits, ["line_id", "s", "side"], "left")
    compass = compass8(F.col("d.x"), F.col("d.y"))
    per = full.groupBy(F.col("line_id").alias("row_id")).agg(
        F.array_sort(F.collect_list(F.struct("s", "side", "o", "d", "hit"))).alias("_rays"),
        F.collect_list(F.when(F.col("side") == "left", compass)).alias("_left"), F.collect_list(F.when(F.col("side") == "right", compass)).alias("_right"),
        F.countDistinct("s").alias("_samples"), F.count_if(F.col("hit").isNotNull() & (F.col("side") == "left")).alias("_l"), F.count_if(F.col("hit").isNotNull() & (F.col("side") == "right")).alias("_r"),
        F.countDistinct(F.when(F.col("hit").isNotNull(), F.col("s"))).alias("_met"), F.median("hit").alias("_median"),
    )
    out = rows.join(per, "row_id", "left").withColumn("coverage", F.coalesce(F.col("_met") / F.col("_samples"), F.lit(0.0)))
    wanted = F.coalesce("directions", F.array().cast("array<string>"))
    out = out.withColumns({"left_share": curbs.direction_share(F.coalesce("_left", F.array().cast("array<string>")), wanted), "right_share": curbs.direction_share(F.coalesce("_right", F.array().cast("array<string>")), wanted)})
    out = curbs.choose(out)
    if overrides is not None:
        named = overrides.select("row_id", F.col("method").alias("_override"))
        out = out.join(named, "row_id", "left")
    else:
        out = out.withColumn("_override", F.lit(None).cast("string"))
    special = F.col("mode").isin(*NO_SIDE)
    forced = special & F.col("_override").isin("left", "right", "both")
    out = computed(
        out,
        _side=F.when(forced, F.col("_override")).when(~special, F.col("side_found")),
        _method=F.when(forced, "override").when(special, "unresolved").otherwise(F.col("method")),
        _confidence=F.when(forced, 0.45).when(special, 0.0).otherwise(F.col("confidence")),
        _warnings=F.when(special & ~forced, F.array(F.lit("SIDE_AMBIGUOUS"), F.lit("CENTERLINE_FALLBACK"))).otherwise(F.col("warnings")),
        _offset=curbs.offset_for(F.col("_median"), F.lit(None).cast("double"), F.lit(None).cast("double")),
    )
    out = out.drop("side_found", "method", "confidence", "warnings").withColumnsRenamed({"_side": "side_found", "_method": "method", "_confidence": "confidence", "_warnings": "warnings"})
    sides = F.array_compact(F.array(*[F.when(F.col("side_found").isin(s, "both"), _points(s)) for s in ("left", "right")]))
    curb = F.when(F.col("side_found").isNull(), F.array("piece")).otherwise(sides)
    return computed(out, curb=curb).select(*rows.columns, "side_found", "method", "confidence", "coverage", "warnings", "curb")


def feature_flags(category: Column) -> dict[str, Column]:
    """F20."""
    return {"is_snow_route": category.isin("snow_route", "snow_streetcar"), "streetcar_corridor": category == "snow_streetcar"}
