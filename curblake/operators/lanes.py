"""Unnamed lanes: "Lane first north of Bloor Street West" to a legal lane key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.functions.names import root
from curblake.functions.rx import computed, group, has

_PLACE = r"(?:(first|second|third)\s+)?(north|south|east|west)\s+of\s+([^,;]+)"


def phrases(highway: Column, between: Column) -> Column:
    """Distinct (ordinal, way, anchor) of the highway, else of all fragments of a generic lane's location."""
    generic = has(F.trim(highway), r"^lane(?:way)?$")
    text = F.when(generic, between).when(has(highway, rf"^\s*lane(?:way)?\b\s*,?\s*{_PLACE}"), highway)
    ordinal, way, anchor = (F.regexp_extract_all(text, F.lit("(?i)" + _PLACE), F.lit(i)) for i in (1, 2, 3))
    trimmed = lambda a: F.trim(F.regexp_replace(a, r"(?i)\s+and\s+(?:a\s+point|the\b).*$", ""))
    return F.array_distinct(F.zip_with(F.arrays_zip(ordinal.alias("o"), way.alias("w")), anchor, lambda p, a: F.struct(F.nullif(F.lower(p["o"]), F.lit("")).alias("ordinal"), F.lower(p["w"]).alias("way"), trimmed(a).alias("anchor"))))


def lane_index(legal: DataFrame) -> DataFrame:
    """Legal keys such as "ln 1 n bloor w dufferin": (legal, number, way, street, cross)."""
    pattern = r"^ln(?:\s+(\d+))?\s+([nsew])\s+(.+?)\s+([nsew])\s+(.+)$"
    rows = computed(legal.where(F.col("legal").startswith("ln ")), **{n: group(F.col("legal"), pattern, i) for n, i in (("number", 1), ("way", 2), ("street", 3), ("cross", 5))})
    return rows.where(F.col("street").isNotNull())


def _component(part: str, key: str) -> Column:
    """A lane's street word fits a key that is it or starts with it."""
    return (F.col(key) == F.col(part)) | F.col(key).startswith(F.concat(F.col(part), F.lit(" ")))


def resolve_lanes(rows: DataFrame, legal: DataFrame, crosses: DataFrame) -> DataFrame:
    """rows(row, highway, between) and crosses(row, cross_key) -> (row, legal) where exactly one lane fits.

    A lane fits a phrase if its way and street do, and its cross street fits one of the row's crosses if it
    has any; with several phrases it must fit all; an ordinal narrows to lanes of that number if there are any.
    """
    said = rows.withColumn("_p", phrases(F.col("highway"), F.col("between"))).withColumn("_n", F.size("_p")).where("_n > 0")
    each = said.select("row", "_n", F.posexplode("_p").alias("_i", "p")).select("row", "_n", "_i", "p.ordinal", F.substring("p.way", 1, 1).alias("way"), root(F.col("p.anchor")).alias("anchor"))
    index = lane_index(legal)
    # equi-join on the way and the first word, then the exact test
    fits = each.withColumn("_w", F.split("anchor", " ")[0]).join(index.withColumn("_w", F.split("street", " ")[0]), ["way", "_w"]).where(_component("street", "anchor"))
    hints = fits.join(crosses, "row", "left").withColumn("_c", F.col("cross_key").isNotNull()).withColumn("_ok", ~F.col("_c") | F.coalesce(_component("cross", "cross_key"), F.lit(False)))
    fits = hints.groupBy("row", "_n", "_i", "ordinal", "legal", "number").agg(F.bool_or("_ok").alias("_ok")).where("_ok")
    wanted = F.when(F.col("ordinal") == "first", "1").when(F.col("ordinal") == "second", "2").when(F.col("ordinal") == "third", "3")
    whole = fits.groupBy("row", "_n", "legal", "number").agg(F.countDistinct("_i").alias("_m"), F.max(wanted).alias("_want")).where("_m = _n")
    numbered = whole.withColumn("_hit", F.coalesce(F.col("number") == F.col("_want"), F.lit(False)))
    some = numbered.groupBy("row").agg(F.bool_or("_hit").alias("_any"))
    left = numbered.join(some, "row").where(~F.col("_any") | F.col("_hit"))
    return left.groupBy("row").agg(F.min("legal").alias("legal"), F.countDistinct("legal").alias("_k")).where("_k = 1").drop("_k")


def choose_by_graph(candidates: DataFrame, statuses: DataFrame) -> DataFrame:
    """candidates(row, legal) and statuses(row, legal, status) of the path between the row's crosses on each lane ->
    (row, legal) where exactly one candidate has a single best path."""
    fine = candidates.join(statuses.where("status = 'ok'").select("row", "legal").distinct(), ["row", "legal"], "left_semi")
    return fine.groupBy("row").agg(F.min("legal").alias("legal"), F.countDistinct("legal").alias("_k")).where("_k = 1").drop("_k")
