"""From raw rules to clean rows: filter, unpack, project, de-duplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curblake.functions.rx import blank, computed, first, norm_cell, truthy

# The schedules of each category, in arabic and in roman spelling.
SCHEDULES = {
    "no_parking": ("13", "XIII", "No Parking"),
    "no_stopping": ("14", "XIV", "No Stopping"),
    "restricted_periods": ("15", "XV", "Parking for Restricted Periods"),
    "no_standing": ("16", "XVI", "No Standing"),
    "winter_maintenance": ("04", "IV", "Former City of North York Winter Maintenance Parking Prohibited"),
    "snow_route": ("17A", "XVIIA", "Parking And Standing during Major Snow Storm Conditions"),
    "snow_streetcar": ("17B", "XVIIB", "Parking/Standing on or Blocking Streetcar Tracks during Major Snow Storm Conditions"),
    "ev_charging": ("44", "XLIV", "Electrical Vehicle Charging Station Parking"),
    "car_share": ("43", "XLIII", "Car Share Vehicle Parking Areas"),
    "commercial_loading": ("06", "VI", "Commercial Loading Zones"),
    "passenger_loading": ("07", "VII", "Passenger Loading Zones"),
    "delivery_loading": ("09", "IX", "Delivery Vehicle Parking Zones"),
    "taxicab_stand": ("05", "V", "Stands for Taxicabs"),
}
WINTER_TIMES = "2:00 a.m. to 6:00 a.m. from Dec. 1 to Mar. 31"
SNOW_TIMES = "Major Snow Storm Conditions"
BOTH_SIDES = ("winter_maintenance", "snow_route", "snow_streetcar")
ALWAYS = ("no_parking", "no_stopping", "no_standing", "car_share")

CATEGORY_OF = {name: c for c, (arabic, roman, what) in SCHEDULES.items() for name in (f"Schedule {arabic}: {what}", f"SCHEDULE {roman}: {what}")}

OUTPUT = ("_id", "scheduleName", "schedule_category", "Highway", "Side", "Between", "Prohibited Times and/or Days", "Maximum Period Permitted")
DEDUP_KEYS = ("Highway", "Side", "Between", "Prohibited Times and/or Days", "Maximum Period Permitted", "schedule_category")

ENTRY = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))


def active_rules(raw: DataFrame) -> DataFrame:
    """not repealed (no action counts as active) and on the list of schedules."""
    return raw.where(~F.col("Latest_Action").eqNullSafe("Repealed") & F.col("scheduleName").isin(list(CATEGORY_OF)))


def category(name: Column) -> Column:
    """F02."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in CATEGORY_OF.items() for x in kv])[name], F.lit("other"))


def _list_text(cell: Column) -> Column:
    """The cell without up to two layers of quotes around the list, with bare literals as JSON spells them."""
    text = F.trim(cell)
    for _ in range(2):
        inner = F.regexp_replace(F.substring(text, F.lit(2), F.length(text) - 2), r"\\([\"'])", "$1")
        text = F.when(text.rlike(r"(?s)^([\"']).*\1$"), F.trim(inner)).otherwise(text)
    return F.regexp_replace(F.regexp_replace(text, r"(:\s*)None(?=\s*[,}])", "$1null"), r"(:\s*)(True|False)(?=\s*[,}])", "$1\"$2\"")


def unpack(rows: DataFrame, cell: str = "ByLaw_Table") -> DataFrame:
    """adds fields (a map; of equal keys the last counts) and unpack_error (a code, null if fine)."""
    entries = F.from_json(F.col("_text"), ENTRY, {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true", "mode": "PERMISSIVE"})
    rows = computed(computed(rows, _text=_list_text(F.col(cell))), _entries=F.filter(entries, lambda e: e["key"].isNotNull()))
    last = F.filter("_entries", lambda e, i: ~F.exists(F.slice("_entries", i + 2, F.size("_entries")), lambda later: later["key"] == e["key"]))
    rows = computed(rows, fields=F.map_from_entries(last))
    looks_like_list = F.col("_text").rlike(r"(?s)^\[.*\]$")
    error = first(
        (blank(F.col(cell)), F.lit("UNPACK_EMPTY_TABLE")),
        (~looks_like_list & F.col("_text").rlike(r"^[\[{]"), F.lit("UNPACK_PARSE_ERROR")),
        (~looks_like_list & ~F.col("_text").rlike(r"^(?:[0-9.]+|null|)$"), F.lit("UNPACK_PARSE_ERROR")),
        (F.col("_text").rlike(r"^\[\s*\]$") | ~looks_like_list, F.lit("UNPACK_EMPTY_TABLE")),
        (F.col("_entries").isNull(), F.lit("UNPACK_PARSE_ERROR")),
        (F.size("_entries") == 0, F.lit("UNPACK_EMPTY_TABLE")),
        (blank(F.col("fields")["Highway"]), F.lit("UNPACK_MISSING_HIGHWAY")),
        default=F.lit(None).cast("string"),
    )
    return computed(rows, unpack_error=error).drop("_text", "_entries")


def _field(*names: str) -> Column:
    return F.coalesce(*[truthy(F.col("fields")[n]) for n in names])


def side(cat: Column) -> Column:
    """F04."""
    found = _field("Side", "Side Parking")
    return F.when(blank(found) & cat.isin(*BOTH_SIDES), F.lit("Both")).otherwise(found)


def between() -> Column:
    """F05."""
    return _field("Between", "Location")


def max_period() -> Column:
    """F06."""
    return _field("Maximum Period Permitted", "Maximum Period Parking")


def times(cat: Column) -> Column:
    """F07."""
    prohibited, other = F.col("fields")["Prohibited Times and/or Days"], _field("Times and/or Days", "Hours (daily as indicated below)", "Hours")
    return first(
        (cat == "winter_maintenance", F.lit(WINTER_TIMES)),
        (cat.isin("snow_route", "snow_streetcar"), F.lit(SNOW_TIMES)),
        (cat == "car_share", F.lit("Anytime")),
        (blank(prohibited) & blank(other) & F.coalesce(between().rlike(r"(?i)\banytime\b"), F.lit(False)), F.lit("Anytime")),
        (blank(prohibited), other),
        default=prohibited,
    )


def project(unpacked: DataFrame) -> DataFrame:
    """the eight output columns."""
    cat = F.col("schedule_category")
    rows = unpacked.withColumn("schedule_category", category(F.col("scheduleName")))
    made = {"Highway": F.col("fields")["Highway"], "Side": side(cat), "Between": between(), "Prohibited Times and/or Days": times(cat), "Maximum Period Permitted": max_period()}
    return rows.select("_id", "scheduleName", "schedule_category", *[v.alias(k) for k, v in made.items()])


def split_unpacked(unpacked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, ledger rows of what can't be unpacked).  The ledger takes Between, never Location."""
    failed = unpacked.where(F.col("unpack_error").isNotNull())
    ledger = failed.select(F.col("_id").cast("string").alias("row_id"), F.lit("clean").alias("stage"), F.col("unpack_error").alias("reason_code"), F.col("fields")["Highway"].alias("highway"), F.col("fields")["Between"].alias("between"))
    return project(unpacked.where(F.col("unpack_error").isNull())), ledger


def deduplicate(rows: DataFrame) -> DataFrame:
    """Of rows with equal normalised keys the one with the lowest numeric id (ids that aren't numbers last, then by text)."""
    keys = [norm_cell(F.col(f"`{k}`")) for k in DEDUP_KEYS]
    order = Window.partitionBy(*keys).orderBy(F.col("_id").try_cast("double").asc_nulls_last(), F.col("_id").cast("string"))
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == 1).drop("_n")


def empty_times_default(cat: Column) -> Column:
    """F11."""
    return first((cat == "winter_maintenance", F.lit(WINTER_TIMES)), (cat.isin("snow_route", "snow_streetcar"), F.lit(SNOW_TIMES)), (cat.isin(*ALWAYS), F.lit("Anytime")), default=F.lit(None).cast("string"))


def clean(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The clean stage: (clean rows, ledger rows)."""
    ok, failed = split_unpacked(unpack(active_rules(raw)))
    return deduplicate(ok), failed
