"""The failure ledger and its triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curblake.functions.names import attribution, between_kind, cross_kind
from curblake.functions.rx import computed, first

LEDGER = ("row_id", "stage", "reason_code", "detail", "highway", "between", "between_parsed_input")
# Rank of each tier.
TIERS = {"A_intentional": 0, "A_skipped": 1, "A_trivial": 2, "B_quick": 3, "C_medium": 4, "D_hard": 5}


def ledger(*parts: DataFrame) -> DataFrame:
    """One ledger from the stages' failures; absent columns are null."""
    full = [p.select(*[(F.col(c) if c in p.columns else F.lit(None)).cast("string").alias(c) for c in LEDGER]) for p in parts]
    out = full[0]
    for p in full[1:]:
        out = out.unionByName(p)
    return out


def write_ledger(rows: DataFrame, path: str) -> None:
    """Replaces the slices of the stages in ``rows``, and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage").parquet(path)


def tiers(rows: DataFrame) -> DataFrame:
    """Adds tier, fix_category; reads reason_code, between, cross, and (optional) alias, geo_attribution, street_fix, street_category."""
    col = lambda n: F.col(n) if n in rows.columns else F.lit(None).cast("string")
    rows = computed(rows, _k=cross_kind(col("cross")), _b=between_kind(col("between")))
    rows = computed(rows, _a=attribution(F.col("_k"), F.coalesce(col("cross"), F.lit(""))))
    code, a, k, b, geo, fix = F.col("reason_code"), F.col("_a"), F.col("_k"), F.col("_b"), col("geo_attribution"), col("street_fix")
    missing, error, street, nomatch = code == "INTERSECTION_NOT_FOUND", code == "GEOMETRY_ERROR", code == "STREET_NOT_FOUND", code == "PARSE_NO_MATCH"
    said = lambda tier, what: F.struct(F.lit(tier).alias("tier"), (what if isinstance(what, Column) else F.lit(what)).alias("fix_category"))
    with_kind = lambda head, of: F.concat(F.lit(head), of)
    decision = first(
        (code == "ZERO_SPAN", said("A_skipped", "zero_span_skip")), (code.isin("PARSE_EMPTY_BETWEEN", "PARSE_INVALID", "SCHEDULE_EMPTY"), said("A_trivial", F.lower(code))),
        (missing & F.coalesce(col("cross").contains("/"), F.lit(False)), said("A_trivial", "slash_compound_cross")), (missing & (a == "normalization_unresolved"), said("A_trivial", with_kind("normalizer:", k))), (missing & (a == "regex_misparse"), said("A_trivial", "regex_misparse")),
        (missing & F.coalesce(col("alias").isNotNull(), F.lit(False)), said("B_quick", "street_alias")), (missing & (a == "new_rule_or_geometry"), said("C_medium", with_kind("intersection_rule:", k))), (missing & (a == "mixed"), said("D_hard", "lane_description")),
        (missing & (a == "true_missing_or_complex"), said("D_hard", "true_missing:unknown")), (missing, said("D_hard", with_kind("intersection:", a))), (code == "GEOMETRY_EXCEPTION", said("D_hard", "geometry_exception")), (code == "EMPTY_GEOMETRY", said("A_skipped", "empty_geometry")), (code == "MISSING_RULE_TYPE", said("A_trivial", "missing_rule_type")),
        (error & (geo == "valid_point_zone"), said("A_trivial", "valid_point_zone")), (error & geo.isin("clamp_at_endpoint", "centreline_geometry"), said("C_medium", geo)), (error & (geo == "investigate"), said("D_hard", "geometry_investigate")), (error, said("C_medium", "geometry_zero_length")),
        (nomatch & b.isin("parenthetical", "street_end", "point_opposite_and", "dual_intersection_paren", "point_and_street", "simple_and"), said("C_medium", with_kind("parse_pattern:", b))), (nomatch, said("D_hard", with_kind("parse_pattern:", b))),
        (street & (col("street_category") == "absent"), said("D_hard", "street_not_in_tcl")), (street & (fix == "auto_highway_resolve"), said("B_quick", "street_resolve:auto")), (street & (fix == "lane_infer"), said("C_medium", "street_resolve:lane")), (street & (fix == "manual_alias"), said("C_medium", "street_alias:needed")), (street, said("D_hard", "street_not_found")),
        (code == "AMBIGUOUS_INTERSECTION", said("D_hard", "ambiguous_intersection")), (code == "DISCONNECTED_BLOCK", said("D_hard", "disconnected_block")), default=said("D_hard", F.lower(F.concat_ws(":", "stage", "reason_code"))),
    )
    return computed(rows, _d=decision).select(*[c for c in rows.columns if not c.startswith("_")], "_d.tier", "_d.fix_category")


def in_order(rows: DataFrame) -> DataFrame:
    """O03."""
    rank = first(*[(F.col("tier") == t, F.lit(r)) for t, r in TIERS.items()], default=F.lit(9))
    return rows.orderBy(rank, "stage", "reason_code", F.col("row_id").cast("string"))


def counts(rows: DataFrame, *by: str) -> DataFrame:
    """A06."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def crosstab(rows: DataFrame, by: str, across: str, values: list[str]) -> DataFrame:
    """A column for each value; nothing counts as 0."""
    return rows.groupBy(by).pivot(across, values).agg(F.count(F.lit(1))).na.fill(0)


def top(rows: DataFrame, k: int, *by: str) -> DataFrame:
    """The k most frequent values (null is one), ties by value."""
    return counts(rows, *by).orderBy(F.desc("n"), *[F.col(b).asc_nulls_first() for b in by]).limit(k)


def shares(rows: DataFrame, by: str) -> DataFrame:
    """Percent of all rows; a window over the few groups."""
    return counts(rows, by).withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 2))


def stratified(rows: DataFrame, key: str, dims: list[str], n: int) -> DataFrame:
    """At most n rows (lowest keys) for each value of each dimension; a row once."""
    picked = None
    for d in dims:
        order = Window.partitionBy(d).orderBy(key)
        some = rows.where(F.col(d).isNotNull()).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).select(key)
        picked = some if picked is None else picked.unionByName(some)
    return rows.join(picked.distinct(), key, "left_semi")


def cohort(rows: DataFrame, key: str, wanted: Column, n: int) -> DataFrame:
    """The first n wanted rows by key, filled up with others."""
    return rows.withColumn("_w", F.when(wanted, 0).otherwise(1)).orderBy("_w", key).limit(n).drop("_w")


def difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change): removed, added, or the names of the changed columns."""
    names = [c for c in before.columns if c != key]
    both = before.select(key, F.struct(*names).alias("_old")).join(after.select(key, F.struct(*names).alias("_new")), key, "full")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in names]))
    change = F.when(F.col("_new").isNull(), F.lit("removed")).when(F.col("_old").isNull(), F.lit("added")).otherwise(F.array_join(changed, ","))
    return both.select(key, change.alias("change")).where("change <> ''")


def band(value: Column) -> Column:
    """Confidence bands."""
    return first((value.isNull(), F.lit("none")), (value < 0.5, F.lit("low")), (value < 0.8, F.lit("medium")), default=F.lit("high"))


def feature_counts(features: DataFrame, kind: str, changed: str) -> DataFrame:
    """Features by kind, and when one of the kind was last maintained."""
    return features.groupBy(kind).agg(F.count("*").alias("n"), F.max(changed).alias("last"))


def cohort_gate(parsed: DataFrame, least: float) -> DataFrame:
    """parsed(reason_code): rows, how many parsed, and whether at least the share ``least`` did."""
    n, fine = F.count("*"), F.count_if(F.col("reason_code").isNull())
    return parsed.agg(n.alias("rows"), fine.alias("parsed"), (fine >= n * least).alias("pass"))


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An analysis table that may be missing or have no rows; then an empty one of the given columns."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def run_metadata(edges: DataFrame | None, source: str | None = None, manifest: dict | None = None, crs: str = "EPSG:32617") -> dict:
    """What a run says of its road edges(kind): source, coordinates, manifest, and counts of strips and intersections."""
    found = {r["kind"]: r["n"] for r in edges.groupBy("kind").agg(F.count("*").alias("n")).collect()} if edges is not None else {}
    return {"source": source, "crs": crs, "manifest": dict(manifest or {}), "road_strip_count": found.get("Road Edge", 0), "intersection_count": found.get("Intersection", 0)}
