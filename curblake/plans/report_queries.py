"""Queries of the ledger, triage, reports, samples and dimensions, and of the stages as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curblake.functions import between as B
from curblake.functions import names as N
from curblake.functions.rx import blank
from curblake.operators import clean as C
from curblake.operators import triage as T
from curblake.plans import views as V
from curblake.plans.space_queries import LINES, _lines
from curblake.plans.text_queries import _ACTIVE, _CODE
from curblake.sources import readers, sinks
from curblake.streaming.membership import slots_of

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    raw = V.frame(spark, sf, V.RAW)
    failed = C.split_unpacked(C.unpack(C.active_rules(raw)))[1]
    places = B.parse_rows(V.frame(spark, sf, V.PLACES_VIEW)).where("reason_code IS NOT NULL")
    empty = V.frame(spark, sf, V.TIMES_VIEW).where(blank(F.col("times")))  # nothing to parse
    return T.ledger(failed, places.select(F.col("id").alias("row_id"), F.lit("parse").alias("stage"), "reason_code", "between"), empty.select(F.col("id").alias("row_id"), F.lit("schedule").alias("stage"), F.lit("SCHEDULE_EMPTY").alias("reason_code")))


_LEDGER = f"SELECT id AS row_id, 'clean' AS stage, {_CODE} AS reason_code FROM rules WHERE {_ACTIVE} AND {_CODE} IS NOT NULL UNION ALL SELECT o_orderkey, 'parse', CASE o_orderkey % 20 WHEN 16 THEN 'PARSE_NO_MATCH' ELSE 'PARSE_EMPTY_BETWEEN' END FROM {{orders}} WHERE o_orderkey % 20 IN (16, 17) UNION ALL SELECT o_orderkey, 'schedule', 'SCHEDULE_EMPTY' FROM {{orders}} WHERE o_orderkey % 20 = 16"


@query(V.oracle("SELECT CAST(row_id AS VARCHAR) AS row_id, stage, reason_code FROM l", rules=V.RULES, l=_LEDGER))
def ledger_union(spark, sf):  # noqa: ANN001, ANN201
    """Failures of the stages as one ledger."""
    return _ledger(spark, sf).select("row_id", "stage", "reason_code")


@query(V.oracle("SELECT stage, reason_code, count(*) AS n FROM l GROUP BY 1, 2", rules=V.RULES, l=_LEDGER))
def ledger_reason_counts(spark, sf):  # noqa: ANN001, ANN201
    """A06."""
    return T.counts(_ledger(spark, sf), "stage", "reason_code")


#: Failures with their cross street or location text, and the tier and category that are expected of each.
_FAILURES = (
    ("ZERO_SPAN", None, None, "A_skipped", "zero_span_skip"), ("PARSE_INVALID", None, "x", "A_trivial", "parse_invalid"), ("INTERSECTION_NOT_FOUND", "A St/B St", None, "A_trivial", "slash_compound_cross"), ("INTERSECTION_NOT_FOUND", "Rose Gardens", None, "A_trivial", "normalizer:gardens_spelling"),
    ("INTERSECTION_NOT_FOUND", "a point 30 metres north", None, "A_trivial", "regex_misparse"), ("INTERSECTION_NOT_FOUND", "the north end of A", None, "C_medium", "intersection_rule:street_end_phrase"), ("INTERSECTION_NOT_FOUND", "A Lane", None, "D_hard", "lane_description"), ("INTERSECTION_NOT_FOUND", "King Street", None, "D_hard", "true_missing:unknown"),
    ("GEOMETRY_EXCEPTION", None, None, "D_hard", "geometry_exception"), ("EMPTY_GEOMETRY", None, None, "A_skipped", "empty_geometry"), ("GEOMETRY_ERROR", None, None, "C_medium", "geometry_zero_length"), ("PARSE_NO_MATCH", None, "A (x) B", "C_medium", "parse_pattern:parenthetical"),
    ("PARSE_NO_MATCH", None, "the lane first north of A", "D_hard", "parse_pattern:lane_first"), ("PARSE_NO_MATCH", None, "A and B", "C_medium", "parse_pattern:simple_and"), ("STREET_NOT_FOUND", None, None, "D_hard", "street_not_found"), ("AMBIGUOUS_INTERSECTION", None, None, "D_hard", "ambiguous_intersection"), ("OTHER", None, None, "D_hard", "geo:other"),
)
_pick = lambda i: V.case(f"o_orderkey % {len(_FAILURES)}", [V.text(f[i]) for f in _FAILURES])
FAILURES = f"SELECT o_orderkey AS row_id, 'geo' AS stage, {_pick(0)} AS reason_code, {_pick(1)} AS cross_street, {_pick(2)} AS between_text, {_pick(3)} AS tier, {_pick(4)} AS fix_category FROM {{orders}}"


def _tiers(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.frame(spark, sf, FAILURES).select("row_id", "stage", "reason_code", F.col("cross_street").alias("cross"), F.col("between_text").alias("between"))
    return T.tiers(rows)


@query(V.oracle("SELECT row_id, tier, fix_category FROM f", f=FAILURES))
def triage_tiers(spark, sf):  # noqa: ANN001, ANN201
    """V01-V03, V17, F21 (expected by template)."""
    return _tiers(spark, sf).select("row_id", "tier", "fix_category")


@query(V.oracle("SELECT stage, count(*) FILTER (WHERE tier = 'A_skipped') AS A_skipped, count(*) FILTER (WHERE tier = 'A_trivial') AS A_trivial, count(*) FILTER (WHERE tier = 'C_medium') AS C_medium, count(*) FILTER (WHERE tier = 'D_hard') AS D_hard FROM f GROUP BY 1", f=FAILURES))
def triage_crosstab(spark, sf):  # noqa: ANN001, ANN201
    """A08, V03."""
    return T.crosstab(_tiers(spark, sf), "stage", "tier", ["A_skipped", "A_trivial", "C_medium", "D_hard"])


@query(V.oracle("SELECT row_id, tier, CAST(row_number() OVER (ORDER BY CASE tier WHEN 'A_skipped' THEN 1 WHEN 'A_trivial' THEN 2 WHEN 'C_medium' THEN 4 ELSE 5 END, stage, reason_code, CAST(row_id AS VARCHAR)) AS INT) AS rank FROM f QUALIFY rank <= 100", f=FAILURES))
def triage_order(spark, sf):  # noqa: ANN001, ANN201
    """The first hundred of the triage order (a top-k report)."""
    head = T.in_order(_tiers(spark, sf)).limit(100).withColumn("_o", F.monotonically_increasing_id())
    from pyspark.sql import Window

    return head.select("row_id", "tier", F.row_number().over(Window.orderBy("_o")).alias("rank"))


_TEXTS = ("Lane", "Lane first north of A", "A laneway", "A running parallel to B", "King Street (north leg)", "Old cul-de-sac", "A (east)", "A service road", "A / B", "A and B", "A one-way", "King Street", "")
_KINDS = ("generic_lane_highway", "lane_position_in_highway", "laneway_phrase", "misleading_highway_phrase", "leg_branch_paren", "descriptor_in_name", "parenthetical_qualifier", "ramp_service_parallel", "compound_or_slash_highway", "compound_or_slash_highway", "parenthetical_qualifier", "plain_name", "empty")
_CROSSES = ("", "the north end of A", "a point 3 metres north", "north leg of A", "A ramp", "adjacent to A", "A (east intersection)", "A and", "St. Clair", "O'Hara Road", "A Parkway", "The Gate", "Pine Lawn", "Rose Gardens", "Gardiner Expressway", "King Street")
_CROSS_KINDS = ("empty", "street_end_phrase", "point_metres_fragment", "leg_phrase", "lane_description", "adjacent_to", "parenthetical_intersection", "trailing_and", "abbrev_with_period", "apostrophe_name", "parkway_spelling", "gate_spelling", "lawn_spelling", "gardens_spelling", "major_roadway", "normal_street_name")
_PLACES = ("", "lane first north of A", "north leg of A", "A (x)", "end of A", "a point opposite A and B", "a point at the intersection and B", "a point on A and B", "A/B", "A and B", "A north", "A")
_PLACE_KINDS = ("empty", "lane_first", "leg", "parenthetical", "street_end", "point_opposite_and", "dual_intersection_paren", "point_and_street", "slash_cross", "simple_and", "directional", "other_plain")


def _taxonomy(texts: tuple, kinds: tuple) -> tuple[str, str]:
    k = f"o_orderkey % {len(texts)}"
    return f"SELECT o_orderkey AS id, {V.case(k, [V.text(t) for t in texts])} AS t FROM {{orders}}", V.oracle(f"SELECT {V.case(k, [V.text(t) for t in kinds])} AS kind, count(*) AS n FROM {{orders}} GROUP BY 1")


_H, _HO = _taxonomy(_TEXTS, _KINDS)
_X, _XO = _taxonomy(_CROSSES, _CROSS_KINDS)
_P, _PO = _taxonomy(_PLACES, _PLACE_KINDS)


@query(_HO)
def categorize_highway(spark, sf):  # noqa: ANN001, ANN201
    """T21."""
    return V.frame(spark, sf, _H).groupBy(N.highway_kind(F.col("t")).alias("kind")).agg(F.count("*").alias("n"))


@query(_XO)
def categorize_cross(spark, sf):  # noqa: ANN001, ANN201
    """T22."""
    return V.frame(spark, sf, _X).groupBy(N.cross_kind(F.col("t")).alias("kind")).agg(F.count("*").alias("n"))


@query(_PO)
def categorize_between(spark, sf):  # noqa: ANN001, ANN201
    """T23."""
    return V.frame(spark, sf, _P).groupBy(N.between_kind(F.col("t")).alias("kind")).agg(F.count("*").alias("n"))


@query(V.oracle("SELECT p_brand, p_type, count(*) AS n FROM {part} GROUP BY 1, 2 ORDER BY n DESC, p_brand NULLS FIRST, p_type NULLS FIRST LIMIT 20"))
def top_pairs(spark, sf):  # noqa: ANN001, ANN201
    """O05."""
    return T.top(spark.read.parquet(f"{sf}/part.parquet"), 20, "p_brand", "p_type")


@query(V.oracle("SELECT c_mktsegment, count(*) AS n FROM {customer} GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10"))
def top_values(spark, sf):  # noqa: ANN001, ANN201
    """O04."""
    return T.top(spark.read.parquet(f"{sf}/customer.parquet"), 10, "c_mktsegment")


@query(V.oracle("SELECT o_orderstatus, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent FROM {orders} GROUP BY 1"))
def pct_of_parsed(spark, sf):  # noqa: ANN001, ANN201
    """A09."""
    return T.shares(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderstatus")


@query(V.oracle("SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS a, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS b FROM {documents}) WHERE (lang IS NOT NULL AND a <= 3) OR (source IS NOT NULL AND b <= 3)"))
def stratified_sample(spark, sf):  # noqa: ANN001, ANN201
    """Three rows for each language and source (a sampling operator)."""
    return T.stratified(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source"), "doc_id", ["lang", "source"], 3).select("doc_id")


@query(V.oracle("SELECT o_orderkey FROM {orders} ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey LIMIT 50"))
def cohort_sample(spark, sf):  # noqa: ANN001, ANN201
    """Fifty rows, wanted ones first (a sampling operator)."""
    return T.cohort(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderkey", F.col("o_orderstatus") == "F", 50).select("o_orderkey")


@query(V.oracle("SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'removed' WHEN a.o_orderkey IS NULL THEN 'added' ELSE 'o_custkey' END AS change FROM (SELECT * FROM {orders} WHERE o_orderkey % 7 <> 0) a FULL JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 ELSE o_custkey END AS c FROM {orders} WHERE o_orderkey % 11 <> 0) b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR b.c <> a.o_custkey"))
def symmetric_diff(spark, sf):  # noqa: ANN001, ANN201
    """What changed between two versions of a table."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    new = o.where("o_orderkey % 11 <> 0").withColumn("o_custkey", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    return T.difference(o.where("o_orderkey % 7 <> 0"), new, "o_orderkey")


@query(V.oracle("SELECT legal, list_aggregate(list_sort(list_distinct(list(\"full\"))), 'string_agg', ' | ') AS names, count(*) AS segments, count(DISTINCT name_id) AS ids FROM (SELECT c_nationkey AS name_id, n_name AS legal, c_mktsegment AS \"full\" FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey) GROUP BY 1"))
def street_name_dim(spark, sf):  # noqa: ANN001, ANN201
    """A01, S17, K14."""
    rows = V.frame(spark, sf, "SELECT c_nationkey AS name_id, n_name AS legal, c_mktsegment AS full, n_name AS base FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey")
    return readers.street_dimension(rows).select("legal", F.col("full").alias("names"), "segments", "ids")


@query(V.oracle("SELECT CASE WHEN c_acctbal IS NULL THEN 'none' WHEN c_acctbal / 10000 < 0.5 THEN 'low' WHEN c_acctbal / 10000 < 0.8 THEN 'medium' ELSE 'high' END AS band, count(*) AS n FROM {customer} GROUP BY 1"))
def confidence_bands(spark, sf):  # noqa: ANN001, ANN201
    """V08."""
    return spark.read.parquet(f"{sf}/customer.parquet").groupBy(T.band(F.col("c_acctbal") / 10000).alias("band")).agg(F.count("*").alias("n"))


@query(V.oracle("SELECT min(x0) AS min_lng, min(y0) AS min_lat, max(x0 + len) AS max_lng, max(y0) AS max_lat, count(*) AS n FROM l", l=LINES))
def overall_extent(spark, sf):  # noqa: ANN001, ANN201
    """The extent of all lines."""
    b = sinks.with_bounds(_lines(spark, sf))
    return b.agg(F.min("min_lng").alias("min_lng"), F.min("min_lat").alias("min_lat"), F.max("max_lng").alias("max_lng"), F.max("max_lat").alias("max_lat"), F.count("*").alias("n"))


@query(V.oracle("SELECT line_id, '{{\"type\":\"Feature\",\"properties\":{{\"line_id\":' || line_id || '}},\"geometry\":{{\"type\":\"LineString\",\"coordinates\":[[' || CAST(CAST(x0 AS BIGINT) AS VARCHAR) || '.0,0.0]]}}}}' AS feature FROM l", l=LINES))
def geojson_features(spark, sf):  # noqa: ANN001, ANN201
    """A feature as GeoJSON text."""
    one = V.frame(spark, sf, LINES).select("line_id", F.array(F.struct(F.col("x0").alias("x"), F.lit(0.0).alias("y"))).alias("line"))
    return one.select("line_id", sinks.feature(["line_id"]).alias("feature"))


@query(V.oracle("SELECT event_id, CAST(dayofweek(ts) AS INT) AS day_of_week, CAST(hour(ts) * 60 + minute(ts) AS INT) AS minute_of_day, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day_of_month FROM {events}"))
def slots_of_events(spark, sf):  # noqa: ANN001, ANN201
    """Slot columns of a time, as the streaming membership uses them."""
    s = slots_of(spark.read.parquet(f"{sf}/events.parquet"))
    return s.select("event_id", F.col("dayOfWeek").alias("day_of_week"), F.col("minuteOfDay").alias("minute_of_day"), "month", F.col("dayOfMonth").alias("day_of_month"))


@query(V.oracle("SELECT c_custkey AS edge, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS class FROM {customer}"))
def edge_attributes(spark, sf):  # noqa: ANN001, ANN201
    """Placeholder texts become null, the last row of an id counts."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    rows = c.select(F.col("c_custkey").alias("edge"), F.when(F.col("c_custkey") % 3 == 0, "None").otherwise(F.col("c_mktsegment")).alias("class"), F.lit("O").alias("parity_left"), F.lit(" ").alias("parity_right"), F.lit(2).alias("ord"))
    return readers.edge_attributes(rows.unionByName(rows.withColumns({"ord": F.lit(1), "class": F.lit("old")}))).select("edge", "class")
