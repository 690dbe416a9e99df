"""Queries of lanes, slices, merged lines, diagnoses and whole stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from curblake.functions import lines as L
from curblake.functions import names as N
from curblake.functions.between import COMPASS, primary_compass, qualifier
from curblake.operators import lanes, placement, resolve, slicing
from curblake.plans import pipeline
from curblake.plans import views as V
from curblake.operators import graph as G
from curblake.plans.space_queries import _CHAIN, _IX, _PAIRS, _PATHS, _REQUESTS, ALIASES, EDGES, LEGAL, LINES, _index, _lines
from curblake.plans.text_queries import _ACTIVE, _CODE

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_W = "lower(translate(n_name, '0123456789_', 'abcdefghijx'))"
LANES = f"SELECT 'ln ' || k || ' n ' || {_W} || ' e dufferin' AS legal FROM {{nation}} CROSS JOIN (SELECT CAST(o_orderkey AS STRING) AS k FROM {{orders}} WHERE o_orderkey BETWEEN 1 AND 2)"
LANE_ROWS = f"SELECT n_nationkey AS id, CASE n_nationkey % 3 WHEN 0 THEN 'Lane first north of ' || {_W} || ' Street' ELSE 'Lane' END AS highway, CASE n_nationkey % 3 WHEN 1 THEN 'lane second north of ' || {_W} || ' Street and a point 3 metres' ELSE 'somewhere' END AS place FROM {{nation}}"


@query(V.oracle(f"SELECT n_nationkey AS row, 'ln ' || CASE n_nationkey % 3 WHEN 0 THEN '1' ELSE '2' END || ' n ' || {_W} || ' e dufferin' AS legal FROM {{nation}} WHERE n_nationkey % 3 < 2"))
def lane_resolution(spark, sf):  # noqa: ANN001, ANN201
    """T19, R10-R12, R24-R26, U03."""
    rows = V.frame(spark, sf, LANE_ROWS).select(F.col("id").alias("row"), "highway", F.col("place").alias("between"))
    return lanes.resolve_lanes(rows, V.frame(spark, sf, LANES), rows.select("row", F.lit("dufferin street").alias("cross_key")))


_RULE = V.case("line_id % 6", [V.text(t) for t in ("entire_length", "perfect_offset", "offset_to_intersect", "block", "dual_anchor", "relative_extension")])
_SPANS = f"""
SELECT line_id, {_RULE} AS rule_type, CASE line_id % 6 WHEN 0 THEN 0.0 WHEN 1 THEN a WHEN 2 THEN up WHEN 3 THEN a WHEN 4 THEN up ELSE CASE WHEN abs(least(len, a + off) - least(len, a + off + 5)) < 0.001 THEN least(len, greatest(0, least(len, a + off + 5) - 5)) ELSE least(len, a + off) END END AS d0,
  CASE line_id % 6 WHEN 0 THEN len WHEN 1 THEN up WHEN 2 THEN len / 2 WHEN 3 THEN len / 2 WHEN 4 THEN CASE WHEN len / 2 - 5 < 0 THEN greatest(0, len / 2 + 5) ELSE len / 2 - 5 END ELSE least(len, a + off + 5) END AS d1
FROM (SELECT *, CASE WHEN a + off > len THEN greatest(0, a - off) ELSE a + off END AS up FROM (SELECT *, least(spot, len) AS a FROM l))"""


def _parsed(spark, sf):  # noqa: ANN001, ANN202
    rows = _lines(spark, sf)
    none = F.lit(None).cast("string")
    kind = F.element_at(F.array(*map(F.lit, ("entire_length", "perfect_offset", "offset_to_intersect", "block", "dual_anchor", "relative_extension"))), (F.col("line_id") % 6 + 1).cast("int"))
    return rows.select(F.col("line_id").alias("row_id"), F.col("line_id").alias("street"), "line", kind.alias("rule_type"), "len", F.least("spot", "len").alias("at_start"), (F.col("len") / 2).alias("at_end"), F.lit(None).cast("double").alias("at_offset"), F.lit(0.0).alias("at_start_spread"), F.col("off").alias("distance"), F.lit("east").alias("direction"), F.col("off").alias("dist1"), F.lit(5.0).alias("dist2"), F.lit("east").alias("dir1"), F.when(F.col("line_id") % 6 == 4, "west").alias("dir2"), *[none.alias(c) for c in ("terminus_direction", "terminus_start_dir", "terminus_end_dir")])


@query(V.oracle("SELECT line_id, rule_type, round(d0, 6) AS d0, round(d1, 6) AS d1 FROM s", l=LINES, s=_SPANS))
def slice_by_rule(spark, sf):  # noqa: ANN001, ANN201
    """Along-line distances by rule type."""
    rows = slicing.distances(_parsed(spark, sf))
    return rows.select(F.col("row_id").alias("line_id"), "rule_type", F.round("d0", 6).alias("d0"), F.round("d1", 6).alias("d1"))


@query(V.oracle("SELECT rule_type, count(*) AS n, count(*) FILTER (WHERE abs(d0 - d1) < 0.001 AND rule_type IN ('block', 'entire_length', 'dual_anchor')) AS zero_span FROM s GROUP BY 1", l=LINES, s=_SPANS))
def slice_outcomes(spark, sf):  # noqa: ANN001, ANN201
    """Pieces and reasons by rule type."""
    rows = slicing.slices(_parsed(spark, sf))
    return rows.groupBy("rule_type").agg(F.count("*").alias("n"), F.count_if(F.col("reason_code") == "ZERO_SPAN").alias("zero_span"))


@query(V.oracle("SELECT c_nationkey AS street, CAST(3 + c_nationkey % 4 AS DOUBLE) * 10 AS metres, c_nationkey % 4 <> 3 AS dropped FROM (SELECT DISTINCT n_nationkey AS c_nationkey FROM {nation})"))
def merged_street_lines(spark, sf):  # noqa: ANN001, ANN201
    """The longest run of consecutive edges; six edges of 10 m with a gap after some."""
    n = V.frame(spark, sf, "SELECT n_nationkey AS street FROM {nation}").withColumn("ord", F.explode(F.sequence(F.lit(0), F.lit(5))))
    gap = F.when(F.col("ord") >= 3 + F.col("street") % 4, 5.0).otherwise(0.0)
    x = F.col("ord") * 10.0 + gap
    edges = n.select("street", F.col("ord").alias("edge"), "ord", F.array(L.point(x, F.lit(0)), L.point(x + 10.0, F.lit(0))).alias("line"))
    return slicing.merged_lines(edges).select("street", L.length(F.col("line")).alias("metres"), "dropped")


@query(V.oracle(f"SELECT stage, reason_code, count(*) AS n FROM (SELECT 'clean' AS stage, {_CODE} AS reason_code FROM rules WHERE {_ACTIVE} AND {_CODE} IS NOT NULL) GROUP BY 1, 2", rules=V.RULES))
def stage_ledger_clean(spark, sf):  # noqa: ANN001, ANN201
    """The clean slice of the whole run's ledger."""
    ledger = pipeline.stages(V.frame(spark, sf, V.RAW), _index(spark, sf))[1]
    return ledger.where("stage = 'clean'").groupBy("stage", "reason_code").agg(F.count("*").alias("n"))


@query()
def stage_run(spark, sf):  # noqa: ANN001, ANN201
    """All stages over the raw rules, by category, status, rule type and tier (rows only)."""
    rows = pipeline.stages(V.frame(spark, sf, V.RAW), _index(spark, sf))[0]
    return rows.groupBy("schedule_category", "schedule_status", "rule_type", "tier").agg(F.count("*").alias("n"))


_IX2 = "SELECT pair, t2 || ' st' AS street_name, contains(d, t2) AS street_known FROM (SELECT pair, t2, (SELECT string_agg(description, '|') FROM ix) AS d FROM p)"


@query(V.oracle("SELECT street_known, count(*) AS n FROM k GROUP BY 1", p=_PAIRS, ix=_IX, k=_IX2))
def token_presence(spark, sf):  # noqa: ANN001, ANN201
    """Whether a name's token stands in any description (semi-join on postings)."""
    pairs = V.frame(spark, sf, _PAIRS).select("pair", F.col("t2").alias("token"))
    known = resolve.postings(pairs.select("token").distinct(), V.frame(spark, sf, _IX)).select("token").distinct().withColumn("_k", F.lit(True))
    return pairs.join(known, "token", "left").groupBy(F.coalesce("_k", F.lit(False)).alias("street_known")).agg(F.count("*").alias("n"))


@query(V.oracle("SELECT count(*) FILTER (WHERE new_hit AND NOT old_hit) AS gain, count(*) FILTER (WHERE old_hit AND NOT new_hit) AS lost, count(*) FILTER (WHERE new_hit AND NOT old_hit) > 0 AND count(*) FILTER (WHERE old_hit AND NOT new_hit) = 0 AS pass FROM (SELECT t2, bool_or(contains(description, t2 || ' crt')) AS old_hit, bool_or(contains(description, t2)) AS new_hit FROM (SELECT DISTINCT t2 FROM p) JOIN ix ON TRUE GROUP BY 1)", p=_PAIRS, ix=_IX))
def normalizer_evaluation(spark, sf):  # noqa: ANN001, ANN201
    """A new normaliser passes if it finds more and loses nothing."""
    names = V.frame(spark, sf, _PAIRS).select("t2").distinct()
    both = names.select("t2", F.concat("t2", F.lit(" crt")).alias("old"), F.col("t2").alias("new"))
    found = resolve.postings(both.select(F.explode(F.array("old", "new")).alias("token")), V.frame(spark, sf, _IX)).select("token").distinct()
    hit = lambda k: both.join(found, both[k] == found["token"], "left_semi").select("t2", F.lit(True).alias(f"{k}_hit"))
    joined = both.join(hit("old"), "t2", "left").join(hit("new"), "t2", "left").select(F.coalesce("old_hit", F.lit(False)).alias("o"), F.coalesce("new_hit", F.lit(False)).alias("w"))
    gain, lost = F.count_if(F.col("w") & ~F.col("o")), F.count_if(F.col("o") & ~F.col("w"))
    return joined.agg(gain.alias("gain"), lost.alias("lost"), ((gain > 0) & (lost == 0)).alias("pass"))


@query(V.oracle("SELECT n_nationkey AS id, ['north', 'south', 'east', 'west'][1 + n_nationkey % 4] AS way, n_name AS name, 'west intersection' AS qualifier FROM {nation}"))
def compass_and_qualifier(spark, sf):  # noqa: ANN001, ANN201
    """T03, T05."""
    n = spark.read.parquet(f"{sf}/nation.parquet")
    word = F.concat(F.element_at(F.array(*map(F.lit, COMPASS.split("|")[:4])), (F.col("n_nationkey") % 4 + 1).cast("int")), F.lit("erly and east"))
    name, found = qualifier(F.concat("n_name", F.lit(" (west intersection)")))
    return n.select(F.col("n_nationkey").alias("id"), primary_compass(word).alias("way"), name.alias("name"), found.alias("qualifier"))


@query(V.oracle(f"SELECT n_nationkey AS id, {_W} || ' street' AS suggested FROM {{nation}}"))
def alias_suggestions(spark, sf):  # noqa: ANN001, ANN201
    """Near matches that no alias covers yet."""
    names = V.frame(spark, sf, f"SELECT n_nationkey AS id, 'qq' || {_W} || ' street' AS key, {_W} || ' street' AS legal FROM {{nation}}")
    one = names.withColumn("key", F.regexp_replace("key", "^qqnation", "qnation"))
    near = resolve.near_matches(one.select("key"), names.select("legal"))
    new = near.join(V.frame(spark, sf, ALIASES).select(F.col("name").alias("key")), "key", "left_anti")
    return one.join(new.select("key", F.col("legal").alias("suggested")), "key").select("id", "suggested")


@query(V.oracle("SELECT n_nationkey AS id, 'start_street' || n_name AS cross_street FROM {nation}").replace("'start_street' || ", ""))
def ledger_detail_cross(spark, sf):  # noqa: ANN001, ANN201
    """T24."""
    n = spark.read.parquet(f"{sf}/nation.parquet")
    return n.select(F.col("n_nationkey").alias("id"), N.cross_of_detail(F.concat(F.lit("start_intersection='"), "n_name", F.lit("'"))).alias("cross_street"))


_ROW = "street * 1000 + request % 97"


@query(V.oracle(f"SELECT row, legal FROM (SELECT {_ROW} AS row, min(request) AS legal, count(*) AS n FROM ({_PATHS}) GROUP BY 1) WHERE n = 1", n=_CHAIN))
def lane_by_graph(spark, sf):  # noqa: ANN001, ANN201
    """Of a row's candidates (requests) exactly one has a single best path on its street's graph."""
    requests = V.frame(spark, sf, _REQUESTS)
    found = G.status(requests, G.pick(G.paths(V.frame(spark, sf, EDGES), requests)))
    statuses = found.select(F.expr(_ROW).alias("row"), F.col("request").alias("legal"), "status")
    return lanes.choose_by_graph(statuses.select("row", "legal"), statuses)


_COLLAPSE = "SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'block' ELSE 'perfect_offset' END AS rule_type, CAST(40 + c_custkey % 30 AS DOUBLE) AS metres, CAST(CASE c_custkey % 4 WHEN 0 THEN -5 WHEN 1 THEN 40 + c_custkey % 30 WHEN 2 THEN 7 ELSE 9 END AS DOUBLE) AS raw0, CAST(CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 200 WHEN 2 THEN 7 ELSE 12 END AS DOUBLE) AS raw1, CAST(c_custkey % 60 AS DOUBLE) AS start_apart, CAST(c_custkey % 37 AS DOUBLE) AS end_apart, c_custkey % 3 AS start_matches, c_custkey % 2 AS end_matches FROM {customer}"
_CAUSE = "CASE WHEN abs(d0 - d1) >= 0.001 THEN NULL WHEN rule_type = 'block' THEN 'block_projection_collapse' WHEN raw0 <> d0 OR raw1 <> d1 THEN CASE WHEN d0 < 0.001 AND d1 < 0.001 THEN 'perfect_offset_clamp_start' ELSE 'perfect_offset_clamp_end' END ELSE 'anchor_equals_terminus' END"


@query(V.oracle(f"SELECT id, {_CAUSE} AS cause, CASE WHEN abs(d0 - d1) >= 0.001 THEN NULL WHEN rule_type = 'block' THEN 'centreline_geometry' WHEN raw0 <> d0 OR raw1 <> d1 THEN 'clamp_at_endpoint' ELSE 'valid_point_zone' END AS attribution FROM (SELECT *, least(greatest(raw0, 0), metres) AS d0, least(greatest(raw1, 0), metres) AS d1 FROM c)", c=_COLLAPSE))
def collapse_diagnosis(spark, sf):  # noqa: ANN001, ANN201
    """V04."""
    rows = V.frame(spark, sf, _COLLAPSE)
    clamp = lambda c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.col("metres"))
    return slicing.collapse_cause(rows.withColumns({"d0": clamp("raw0"), "d1": clamp("raw1")})).select("id", "cause", "attribution")


_PLACED = """
SELECT line_id, CASE line_id % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'right' WHEN 2 THEN 'both' END AS side, CASE line_id % 4 WHEN 3 THEN 'unresolved' ELSE 'road_edge' END AS method, CASE line_id % 4 WHEN 3 THEN 0.0 ELSE 1.0 END AS confidence,
  CASE line_id % 4 WHEN 1 THEN -(6.0 + line_id % 3) WHEN 3 THEN 0.0 ELSE 7.0 + line_id % 5 END AS first_y, CASE line_id % 4 WHEN 2 THEN 2 ELSE 1 END AS lines FROM l"""


@query(V.oracle("SELECT * FROM s", l=LINES, s=_PLACED))
def curb_place(spark, sf):  # noqa: ANN001, ANN201
    """Straight pieces between two walls, by the wanted side."""
    far = F.col("line_id") * 1000.0
    l = _lines(spark, sf).withColumn("piece", F.array(L.point(far, F.lit(0)), L.point(far + F.col("len"), F.lit(0))))  # noqa: E741
    wall = lambda n, y: F.struct((F.col("line_id") * 2 + n).alias("wall_id"), L.point(far - 5, y).alias("p"), L.point(far + F.col("len") + 5, y).alias("q"))
    walls = l.select(F.explode(F.array(wall(0, 7.0 + F.col("line_id") % 5), wall(1, -(6.0 + F.col("line_id") % 3)))).alias("w")).select("w.*")
    k = F.col("line_id") % 4
    rows = l.select(F.col("line_id").alias("row_id"), "piece", F.when(k == 2, "multi").when(k == 3, "unresolved").otherwise("single").alias("mode"), F.when(k == 0, F.array(F.lit("north"))).when(k == 1, F.array(F.lit("south"))).alias("directions"))
    got = placement.place(rows, walls)
    return got.select(F.col("row_id").alias("line_id"), F.col("side_found").alias("side"), "method", F.round("confidence", 6).alias("confidence"), F.round(F.col("curb")[0][0]["y"], 6).alias("first_y"), F.size("curb").alias("lines"))


__all__ = ["LEGAL", "ORACLE_SQL", "QUERIES"]
