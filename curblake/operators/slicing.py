"""From a parse to a piece of its street (L01-L03, L09-L16, L18, L19, C14): along-line distances by rule type, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.functions import lines as L
from curblake.functions.rx import computed, first
from curblake.operators.storage import spread

TOLERANCE = 0.001
BLOCKS = ("block", "parenthetical_block", "parenthetical_end_block", "parenthetical_dual_block")


def crossings(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Adds at_start, at_end, at_offset, at_terminus (places on the row's line) and spread (of the start's nodes).

    found(street, cross, x, y): intersection points by street and cross name; of several the first place counts, and the
    qualifier's extreme if there is one.
    """
    asked = [("start_intersection", "at_start", "start_intersection_qualifier"), ("end_intersection", "at_end", "end_intersection_qualifier"), ("offset_intersection", "at_offset", None), ("terminus_street", "at_terminus", None)]
    out = rows
    for name, to, qualifier in asked:
        hits = rows.select("row_id", "street", "line", F.lower(F.trim(name)).alias("cross"), (F.lower(qualifier) if qualifier else F.lit(None).cast("string")).alias("q")).join(found.select("street", F.lower(F.trim("cross")).alias("cross"), "x", "y"), ["street", "cross"])
        hits = hits.withColumn("_at", L.project(F.col("line"), L.point(F.col("x"), F.col("y"))))
        toward = F.when(F.col("q").rlike("west"), F.col("x")).when(F.col("q").rlike("east"), -F.col("x")).when(F.col("q").rlike("south"), F.col("y")).when(F.col("q").rlike("north"), -F.col("y")).otherwise(F.col("_at"))
        best = hits.groupBy("row_id").agg(F.min_by("_at", toward).alias(to), (F.max("_at") - F.min("_at")).alias(f"{to}_spread"))
        out = out.join(best, "row_id", "left")
    return out


def distances(rows: DataFrame) -> DataFrame:
    """Adds d0, d1 and reason (null if fine) from the rule's fields, the row's line and its crossings.

    Places along the line cost the most, so each is found for the rules only that read it, on rows dealt to all cores.
    """
    rows, line = L.measured(spread(rows, "row_id"))
    kind = F.col("rule_type")
    s, e, o = F.col("at_start"), F.col("at_end"), F.col("at_offset")
    # every rule has at most one offset to each end: its anchor, metres and compass word are chosen first, so each is computed once
    to_top = kind.isin("terminus_to_terminus", "terminus_end_metric", "block_to_terminus", "parenthetical_to_terminus")
    rows = computed(rows, _top=F.when(to_top, L.terminus(line, F.coalesce("terminus_direction", "terminus_start_dir"))), _bottom=F.when(kind == "terminus_to_terminus", L.terminus(line, F.col("terminus_end_dir"))))
    anchor1 = F.when(kind == "terminus_end_metric", F.col("_top")).when(kind == "intersect_to_offset", o).otherwise(s)
    anchor2 = F.when(kind == "dual_anchor", e).otherwise(s)
    two = kind.isin("offset_span", "dual_anchor")
    one = two | kind.isin("terminus_end_metric", "perfect_offset", "intersect_extension", "intersect_thereof_block", "intersect_to_offset", "offset_to_intersect")
    rows = computed(rows, _o1=F.when(one, L.reflected_offset(line, anchor1, F.coalesce("distance", "dist1"), F.coalesce("direction", "dir1"))), _o2=F.when(two, L.reflected_offset(line, anchor2, F.col("dist2"), F.coalesce("dir2", "dir1"))))
    near, far = L.relative_extension(line, s, F.col("dist1"), F.col("dist2"), F.col("dir1"))
    further = kind == "relative_extension"
    rows = computed(rows, _near=F.when(further, near), _far=F.when(further, far))
    pair = lambda a, b: F.struct(a.cast("double").alias("d0"), b.cast("double").alias("d1"))
    span = first(
        (F.col("line").isNull(), F.lit(None)),
        (kind == "entire_length", pair(F.lit(0.0), L.length(line))),
        (kind == "terminus_to_terminus", pair(F.col("_top"), F.col("_bottom"))),
        (kind == "terminus_end_metric", pair(F.col("_top"), F.col("_o1"))),
        (kind.isin("perfect_offset", "intersect_extension", "intersect_thereof_block", "intersect_to_offset"), pair(s, F.col("_o1"))),
        (kind == "offset_to_intersect", pair(F.col("_o1"), e)),
        (kind == "relative_extension", pair(F.col("_near"), F.col("_far"))),
        (kind.isin("offset_span", "dual_anchor"), pair(F.col("_o1"), F.col("_o2"))),
        (kind.isin(*BLOCKS), pair(s, e)),
        (kind.isin("block_to_terminus", "parenthetical_to_terminus"), pair(s, F.col("_top"))),
        default=F.lit(None).cast("struct<d0:double,d1:double>"),
    )
    rows = computed(rows, _d=span)
    return rows.withColumns({"d0": F.col("_d.d0"), "d1": F.col("_d.d1")}).drop("_d", "_segments", "_length", "_top", "_bottom", "_o1", "_o2", "_near", "_far")


def slices(rows: DataFrame) -> DataFrame:
    """Adds piece (a line or null), method and reason_code.

    A collapsed span is rescued by the other crossing, else by the spread of the start's nodes, else by a 5 m zone at the anchor.
    """
    rows, line = L.measured(distances(rows))
    d0, d1 = F.col("d0"), F.col("d1")
    collapsed = F.abs(d0 - d1) < TOLERANCE
    anchored = F.col("rule_type").isin("perfect_offset", "intersect_extension", "intersect_to_offset", "offset_to_intersect", "intersect_thereof_block")
    by_end = collapsed & anchored & F.col("at_end").isNotNull() & (F.abs(F.col("at_end") - F.col("at_start")) >= TOLERANCE)
    by_spread = collapsed & (F.coalesce(F.col("at_start_spread"), F.lit(0.0)) >= TOLERANCE)
    lo, hi = L.point_zone(line, d0)
    known = F.col("rule_type").isNotNull()
    reason = first(
        (~known, F.lit("MISSING_RULE_TYPE")), (F.col("line").isNull(), F.lit("STREET_NOT_FOUND")), (d0.isNull() | d1.isNull(), F.lit("INTERSECTION_NOT_FOUND")),
        (collapsed & ~by_end & ~by_spread & ~anchored, F.lit("ZERO_SPAN")), default=F.lit(None).cast("string"),
    )
    rows = computed(rows, reason_code=reason, _m=first((by_end, F.lit("cross_span")), (by_spread, F.lit("node_span")), (collapsed & anchored, F.lit("point_zone")), default=F.lit("distance_merge")))
    a = first((F.col("_m") == "cross_span", F.col("at_start")), (F.col("_m") == "node_span", F.col("at_start")), (F.col("_m") == "point_zone", lo), default=d0)
    b = first((F.col("_m") == "cross_span", F.col("at_end")), (F.col("_m") == "node_span", F.col("at_start") + F.col("at_start_spread")), (F.col("_m") == "point_zone", hi), default=d1)
    piece = F.when(F.col("reason_code").isNull(), L.substring(line, a, b))
    return computed(rows, piece=piece, method=F.when(F.col("reason_code").isNull(), F.col("_m"))).drop("_m", "_segments", "_length")


def merged_lines(edges: DataFrame) -> DataFrame:
    """edges(street, edge, ord, line) whose ends meet in order -> (street, line, dropped): the longest
    run of consecutive edges of each street, and whether other runs were dropped."""
    from pyspark.sql import Window

    order = Window.partitionBy("street").orderBy("ord")
    new = F.coalesce(F.element_at(F.lag("line").over(order), -1) != F.get("line", F.lit(0)), F.lit(True))
    parts = edges.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = parts.groupBy("street", "_run").agg(F.array_sort(F.collect_list(F.struct("ord", "line"))).alias("_l")).withColumn("line", L.joined(F.transform("_l", lambda x: x["line"])))
    long = computed(runs, _m=L.length(F.col("line")))
    return long.groupBy("street").agg(F.max_by("line", F.struct("_m", -F.col("_run"))).alias("line"), (F.count("*") > 1).alias("dropped"))


def recovered_edges(pieces: DataFrame, edges: DataFrame, width: float = 1.0, least: float = 0.25) -> DataFrame:
    """Edges of the piece's street that lie in its corridor for at least ``least`` metres (by their sampled points)."""
    both = pieces.join(edges.select("street", "edge", F.col("line").alias("edge_line")), "street")
    both, edge = L.measured(both, "edge_line")
    both = computed(both, _points=F.transform(L.chainage(edge, least), lambda s: L.interpolate(edge, s)), _edge=L.length(edge)).drop("_segments", "_length")
    both, piece = L.measured(both, "piece")
    inside = F.size(F.filter("_points", lambda p: L.nearest(piece, p)["d"] <= width))
    share = inside / F.size("_points") * F.col("_edge")
    return both.where(share >= least).groupBy("row_id").agg(F.array_sort(F.collect_set("edge")).alias("edges"))


def usable(piece: Column) -> Column:
    """At least two points, all finite, and not of no length."""
    fine = F.forall(piece, lambda p: ~F.isnan(p["x"]) & ~F.isnan(p["y"]) & (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")))
    return (F.size(piece) >= 2) & F.coalesce(fine, F.lit(False)) & (L.length(piece) >= TOLERANCE)


def collapse_cause(rows: DataFrame, length: str = "metres", far: float = 25.0) -> DataFrame:
    """Adds cause and attribution to collapsed spans.

    Reads raw0, raw1 (places before clamping), d0, d1, and for blocks the distances of both crossings from the line
    (start_apart, end_apart) and how many matched (start_matches, end_matches).
    """
    r0, r1, d0, d1, end = F.col("raw0"), F.col("raw1"), F.col("d0"), F.col("d1"), F.col(length)
    at_start, at_end = (d0 < TOLERANCE) & (d1 < TOLERANCE), (F.abs(d0 - end) < TOLERANCE) & (F.abs(d1 - end) < TOLERANCE)
    both = (r0 != d0) & (r1 != d1)
    clamped = first((both & at_start, F.lit("relative_extension_clamp_start")), (both & at_end, F.lit("relative_extension_clamp_end")), (at_start, F.lit("perfect_offset_clamp_start")), (at_end, F.lit("perfect_offset_clamp_end")), default=F.lit("relative_extension_clamp_end"))
    high0, high1 = F.coalesce(F.col("start_apart") > far, F.lit(False)), F.coalesce(F.col("end_apart") > far, F.lit(False))
    parts = F.array_compact(F.array(
        F.when(F.col("start_matches") > 1, "ambiguous_start_match"), F.when(F.col("end_matches") > 1, "ambiguous_end_match"),
        F.when(high0 & high1, "high_perp_both").when(high0, "high_perp_start").when(high1, "high_perp_end"), F.when(end < 50, "short_centreline"),
    ))
    block = F.col("rule_type").isin(*BLOCKS)
    cause = first((end.isNull(), F.lit("no_street_line")), (F.abs(d0 - d1) >= TOLERANCE, F.lit(None).cast("string")), (block, F.lit("block_projection_collapse")), ((r0 != d0) | (r1 != d1), clamped), default=F.lit("anchor_equals_terminus"))
    rows = computed(rows, cause=cause, subcause=F.when(block, F.when(F.size(parts) > 0, F.array_join(parts, "|")).otherwise("projection_same_dist")))
    said = first((F.col("cause").isNull(), F.lit(None).cast("string")), (F.col("cause") == "anchor_equals_terminus", F.lit("valid_point_zone")), (F.col("cause").contains("clamp"), F.lit("clamp_at_endpoint")), (F.col("cause") == "block_projection_collapse", F.lit("centreline_geometry")), default=F.lit("investigate"))
    return rows.withColumn("attribution", said)
