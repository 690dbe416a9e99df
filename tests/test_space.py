"""Joins of places and curbs at size: what is written out, dealt and broadcast."""

import re

import pytest

from curblake.operators import spatial
from curblake.plans.registry import QUERIES

LINE = "line_id long, line array<struct<x:double,y:double>>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["spatial_within_12m", "spatial_box_intersect", "first_polygon_tag", "ray_hits", "curb_place"])
def test_cells_are_not_broadcast(name, spark, sf):
    assert not re.search(r"BroadcastHashJoin \[(cast\()?cell", plan(QUERIES[name](spark, sf)))  # of files Spark thinks them small


def test_copies_meet_once_and_are_written_out(spark):
    lines = spark.createDataFrame([(i, [(0.0, 0.0), (30.5, 0.0), (61.0, 0.0)]) for i in range(40)], LINE)
    points = spark.createDataFrame([(i, 13.0 * (i % 3), 5.0) for i in range(3000)], "point_id long, x double, y double")
    near = spatial.within(lines, points, 12.0)
    assert near.count() == near.distinct().count() == 40 * 3000  # copies beyond one pack of ids
    assert {(r.point_id % 3, r.distance, r.at) for r in near.collect()} == {(0, 5.0, 0.0), (1, 5.0, 13.0), (2, 5.0, 26.0)}


def test_hydrants_of_one_place_count_once(spark):
    lines = spark.createDataFrame([(i, [(0.0, 0.0), (30.5, 0.0), (61.0, 0.0)]) for i in range(5)], LINE)
    hydrants = spark.createDataFrame([(23.0, 3.0)] * 15 + [(6.0, -2.0)] * 15 + [(29.0, 1.0)], "x double, y double")
    free = spatial.hydrant_exclusions(lines, hydrants, 12.0)
    assert sorted((r.line_id, r.covered, r.stretches) for r in free.collect()) == [(i, 18.0, 2) for i in range(5)]  # 3 to 9, and 20 to 32


def test_equal_boxes_are_written_out(spark):
    boxes = spark.createDataFrame([(i, *((0.0, 0.0, 60.0, 60.0), (55.0, 55.0, 70.0, 70.0), (90.0, 0.0, 95.0, 5.0))[i % 3]) for i in range(3300)], "id long, x0 double, y0 double, x1 double, y1 double")
    pairs = spatial.box_pairs(boxes, boxes).where("left_id < right_id")
    assert "packl" in plan(pairs)  # of equal boxes one is compared
    assert pairs.count() == pairs.distinct().count() == 2200 * 2199 // 2 + 1100 * 1099 // 2


@pytest.mark.parametrize("name", ["slice_by_rule", "slice_outcomes"])
def test_lines_are_dealt_before_places_are_found(name, spark, sf):
    """A small file is one task's scan, which would find all places."""
    assert "REPARTITION_BY_NUM" in plan(QUERIES[name](spark, sf))


def test_paths_take_shares_of_a_street(spark, sf):
    """One function a street would hold all of it, however many parts it has."""
    text = plan(QUERIES["graph_path_edges"](spark, sf))
    assert "_share_a" in text and "_share_start" in text
