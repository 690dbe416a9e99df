"""Grammars, clocks and geometry on literal cases."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from curblake.functions import between as B
from curblake.functions import clock, geodesy, names, schedule
from curblake.functions import lines as L
from curblake.operators import graph, resolve, spatial, triage
from curblake.operators.membership import is_active, schedule_of
from curblake.sources import readers, sinks
from curblake.streaming.membership import active_rules


def parse(spark, *texts):
    rows = schedule.parse_rows(spark.createDataFrame([(t,) for t in texts], "times string")).collect()
    return {r.times: json.loads(r.schedule_json) for r in rows}


def test_schedule_shapes(spark):
    p = parse(spark, "8:30 pm to 9:00 a.m.", "Sat. and Sun.", "6:00 p.m. Fri. to 7:00 a.m. Mon.", "9:00 a.m. to 5:00 p.m., on the 1st Thu. and 3rd Thu. of each month", "8:00 a.m. to 9:00 a.m.; gibberish")
    assert p["8:30 pm to 9:00 a.m."]["windows"][0]["startMinute"] == 1200  # the minutes of a time without points are lost
    assert p["Sat. and Sun."]["flags"] == {"exceptPublicHolidays": True}  # set though holidays aren't named
    assert [w["days"] for w in p["6:00 p.m. Fri. to 7:00 a.m. Mon."]["windows"]] == [[5], [6, 0], [1]]
    assert p["9:00 a.m. to 5:00 p.m., on the 1st Thu. and 3rd Thu. of each month"]["windows"][0]["days"] == [4]
    assert p["8:00 a.m. to 9:00 a.m.; gibberish"]["status"] == "partial"


def active(spark, document, **slot):
    slot = {"dayOfWeek": 1, "minuteOfDay": 0, "month": 1, "dayOfMonth": 15, "year": 2025, "majorSnowStorm": False} | slot
    row = spark.createDataFrame([(json.dumps(document), *slot.values())], "j string, dayOfWeek int, minuteOfDay int, month int, dayOfMonth int, year int, majorSnowStorm boolean")
    return row.select(is_active(schedule_of(F.col("j")))).first()[0]


def test_membership_semantics(spark):
    day = {"status": "ok", "windows": [{"days": [1], "startMinute": 0, "endMinute": 1439}]}
    assert active(spark, day, minuteOfDay=1438) and not active(spark, day, minuteOfDay=1439)  # ends are exclusive
    night = {"status": "ok", "windows": [{"days": [1], "startMinute": 1320, "endMinute": 360, "crossesMidnight": True}]}
    assert active(spark, night, minuteOfDay=60) and not active(spark, night, minuteOfDay=60, dayOfWeek=2)  # the same listed day
    both = {"status": "anytime", "calendar": {"dayOfMonthRanges": [{"start": 1, "end": "15"}, {"start": 10, "end": "last"}]}}
    assert active(spark, both, dayOfMonth=12) and not active(spark, both, dayOfMonth=5)  # ranges are joined by and
    assert active(spark, {"status": "conditional", "condition": "major_snowstorm_declared"}, majorSnowStorm=True)
    assert not active(spark, {"status": "failed"})
    assert active(spark, {"status": "anytime", "inverted": True, "windows": []})


@pytest.mark.parametrize("date,holiday", [((2025, 12, 25), True), ((2022, 12, 26), True), ((2022, 12, 27), False), ((2025, 4, 18), True), ((2025, 5, 19), True), ((2025, 6, 3), False), ((None, 12, 25), False)])
def test_holidays(spark, date, holiday):
    row = spark.createDataFrame([date], "y int, m int, d int")
    assert row.select(clock.is_public_holiday(F.col("y"), F.col("m"), F.col("d"))).first()[0] is holiday


def test_between_order_and_guards(spark):
    texts = ["Alberta Avenue Oakwood Avenue", "A point 61 metres south and a point 61 metres north of Bay Street", "The north end of Foo Road and a point 30 metres south of the north end of Bar Road", "lane and a point somewhere", "A Street (north intersection) and the south end of B Road"]
    got = {r.between: r for r in B.parse_rows(spark.createDataFrame([(t,) for t in texts], "between string")).collect()}
    assert [got[t].rule_type for t in texts] == ["block", "offset_span", "block_to_terminus", None, "block_to_terminus"]
    assert got[texts[4]].start_intersection_qualifier == "north intersection"
    bad = B.parse_rows(spark.createDataFrame([("Alpha Street and a point metres lane 3 metres north",)], "between string")).first()
    assert bad.reason_code in ("PARSE_INVALID", "PARSE_NO_MATCH")


def test_names_and_pairs_against_brute_force(spark):
    words = ["alpha st", "alpine st", "st albans rd", "ave road", "beta ave", "cave rd"]
    descriptions = [(i, i, f"{a} / {b}") for i, (a, b) in enumerate((a, b) for a in words for b in words)]
    tokens = ["alp", "st ", "ave rd", "beta ave", "road / cave"]
    found = resolve.postings(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame(descriptions, "id int, ord int, description string")).collect()
    assert {(r.token, r.id) for r in found} == {(t, i) for t in tokens for i, _, d in descriptions if t in d}
    near = resolve.near_matches(spark.createDataFrame([("Alphb Street",), ("Alpha Road",)], "key string"), spark.createDataFrame([("alpha street",), ("alph street",), ("alpha road",)], "legal string"))
    assert {tuple(r) for r in near.collect()} == {("Alphb Street", "alpha street"), ("Alphb Street", "alph street"), ("Alpha Road", "alpha road")}
    tidy = spark.createDataFrame([("Mc Gill St. E (south leg)",)], "n string").select(names.leg_compass(F.col("n")), names.root(F.col("n"))).first()
    assert tidy[0] == "south"


def test_paths_are_by_hops_and_independent_of_partitions(spark):
    edges = [(1, 10, 1, 2, 1.0), (1, 11, 2, 3, 1.0), (1, 12, 1, 3, 50.0), (1, 13, 4, 5, 1.0)]
    e = spark.createDataFrame(edges, "street int, edge long, a long, b long, metres double")
    r = spark.createDataFrame([(1, 1, 1, 3), (1, 2, 1, 5)], "street int, request long, start long, finish long")
    for parts in (1, 8):
        got = graph.paths(e.repartition(parts), r.repartition(parts)).collect()
        assert [(x.request, x.hops, x.edges) for x in got] == [(1, 1, [12])]


def test_utm(spark):
    x, y = geodesy.to_metres(F.lit(-79.3832), F.lit(43.6532))
    east, north = spark.range(1).select(x, y).first()
    assert abs(east - 630370) < 40 and abs(north - 4834605) < 60
    lon, lat = geodesy.to_degrees(F.lit(east), F.lit(north))
    back = spark.range(1).select(lon, lat).first()
    assert abs(back[0] + 79.3832) < 1e-9 and abs(back[1] - 43.6532) < 1e-9


def test_polygon(spark):
    ring = F.array(*[L.point(F.lit(x), F.lit(y)) for x, y in ((0, 0), (10, 0), (10, 10), (0, 10))])
    got = spark.range(1).select(spatial.polygon_contains(ring, F.lit(5.0), F.lit(5.0)), spatial.polygon_contains(ring, F.lit(15.0), F.lit(5.0))).first()
    assert tuple(got) == (True, False)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(i, "k", [(float(i), 0.0), (i + 1.0, 2.0)]) for i in (9, 10, 2)], "id int, kind string, line array<struct<x:double,y:double>>")
    path = str(tmp_path / "r.db")
    made = sinks.write_sqlite(rows, path, ["kind"])
    with sqlite3.connect(path) as db:
        assert [r[0] for r in db.execute("SELECT id FROM features ORDER BY rowid")] == ["10", "2", "9"]
        view = db.execute("SELECT f.id FROM features_rtree r JOIN features f ON f.rowid = r.id WHERE min_lng <= 4 AND max_lng >= 1").fetchall()
    assert view == [("2",)] and made["feature_count"] == 3 and made["bbox"] == [2.0, 0.0, 11.0, 2.0]
    assert sinks.collection(rows, ["id"], str(tmp_path / "c.json")) == 3
    back = readers.geojson(spark, str(tmp_path / "c.json"), "id int")
    assert sorted(r.id for r in back.collect()) == [2, 9, 10]
    sinks.write_release(rows, str(tmp_path / "release"), 2)
    assert spark.read.parquet(str(tmp_path / "release")).count() == 3


def test_ledger_replaces_its_stages_only(spark, tmp_path):
    one = spark.createDataFrame([("1", "clean", "A"), ("2", "parse", "B")], "row_id string, stage string, reason_code string")
    triage.write_ledger(triage.ledger(one), str(tmp_path / "l"))
    triage.write_ledger(triage.ledger(one.where("stage = 'clean'").withColumn("row_id", F.lit("3"))), str(tmp_path / "l"))
    assert sorted((r.row_id, r.stage) for r in spark.read.parquet(str(tmp_path / "l")).collect()) == [("2", "parse"), ("3", "clean")]


def test_sources(spark, tmp_path):
    (tmp_path / "o.csv").write_text("row_id,reason,method,notes\n# a comment\n1,r,offset,\n1,r,other,\n2,,m,\n")
    assert [(r.row_id, r.method) for r in readers.overrides(spark, str(tmp_path / "o.csv")).collect()] == [("1", "offset")]
    (tmp_path / "a.csv").write_text("bylaw,token\nKing,k1\nking,k2\n")
    assert [tuple(r) for r in readers.aliases(spark, str(tmp_path / "a.csv")).collect()] == [("king", "k2")]
    (tmp_path / "raw.csv").write_text('_id,scheduleName,ByLaw_Table,Latest_Action\n1,S,"[{\'key\': \'Highway\',\n \'value\': ""O\'Hara""}]",\n')
    raw = readers.check_dump(readers.raw_rules(spark, str(tmp_path / "raw.csv")), 1)
    assert "Highway" in raw.first()["ByLaw_Table"] and raw.first()["Latest_Action"] is None
    with pytest.raises(ValueError):
        readers.check_dump(raw, 2)


def test_streaming_membership(spark, sf, tmp_path):
    events = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/events.parquet".replace("events.parquet", "ev*.parquet"))
    rules = spark.createDataFrame([("view", "no_parking", '{"status":"anytime"}')], "event_type string, category string, j string").select("event_type", "category", schedule_of(F.col("j")).alias("schedule"))
    typed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    q = active_rules(typed, rules, key="event_type").writeStream.outputMode("append").format("memory").queryName("active").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("active").count() > 0


def test_sql_functions(spark):
    from curblake.plans.pipeline import register

    register(spark)
    text = "9:00 a.m. to 5:00 p.m., Sat."
    assert json.loads(spark.sql(f"SELECT parse_schedule_json('{text}', '{text}')").first()[0])["status"] == "ok"
    rows = spark.sql("""SELECT w.* FROM VALUES ('{"windows":[{"days":[6],"startMinute":540,"endMinute":1020}]}') AS t(d), LATERAL explode_windows(t.d) AS w""").collect()
    assert [tuple(r) for r in rows] == [(6, 540, 1020)]


def test_results_do_not_depend_on_partitions(spark):
    from curblake.operators import curbs

    hits = spark.createDataFrame([(k, float(s), float((k * s) % 7) if (k + s) % 4 else None) for k in range(20) for s in range(30)], "line int, s double, hit double")
    for f in (curbs.runs, curbs.fill_gaps, curbs.reject_jumps):
        assert sorted(map(str, f(hits.repartition(1)).collect())) == sorted(map(str, f(hits.repartition(8)).collect()))
    near = spatial.within(spark.createDataFrame([(1, [(0.0, 0.0), (100.0, 0.0)])], "line_id int, line array<struct<x:double,y:double>>"), spark.createDataFrame([(i, float(i), float(i % 30)) for i in range(130)], "point_id int, x double, y double"), 12.0)
    assert {r.point_id for r in near.collect()} == {i for i in range(130) if (max(0, i - 100) ** 2 + (i % 30) ** 2) ** 0.5 <= 12}


def test_hops_reach_the_end_of_a_long_street(spark):
    edges = spark.createDataFrame([(1, i, i + 1) for i in range(104)], "street int, a long, b long")
    found = graph.hops(edges, spark.createDataFrame([(1, 0)], "street int, source long")).select("node", "hops").collect()
    assert sorted(map(tuple, found)) == [(i, i) for i in range(105)]
