"""Sources: by-law CSV, GeoJSON layers, GeoPackage, dimensions with comments."""

from __future__ import annotations

import sqlite3
import struct

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
RAW = T.StructType([T.StructField("_id", T.LongType()), T.StructField("scheduleName", _S), T.StructField("ByLaw_Table", _S), T.StructField("Latest_Action", _S)])
LINE = "array<struct<x:double,y:double>>"


def raw_rules(spark: SparkSession, path: str) -> DataFrame:
    """Explicit schema, quoted cells over several lines; columns are pruned and filters pushed by the planner."""
    return spark.read.schema(RAW).csv(path, header=True, multiLine=True, escape='"', quote='"', enforceSchema=False)


def check_dump(rows: DataFrame, expected: int | None = None) -> DataFrame:
    """The rows, or an error if there are none, a column is missing, or the number differs from the catalogue's."""
    missing = [f.name for f in RAW if f.name not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    n = rows.count()
    if not n or expected is not None and n != expected:
        raise ValueError(f"{n} rows; expected {expected or 'some'}")
    return rows


def largest_resource(resources: DataFrame) -> DataFrame:
    """Of the active resources the one with the most records (ties by id)."""
    return resources.where("datastore_active").orderBy(F.desc("record_count"), "id").limit(1)


def is_stale(local: dict, live: dict, keys: tuple[str, ...]) -> bool:
    """Whether any of the fingerprint keys differs; two absent values are equal."""
    return any(local.get(k) != live.get(k) for k in keys)


def accepted(counts: DataFrame, live: DataFrame, previous: DataFrame, floors: dict[str, int]) -> DataFrame:
    """(kind, n, fine): at least the floor, 99 % of the live count and 95 % of the previous one."""
    floor = F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in floors.items()], F.lit(0))
    both = counts.join(live.select("kind", F.col("n").alias("_l")), "kind", "left").join(previous.select("kind", F.col("n").alias("_p")), "kind", "left")
    fine = (F.col("n") >= floor) & (F.col("n") >= F.coalesce("_l", F.lit(0)) * 0.99) & (F.col("n") >= F.coalesce("_p", F.lit(0)) * 0.95)
    return both.select("kind", "n", fine.alias("fine"))


def geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row a feature: its properties (a DDL string names them), ordinal and lines (of one or several parts)."""
    schema = f"features array<struct<properties:struct<{properties}>,geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.posexplode("features").alias("ord", "f"))
    c, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    one = F.from_json(c, "array<array<double>>")
    many = F.from_json(c, "array<array<array<double>>>")
    at = F.from_json(c, "array<double>")
    parts = F.when(kind.isin("MultiLineString", "Polygon"), many).when(kind == "LineString", F.array(one)).when(kind == "Point", F.array(F.array(at)))
    points = F.transform(parts, lambda p: F.transform(p, lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y"))))
    return rows.select("ord", "f.properties.*", points.alias("parts"))


def geometry_column(rows: DataFrame, column: str = "geometry") -> DataFrame:
    """A CSV column of GeoJSON text as rings of points; text that isn't GeoJSON gives null."""
    parsed = F.from_json(column, "type string, coordinates array<array<array<double>>>")
    return rows.withColumn("rings", F.transform(parsed["coordinates"], lambda r: F.transform(r, lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y")))))


def _rings(blob: bytes) -> list:
    """The rings of a GeoPackage polygon: its header, then WKB."""
    envelope = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    data, out = blob[8 + envelope :], []

    def polygon(at: int) -> int:
        n, at = struct.unpack_from("<I", data, at)[0], at + 4
        for _ in range(n):
            m, at = struct.unpack_from("<I", data, at)[0], at + 4
            v = struct.unpack_from(f"<{2 * m}d", data, at)
            out.append([{"x": v[i], "y": v[i + 1]} for i in range(0, 2 * m, 2)])
            at += 16 * m
        return at

    kind = struct.unpack_from("<I", data, 1)[0]
    if kind == 3:
        polygon(5)
    elif kind == 6:
        at = 9
        for _ in range(struct.unpack_from("<I", data, 5)[0]):
            at = polygon(at + 5)
    return out


def geopackage(spark: SparkSession, path: str, layer: str, kinds: tuple[str, ...] = ("Road Edge", "Intersection")) -> DataFrame:
    """(id, kind, rings): ring 0 is the boundary, the others are holes.  The file is one SQLite database, read on the driver."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        geom = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()[0]
        rows = [(r[0], r[1], _rings(r[2])) for r in db.execute(f'SELECT OBJECTID, SUBTYPE_DESC, "{geom}" FROM "{layer}"') if r[2] and r[1] in kinds]
    return spark.createDataFrame(rows, f"id long, kind string, rings array<{LINE}>")


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """(row_id, reason, method, notes) without comment lines and incomplete rows; of equal ids the first counts."""
    rows = spark.read.csv(path, header=True, comment="#").withColumn("_n", F.monotonically_increasing_id())
    full = rows.where((F.trim("row_id") != "") & (F.trim("reason") != "") & (F.trim("method") != ""))
    return full.withColumn("_r", F.row_number().over(Window.partitionBy("row_id").orderBy("_n"))).where("_r = 1").select("row_id", "reason", "method", "notes")


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """(name, token) lower-cased; of equal names the last counts."""
    rows = spark.read.csv(path, header=True).withColumn("_n", F.monotonically_increasing_id())
    name, token = [F.lower(F.trim(c)) for c in rows.columns[:2]]
    full = rows.select(name.alias("name"), token.alias("token"), "_n").where("name <> '' AND token <> ''")
    return full.groupBy("name").agg(F.max_by("token", "_n").alias("token"))


def edge_attributes(edges: DataFrame) -> DataFrame:
    """(edge, class, parity_left, parity_right): placeholder texts are null, the last row of an id counts."""
    tidy = lambda c: F.when(~F.upper(F.trim(c)).isin("", "NONE", "NULL", "NAN", "N"), F.trim(c))
    order = Window.partitionBy("edge").orderBy(F.desc("ord"))
    return edges.withColumn("_r", F.row_number().over(order)).where("_r = 1").select("edge", *[tidy(c).alias(c) for c in ("class", "parity_left", "parity_right")])


def street_dimension(segments: DataFrame) -> DataFrame:
    """A row a legal name (null is one): distinct values of the other names joined by ' | ', segments, distinct ids."""
    many = [F.array_join(F.array_sort(F.collect_set(c)), " | ").alias(c) for c in ("full", "base")]
    return segments.groupBy("legal").agg(*many, F.count("*").alias("segments"), F.countDistinct("name_id").alias("ids"))
