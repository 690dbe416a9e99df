"""Sinks: GeoJSON, the SQLite release with its R-tree and manifest, QA rows."""

from __future__ import annotations

import hashlib
import json
import os
import sqlite3
import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature(properties: list[str], line: str = "line") -> Column:
    """One GeoJSON feature as text."""
    coordinates = F.transform(line, lambda p: F.array(p["x"], p["y"]))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit("LineString").alias("type"), coordinates.alias("coordinates")).alias("geometry")))


def write_geojson_lines(rows: DataFrame, properties: list[str], path: str, line: str = "line") -> None:
    """A feature a line, in parallel; `collection` wraps them for readers that want one document."""
    rows.select(feature(properties, line).alias("value")).write.mode("overwrite").text(path)


def collection(rows: DataFrame, properties: list[str], path: str, line: str = "line") -> int:
    """One FeatureCollection, streamed through the driver a partition at a time."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"type":"FeatureCollection","features":[')
        for r in rows.select(feature(properties, line).alias("v")).toLocalIterator():
            f.write(("," if n else "") + r["v"])
            n += 1
        f.write("]}")
    return n


def with_bounds(rows: DataFrame, line: str = "line") -> DataFrame:
    """Box columns, so that a view prunes row groups by their bounds."""
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return rows.withColumns({"min_lng": F.array_min(xs), "min_lat": F.array_min(ys), "max_lng": F.array_max(xs), "max_lat": F.array_max(ys)})


def write_release(rows: DataFrame, path: str, parts: int = 16) -> None:
    """K05 as a table: Parquet range-clustered by box, the form to query at any size."""
    with_bounds(rows).repartitionByRange(parts, "min_lng", "min_lat").sortWithinPartitions("min_lng", "min_lat").write.mode("overwrite").parquet(path)


def write_sqlite(rows: DataFrame, path: str, properties: list[str], line: str = "line") -> dict:
    """One SQLite file sorted by text id, with WKB lines, an R-tree and indexes; returns its manifest.

    Rows stream through the driver a partition at a time, as the file is written by one process.
    """
    ordered = with_bounds(rows, line).orderBy(F.col("id").cast("string"))
    names = ", ".join(f'"{p}"' for p in properties)
    if os.path.exists(path):
        os.remove(path)
    box = [float("inf"), float("inf"), float("-inf"), float("-inf")]
    with sqlite3.connect(path) as db:
        db.execute("PRAGMA page_size = 4096")
        db.execute(f"CREATE TABLE features (rowid INTEGER PRIMARY KEY, id TEXT, {names}, geometry BLOB)")
        db.execute("CREATE VIRTUAL TABLE features_rtree USING rtree(id, min_lng, max_lng, min_lat, max_lat)")
        for n, r in enumerate(ordered.toLocalIterator(), 1):  # rowid is the rank; rows without a line leave a gap
            points = r[line]
            if not points:
                continue
            blob = struct.pack(f"<BII{2 * len(points)}d", 1, 2, len(points), *[v for p in points for v in (p["x"], p["y"])])
            db.execute(f"INSERT INTO features VALUES (?, ?, {', '.join('?' * len(properties))}, ?)", (n, str(r["id"]), *[r[p] for p in properties], blob))
            db.execute("INSERT INTO features_rtree VALUES (?, ?, ?, ?, ?)", (n, r["min_lng"], r["max_lng"], r["min_lat"], r["max_lat"]))
            box = [min(box[0], r["min_lng"]), min(box[1], r["min_lat"]), max(box[2], r["max_lng"]), max(box[3], r["max_lat"])]
        db.execute("CREATE INDEX features_id ON features (id)")
    with sqlite3.connect(path, isolation_level=None) as db:
        db.execute("VACUUM")
        count = db.execute("SELECT count(*) FROM features").fetchone()[0]
    return manifest(path, count, box)


def manifest(path: str, count: int, box: list[float]) -> dict:
    """Digest, size, count and extent, also written beside the file, atomically."""
    with open(path, "rb") as f:
        digest = hashlib.file_digest(f, "sha256").hexdigest()
    found = {"sha256": digest, "size_bytes": os.path.getsize(path), "feature_count": count, "bbox": box if count else None}
    with open(f"{path}.manifest.json.partial", "w", encoding="utf-8") as f:
        json.dump(found, f, indent=1)
    os.replace(f"{path}.manifest.json.partial", f"{path}.manifest.json")
    return found


def qa_rows(rows: DataFrame) -> DataFrame:
    """Lists as text, ids joined by commas and warnings by bars."""
    return rows.withColumns({"ids": F.array_join(F.col("ids").cast("array<string>"), ","), "warnings": F.array_join("warnings", "|")})
