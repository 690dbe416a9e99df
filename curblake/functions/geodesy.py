"""UTM zone 17N by the transverse Mercator series, as Columns, and WKB."""

from __future__ import annotations

import struct
from math import sqrt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS 84; fixed values.
A, FLATTENING, SCALE, EAST, MERIDIAN = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, -81.0
_n = FLATTENING / (2 - FLATTENING)
_e = sqrt(FLATTENING * (2 - FLATTENING))
_radius = A / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_alpha = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180, 13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440, 61 * _n**3 / 240 - 103 * _n**4 / 140, 49561 * _n**4 / 161280)
_beta = (_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360, _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440, 17 * _n**3 / 480 - 37 * _n**4 / 840, 4397 * _n**4 / 161280)


def to_metres(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi, lam = F.radians(lat), F.radians(lon - MERIDIAN)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - _e * F.atanh(_e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x = eta + sum((a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(_alpha, 1)), F.lit(0.0))
    y = xi + sum((a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(_alpha, 1)), F.lit(0.0))
    return EAST + SCALE * _radius * x, SCALE * _radius * y


def to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    xi, eta = y / (SCALE * _radius), (x - EAST) / (SCALE * _radius)
    a = xi - sum((b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(_beta, 1)), F.lit(0.0))
    b = eta - sum((c * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, c in enumerate(_beta, 1)), F.lit(0.0))
    chi = F.asin(F.sin(a) / F.cosh(b))
    phi = chi
    for _ in range(4):  # tan(chi) to latitude by fixed-point steps
        s = F.sin(phi)
        phi = F.atan(F.sinh(F.atanh(F.sin(chi)) + _e * F.atanh(_e * s)))
    return MERIDIAN + F.degrees(F.atan2(F.sinh(b), F.cos(a))), F.degrees(phi)


def wkb(line: Column) -> Column:
    """Little-endian LineString of array<struct<x, y>>."""

    @F.pandas_udf("binary")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda ps: None if ps is None else struct.pack(f"<BII{2 * len(ps)}d", 1, 2, len(ps), *[v for p in ps for v in (p["x"], p["y"])]))

    return run(line)


def from_wkb(data: Column) -> Column:
    @F.pandas_udf("array<struct<x:double,y:double>>")
    def run(blobs: pd.Series) -> pd.Series:
        def points(b: bytes | None) -> list | None:
            if b is None:
                return None
            v = struct.unpack_from(f"<{2 * struct.unpack_from('<I', b, 5)[0]}d", b, 9)
            return [{"x": v[i], "y": v[i + 1]} for i in range(0, len(v), 2)]

        return blobs.map(points)

    return run(data)
