"""Geometry as Spark column expressions (JVM-side, no UDFs).

Points are pairs of double columns.  Geographic coordinates are degrees
(lon, lat) on WGS84.  Distances between nearby geographic segments are
measured in a local tangent plane scaled by the WGS84 meridional (M) and
prime-vertical (N) radii at the pair's mean latitude, which the tests hold
against the ellipsoidal geodesic (within 2e-6 relative over a few kilometres).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: WGS84 ellipsoid, the feet-per-degree scale used to place
# --- survey offsets, and the feet-per-metre factor of the spacing output
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)
FT_PER_DEGREE = 364567.2
FT_PER_METRE = 3.28084


def lit(x: float) -> Column:
    return F.lit(float(x))


def offset_to_lonlat(e: Column, n: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """Force-2D, scale feet to degrees (longitude scaled by 1/cos(lat0)) and
    translate to the surface location."""
    fx = lit(1.0) / (F.cos(F.radians(lat0)) * lit(FT_PER_DEGREE))
    fy = lit(1.0) / lit(FT_PER_DEGREE)
    return e * fx + lon0, n * fy + lat0


def radii(lat: Column) -> tuple[Column, Column]:
    """(M, N) of WGS84 at latitude ``lat`` (degrees), metres."""
    s = F.sin(F.radians(lat))
    w = lit(1.0) - lit(WGS84_E2) * s * s
    m = lit(WGS84_A * (1 - WGS84_E2)) / F.pow(w, lit(1.5))
    nn = lit(WGS84_A) / F.sqrt(w)
    return m, nn


def wrap_lon_delta(d: Column) -> Column:
    """A longitude difference brought into [-180, 180] (unchanged, bit for bit,
    when it already is)."""
    return F.when(F.abs(d) > lit(180.0), d - lit(360.0) * F.round(d / lit(360.0), 0)).otherwise(d)


def mid_lon(lon1: Column, lon2: Column) -> Column:
    """Symmetric midpoint longitude, correct across the date line."""
    m = (lon1 + lon2) / 2
    return F.when(F.abs(lon2 - lon1) > lit(180.0), wrap_lon_delta(m + lit(180.0))).otherwise(m)


def plane_scale(lat_r: Column) -> tuple[Column, Column]:
    """Metres per degree of longitude and of latitude in the tangent plane at
    ``lat_r``: (N·cos(lat_r)·pi/180, M·pi/180)."""
    m, nn = radii(lat_r)
    rad = lit(math.pi / 180.0)
    return nn * F.cos(F.radians(lat_r)) * rad, m * rad


def local_xy(lon: Column, lat: Column, lon_r: Column, lat_r: Column,
             scale: tuple[Column, Column] | None = None) -> tuple[Column, Column]:
    """Metres east / north of (lon_r, lat_r) in the tangent plane at lat_r."""
    kx, ky = scale if scale is not None else plane_scale(lat_r)
    return wrap_lon_delta(lon - lon_r) * kx, (lat - lat_r) * ky


def _clamp01(x: Column) -> Column:
    return F.greatest(lit(0.0), F.least(lit(1.0), x))


def _orient(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def segment_distance_stages(df, a, b, c, d, out: str):
    """Planar distance between segments AB and CD (columns named by the
    ``(x, y)`` name pairs a, b, c, d) added as ``out``: 0 when they cross,
    else the smallest endpoint-to-segment distance (covers touching and
    collinear cases).

    Computed in small staged projections (differences, clamp parameters,
    squared distances, one square root) so every generated method stays
    small enough for the JIT and no subexpression is evaluated twice.
    """
    (ax, ay), (bx, by), (cx, cy), (dx, dy) = [(F.col(x), F.col(y)) for x, y in (a, b, c, d)]
    keep = [c_ for c_ in df.columns]
    s1 = df.select(
        *keep,
        (bx - ax).alias("__ux"), (by - ay).alias("__uy"), (dx - cx).alias("__vx"),
        (dy - cy).alias("__vy"),
        ((_orient(ax, ay, bx, by, cx, cy) * _orient(ax, ay, bx, by, dx, dy)) < 0).alias("__c1"),
        ((_orient(cx, cy, dx, dy, ax, ay) * _orient(cx, cy, dx, dy, bx, by)) < 0).alias("__c2"))
    ux, uy, vx, vy = F.col("__ux"), F.col("__uy"), F.col("__vx"), F.col("__vy")
    s2 = s1.select(*keep, "__ux", "__uy", "__vx", "__vy", "__c1", "__c2",
                   (ux * ux + uy * uy).alias("__lu"), (vx * vx + vy * vy).alias("__lv"))
    lu, lv = F.col("__lu"), F.col("__lv")

    def t(px, py, ox, oy, wx, wy, l2):
        return F.when(l2 > 0, _clamp01(((px - ox) * wx + (py - oy) * wy) / l2)).otherwise(lit(0.0))

    s3 = s2.select(*keep, "__ux", "__uy", "__vx", "__vy", "__c1", "__c2",
                   t(cx, cy, ax, ay, ux, uy, lu).alias("__t1"),
                   t(dx, dy, ax, ay, ux, uy, lu).alias("__t2"),
                   t(ax, ay, cx, cy, vx, vy, lv).alias("__t3"),
                   t(bx, by, cx, cy, vx, vy, lv).alias("__t4"))

    def sq(px, py, ox, oy, wx, wy, tt):
        ex, ey = px - (ox + tt * wx), py - (oy + tt * wy)
        return ex * ex + ey * ey

    s4 = s3.select(*keep, "__c1", "__c2",
                   sq(cx, cy, ax, ay, ux, uy, F.col("__t1")).alias("__e1"),
                   sq(dx, dy, ax, ay, ux, uy, F.col("__t2")).alias("__e2"),
                   sq(ax, ay, cx, cy, vx, vy, F.col("__t3")).alias("__e3"),
                   sq(bx, by, cx, cy, vx, vy, F.col("__t4")).alias("__e4"))
    d2 = F.when(F.col("__c1") & F.col("__c2"), lit(0.0)).otherwise(
        F.least(F.col("__e1"), F.col("__e2"), F.col("__e3"), F.col("__e4")))
    return s4.select(*keep, d2.alias(out))


def ecef(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates (metres) of a point on the ellipsoid."""
    phi, lam = F.radians(lat), F.radians(lon)
    _, nn = radii(lat)
    x = nn * F.cos(phi) * F.cos(lam)
    y = nn * F.cos(phi) * F.sin(lam)
    z = nn * lit(1 - WGS84_E2) * F.sin(phi)
    return x, y, z


def ecef_cell(lon: Column, lat: Column, cell_m: float) -> Column:
    """Integer grid cell (struct ix, iy, iz) of a point in earth-centred space.
    No special case at poles or the date line: the grid is Cartesian."""
    x, y, z = ecef(lon, lat)
    return F.struct(F.floor(x / lit(cell_m)).alias("ix"), F.floor(y / lit(cell_m)).alias("iy"),
                    F.floor(z / lit(cell_m)).alias("iz"))


NEIGHBOUR_OFFSETS = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]


def neighbour_cells(cell: Column) -> Column:
    """The 27 cells around and including ``cell``."""
    return F.array(*[F.struct((cell["ix"] + i).alias("ix"), (cell["iy"] + j).alias("iy"),
                              (cell["iz"] + k).alias("iz")) for i, j, k in NEIGHBOUR_OFFSETS])


def azimuth_degrees(dx: Column, dy: Column) -> Column:
    """Angle of (dx, dy), counter-clockwise from east, in degrees."""
    return F.atan2(dy, dx) * lit(180.0) / lit(math.pi)
