import math
import random

from pyspark.sql import functions as F

from conftest import plan_text
from wellnote.functions import geo
from wellnote.plans.spacing import near_pairs


def vincenty(lat1, lon1, lat2, lon2):
    """WGS84 inverse geodesic distance (metres), Vincenty's iteration."""
    a, f = geo.WGS84_A, geo.WGS84_F
    b = (1 - f) * a
    L = math.radians(lon2 - lon1)
    U1, U2 = math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2)))
    sU1, cU1, sU2, cU2 = math.sin(U1), math.cos(U1), math.sin(U2), math.cos(U2)
    lam = L
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.hypot(cU2 * sl, cU1 * sU2 - sU1 * cU2 * cl)
        if ss == 0:
            return 0.0
        cs = sU1 * sU2 + cU1 * cU2 * cl
        sig = math.atan2(ss, cs)
        sa = cU1 * cU2 * sl / ss
        c2a = 1 - sa * sa
        c2m = cs - 2 * sU1 * sU2 / c2a if c2a else 0.0
        C = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        prev, lam = lam, L + (1 - C) * f * sa * (sig + C * ss * (c2m + C * cs * (-1 + 2 * c2m * c2m)))
        if abs(lam - prev) < 1e-13:
            break
    u2 = c2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * ss * (c2m + B / 4 * (cs * (-1 + 2 * c2m * c2m) - B / 6 * c2m * (-3 + 4 * ss * ss) * (-3 + 4 * c2m * c2m)))
    return b * A * (sig - ds)


def _seg_df(spark, segs):
    return spark.createDataFrame(segs, "ax double, ay double, bx double, by double, "
                                       "cx double, cy double, dx double, dy double")


def test_segment_distance_cases(spark):
    cases = [((0, 0), (10, 0), (5, -5), (5, 5), 0.0),          # crossing
             ((0, 0), (10, 0), (0, 3), (10, 3), 3.0),          # parallel
             ((0, 0), (10, 0), (10, 0), (12, 4), 0.0),         # touching at an end
             ((0, 0), (10, 0), (12, 0), (15, 0), 2.0),         # collinear, apart
             ((1, 1), (1, 1), (4, 5), (4, 5), 5.0),            # two points
             ((0, 0), (0, 0), (-3, 4), (3, 4), 4.0)]           # point to segment
    df = _seg_df(spark, [tuple(float(v) for v in (*a, *b, *c, *d)) for a, b, c, d, _ in cases])
    out = geo.segment_distance_stages(df, ("ax", "ay"), ("bx", "by"), ("cx", "cy"), ("dx", "dy"), "d2")
    got = [math.sqrt(r.d2) for r in out.collect()]
    assert all(abs(g - e) < 1e-12 for g, (*_, e) in zip(got, cases))


def test_local_plane_matches_vincenty(spark):
    random.seed(11)
    pts = []
    for _ in range(200):
        lat, lon = random.uniform(-70, 70), random.uniform(-180, 180)
        d_lat, d_lon = random.uniform(-0.015, 0.015), random.uniform(-0.02, 0.02)
        pts.append((lat, lon, lat + d_lat, lon + d_lon))
    df = spark.createDataFrame(pts, "la1 double, lo1 double, la2 double, lo2 double")
    lat_r = (F.col("la1") + F.col("la2")) / 2
    lon_r = (F.col("lo1") + F.col("lo2")) / 2
    x1, y1 = geo.local_xy(F.col("lo1"), F.col("la1"), lon_r, lat_r)
    x2, y2 = geo.local_xy(F.col("lo2"), F.col("la2"), lon_r, lat_r)
    for r, (la1, lo1, la2, lo2) in zip(df.select(F.hypot(x2 - x1, y2 - y1).alias("d")).collect(), pts):
        v = vincenty(la1, lo1, la2, lo2)
        assert abs(r.d - v) <= 2e-6 * v + 1e-6, (r.d, v)


def _random_segments(n_wells, seed):
    random.seed(seed)
    rows = []
    centres = [(89.9, 10.0), (-89.95, 0.0), (0.0, 179.99), (0.0, -179.99), (60.0, 25.0), (31.5, -102.0)]
    for w in range(n_wells):
        clat, clon = centres[w % len(centres)]
        lat0 = clat + random.uniform(-0.01, 0.01)
        lon0 = clon + random.uniform(-0.02, 0.02)
        lat0 = max(min(lat0, 89.999), -89.999)
        n = random.randint(1, 4)
        pts = [(lat0 + random.uniform(-0.01, 0.01), lon0 + random.uniform(-0.02, 0.02)) for _ in range(n)]
        if n == 1:
            pts = pts * 2
        for i in range(len(pts) - 1):
            (la_a, lo_a), (la_b, lo_b) = pts[i], pts[i + 1]
            wrap = lambda x: (x + 180.0) % 360.0 - 180.0
            rows.append((f"W{w:03d}", lat0, lon0, i + 1, wrap(lo_a), la_a, wrap(lo_b), la_b))
    return rows


def test_grid_pairs_equal_brute_force(spark):
    segs = spark.createDataFrame(_random_segments(60, 5), "well_id string, lat0 double, lon0 double, "
                                 "seg_no int, lon_a double, lat_a double, lon_b double, lat_b double")
    got = near_pairs(segs, radius_m=1500.0)
    assert "Cartesian" not in plan_text(got) and "NestedLoop" not in plan_text(got)
    # brute force: every segment against every other segment
    l = segs.select(*[F.col(c).alias(c + "_1") for c in segs.columns])
    r = segs.select(*[F.col(c).alias(c + "_2") for c in segs.columns])
    cand = l.crossJoin(r).where(F.col("well_id_1") < F.col("well_id_2"))
    lat_r = (F.col("lat0_1") + F.col("lat0_2")) / 2
    lon_r = geo.mid_lon(F.col("lon0_1"), F.col("lon0_2"))
    cols = {}
    for name, i, end in (("a", 1, "a"), ("b", 1, "b"), ("c", 2, "a"), ("d", 2, "b")):
        x, y = geo.local_xy(F.col(f"lon_{end}_{i}"), F.col(f"lat_{end}_{i}"), lon_r, lat_r)
        cols[f"q{name}x"], cols[f"q{name}y"] = x, y
    keys = ["well_id_1", "well_id_2"]
    loc = cand.select(*keys, *[v.alias(k) for k, v in cols.items()])
    d2 = geo.segment_distance_stages(loc, ("qax", "qay"), ("qbx", "qby"), ("qcx", "qcy"), ("qdx", "qdy"), "d2")
    brute = (d2.groupBy(*keys).agg(F.sqrt(F.min("d2")).alias("d"))
             .where(F.col("d") <= 1500.0))
    g = {(r.well_id_1, r.well_id_2): r.d_m for r in got.collect()}
    b = {(r.well_id_1, r.well_id_2): r.d for r in brute.collect()}
    assert g.keys() == b.keys() and len(b) > 20, (sorted(set(g) - set(b))[:5], sorted(set(b) - set(g))[:5], [(k, b[k]) for k in sorted(set(b) - set(g))[:5]])
    assert all(abs(g[k] - b[k]) < 1e-9 for k in b)
