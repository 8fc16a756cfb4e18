"""Well spacing (lateral-to-lateral distance, vertical offset and side of the
nearest neighbour) and the spacing answers.

A well's *lateral* is the line through its survey points with inclination
above ``min_incl`` (ordered by measured depth, NULL depths last), placed on
the map by scaling its foot offsets to degrees around the surface location.
As in the reference, a well entity is ``(well_id, surface lat, surface lon)``.

The distance join never compares every well with every other one: lateral
segments are sampled at most ``step_m`` apart into an earth-centred grid of
``cell_m`` cells; two laterals within ``radius_m`` have sample points in
neighbouring cells (radius + step < cell), so candidate segment pairs come
from an equi-join on the cell id, to which both segments bring their ends.  The exact
distance of a well pair is the smallest segment-to-segment distance among its candidates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellnote.functions import geo
from wellnote.operators.aggs import direction_pivot, safe_corr
from wellnote.plans.inputs import WellTables
from wellnote.plans.production import well_attributes, well_summary
from wellnote.session import written_once

ENTITY = ["well_id", "lat0", "lon0"]
SEGMENT = [*ENTITY, "seg_no"]


def lateral_points(w: WellTables, min_incl: float = 80.0) -> DataFrame:
    """Survey points with their well's surface location and a lateral flag."""
    h = w.header.select(F.col("idwell").alias("h_idwell"), F.col("latitude").alias("lat0"),
                        F.col("longitude").alias("lon0"))
    s = w.survey.select("well_id", F.col("measured_depth_ft").alias("md"),
                        F.col("inclination_deg").alias("incl"), F.col("easting_offset_ft").alias("e"),
                        F.col("northing_offset_ft").alias("n"), F.col("tvd_offset_ft").alias("tvd"))
    # A merge: neither table is small, whatever the planner makes of their sizes.
    pts = s.join(h.hint("merge"), F.col("well_id") == F.col("h_idwell")).drop("h_idwell")
    lateral = F.coalesce(F.col("incl") > F.lit(float(min_incl)), F.lit(False))
    point_ok = F.col("e").isNotNull() & F.col("n").isNotNull() & F.col("tvd").isNotNull()
    return pts.withColumn("is_lateral", lateral).withColumn("is_lat_pt", lateral & point_ok)


def lateral_segments(pts: DataFrame) -> DataFrame:
    """Consecutive lateral points as segments (ea, na) -> (eb, nb), in feet;
    a one-point lateral is a zero-length segment.  Only wells placed on the
    map (non-NULL surface location) are kept."""
    lp = pts.where(F.col("is_lat_pt") & F.col("lat0").isNotNull() & F.col("lon0").isNotNull())
    w = Window.partitionBy(*ENTITY).orderBy(F.col("md").asc_nulls_last(), "e", "n")
    seg = (lp.select(*ENTITY, "e", "n", F.row_number().over(w).alias("seg_no"),
                     F.lead("e").over(w).alias("e2"), F.lead("n").over(w).alias("n2"))
           .where(F.col("e2").isNotNull() | (F.col("seg_no") == 1)))
    return seg.select(*ENTITY, "seg_no", F.col("e").alias("ea"), F.col("n").alias("na"),
                      F.coalesce("e2", "e").alias("eb"), F.coalesce("n2", "n").alias("nb"))


def lateral_lines(w: WellTables, min_incl: float = 80.0) -> DataFrame:
    """V4b: the 3-D line of each lateral: ``(ENTITY, points)``, an array of (md, e, n, tvd) by
    measured depth, NULL depths last.  A line has as many points as its bore was surveyed at."""
    lp = lateral_points(w, min_incl).where("is_lat_pt")
    point = F.struct(F.col("md").isNull().alias("_last"), "md", "e", "n", "tvd")
    points = F.transform(F.array_sort(F.collect_list(point)),
                         lambda p: F.struct(p["md"].alias("md"), p["e"].alias("e"), p["n"].alias("n"), p["tvd"].alias("tvd")))
    return lp.groupBy(*ENTITY).agg(points.alias("points"))


def trajectories(w: WellTables, min_incl: float = 80.0) -> tuple[DataFrame, DataFrame]:
    """V4a/V4b: per entity the mean lateral TVD and the 2-D centroid of the
    lateral in its own foot offsets (length-weighted segment midpoints; the
    point mean when the lateral has zero length); and the lateral segments."""
    pts = lateral_points(w, min_incl)
    seg = lateral_segments(pts)
    stats = (pts.where(F.col("lat0").isNotNull() & F.col("lon0").isNotNull())
             .groupBy(*ENTITY).agg(
                 F.avg(F.when(F.col("is_lateral"), F.col("tvd"))).alias("avg_lateral_tvd"),
                 F.avg(F.when(F.col("is_lat_pt"), F.col("e"))).alias("me"),
                 F.avg(F.when(F.col("is_lat_pt"), F.col("n"))).alias("mn")))
    de, dn = F.col("eb") - F.col("ea"), F.col("nb") - F.col("na")
    ln = F.sqrt(de * de + dn * dn)
    cent = seg.groupBy(*ENTITY).agg(
        F.sum(ln).alias("tl"),
        F.sum(ln * ((F.col("ea") + F.col("eb")) / 2)).alias("sx"),
        F.sum(ln * ((F.col("na") + F.col("nb")) / 2)).alias("sy"))
    traj = stats.join(cent.hint("merge"), ENTITY).select(
        *ENTITY, "avg_lateral_tvd",
        F.when(F.col("tl") > 0, F.col("sx") / F.col("tl")).otherwise(F.col("me")).alias("cx"),
        F.when(F.col("tl") > 0, F.col("sy") / F.col("tl")).otherwise(F.col("mn")).alias("cy"))
    lon_a, lat_a = geo.offset_to_lonlat(F.col("ea"), F.col("na"), F.col("lat0"), F.col("lon0"))
    lon_b, lat_b = geo.offset_to_lonlat(F.col("eb"), F.col("nb"), F.col("lat0"), F.col("lon0"))
    geo_seg = seg.select(*ENTITY, "seg_no", lon_a.alias("lon_a"), lat_a.alias("lat_a"),
                         lon_b.alias("lon_b"), lat_b.alias("lat_b"))
    return traj, geo_seg


def segment_cells(geo_seg: DataFrame, step_m: float, cell_m: float, carry: Sequence[str] = ()) -> DataFrame:
    """Each segment's key (and the columns ``carry``) with ``cells``, the distinct grid cells of its sample points."""
    x, y = geo.local_xy(F.col("lon_b"), F.col("lat_b"), F.col("lon_a"), F.col("lat_a"))
    k = F.greatest(F.lit(1), F.ceil(F.sqrt(x * x + y * y) / F.lit(float(step_m))).cast("int"))
    t = F.transform(F.sequence(F.lit(0), k), lambda i: i / k)
    d_lon = geo.wrap_lon_delta(F.col("lon_b") - F.col("lon_a"))
    cells = F.array_distinct(F.transform(t, lambda u: geo.ecef_cell(
        F.col("lon_a") + u * d_lon,
        F.col("lat_a") + u * (F.col("lat_b") - F.col("lat_a")), cell_m)))
    return geo_seg.select(*SEGMENT, *carry, cells.alias("cells"))


def met_segments(geo_seg: DataFrame, step_m: float, cell_m: float, carry: Sequence[str] = ()) -> DataFrame:
    """Segment pairs of different wells (``well_id_1 < well_id_2``) with sample points in neighbouring
    cells, with the columns ``carry`` of both; a pair may come once for each cell of its first segment.

    The columns travel with the cells, a fixed number of copies a segment, so that no pair of segments is
    dealt again for them.  The join is a merge: copies are far larger than the planner takes them for, and
    as a broadcast they would pass through the driver.
    """
    sc = segment_cells(geo_seg, step_m, cell_m, carry)
    around = F.array_distinct(F.flatten(F.transform("cells", geo.neighbour_cells)))
    left, right = (sc.select(*[F.col(c).alias(c + i) for c in [*SEGMENT, *carry]], F.explode(cells).alias("cell" + i))
                   for i, cells in (("_1", F.col("cells")), ("_2", around)))
    return (left.join(right.hint("merge"), (F.col("cell_1") == F.col("cell_2")) & (F.col("well_id_1") < F.col("well_id_2")))
            .drop("cell_1", "cell_2"))


def candidate_segments(geo_seg: DataFrame, step_m: float, cell_m: float) -> DataFrame:
    """Keys of the pairs of :func:`met_segments`, each once."""
    return (met_segments(geo_seg, step_m, cell_m)
            .select(*[c + i for i in ("_1", "_2") for c in SEGMENT]).distinct())


def near_pairs(geo_seg: DataFrame, radius_m: float = 1500.0,
               step_m: float = 250.0, cell_m: float = 1800.0) -> DataFrame:
    """V4c geometry: unordered entity pairs of different wells whose laterals
    come within ``radius_m`` metres, with that distance (``well_id_1 <
    well_id_2``).  Distances are taken where segments meet: what is dealt after that
    is the smallest of each entity pair in each task."""
    if radius_m + step_m >= cell_m:
        raise ValueError("cell_m must exceed radius_m + step_m")
    ends = ["lon_a", "lat_a", "lon_b", "lat_b"]
    cand = met_segments(geo_seg, step_m, cell_m, ends)
    keys = [c + "_1" for c in ENTITY] + [c + "_2" for c in ENTITY]
    coords = [f"{c}_{i}" for i in (1, 2) for c in ends]
    # Staged projections keep each expression small (and inside codegen).
    lat_r = (F.col("lat0_1") + F.col("lat0_2")) / 2
    lon_r = geo.mid_lon(F.col("lon0_1"), F.col("lon0_2"))
    kx, ky = geo.plane_scale(F.col("lat_r"))
    staged = (cand.select(*keys, *coords, lat_r.alias("lat_r"), lon_r.alias("lon_r"))
              .select(*keys, *coords, "lat_r", "lon_r", kx.alias("kx"), ky.alias("ky")))
    sc_ = (F.col("kx"), F.col("ky"))
    pts = {}
    for name, i, end in (("a", 1, "a"), ("b", 1, "b"), ("c", 2, "a"), ("d", 2, "b")):
        x, y = geo.local_xy(F.col(f"lon_{end}_{i}"), F.col(f"lat_{end}_{i}"), F.col("lon_r"),
                            F.col("lat_r"), sc_)
        pts[name] = (x.alias(f"q{name}x"), y.alias(f"q{name}y"))
    local = staged.select(*keys, *[c for v in pts.values() for c in v])
    # squared planar distance per candidate; sqrt is monotonic, so the root of
    # the smallest square is the smallest distance
    d2 = geo.segment_distance_stages(local, ("qax", "qay"), ("qbx", "qby"), ("qcx", "qcy"),
                                     ("qdx", "qdy"), "d2")
    return (d2.groupBy(*keys).agg(F.min("d2").alias("d2"))
            .select(*keys, F.sqrt("d2").alias("d_m"))
            .where(F.col("d_m") <= F.lit(float(radius_m))))


def well_pairs(w: WellTables, min_incl: float = 80.0, radius_m: float = 1500.0,
               step_m: float = 250.0, cell_m: float = 1800.0) -> DataFrame:
    """V4c: ordered (subject, offset) pairs within ``radius_m`` with distance
    in feet, subject-minus-offset lateral TVD and the direction angle between
    the centroids (each in its own well's offset frame, as the reference).
    The per-well stats and the lateral segments are written once to the shared
    folder, where both ends of every pair read them."""
    traj, geo_seg = trajectories(w, min_incl)
    traj, geo_seg = written_once(traj), written_once(geo_seg)
    pairs = near_pairs(geo_seg, radius_m, step_m, cell_m)
    for i in ("_1", "_2"):
        pairs = pairs.join(traj.select(*[F.col(c).alias(c + i) for c in [*ENTITY, "avg_lateral_tvd", "cx", "cy"]])
                           .hint("merge"), [c + i for c in ENTITY])
    end = lambda i: F.struct(F.col("well_id" + i).alias("id"), F.col("avg_lateral_tvd" + i).alias("tvd"),
                             F.col("cx" + i).alias("cx"), F.col("cy" + i).alias("cy"))
    both = pairs.select("d_m", F.explode(F.array(
        F.struct(end("_1").alias("s"), end("_2").alias("o")),
        F.struct(end("_2").alias("s"), end("_1").alias("o")))).alias("p"))
    return both.select(
        F.col("p.s.id").alias("subject_well_id"), F.col("p.o.id").alias("offset_well_id"),
        (F.col("d_m") * F.lit(geo.FT_PER_METRE)).alias("distance_ft"),
        (F.col("p.s.tvd") - F.col("p.o.tvd")).alias("tvd_diff_ft"),
        geo.azimuth_degrees(F.col("p.o.cx") - F.col("p.s.cx"), F.col("p.o.cy") - F.col("p.s.cy"))
        .alias("azimuth_degrees"))


def ranked_neighbours(pairs: DataFrame, tvd_lo: float = -500.0, tvd_hi: float = 100.0) -> DataFrame:
    """V4d: pairs inside the vertical band with their side: East when the
    angle lies in [-90, 90], else West (a NULL angle counts as West)."""
    east = F.coalesce(F.col("azimuth_degrees").between(-90, 90), F.lit(False))
    return (pairs.where(F.col("tvd_diff_ft").between(float(tvd_lo), float(tvd_hi)))
            .withColumn("offset_direction", F.when(east, "East").otherwise("West")))


def well_spacing(w: WellTables, min_incl: float = 80.0, radius_m: float = 1500.0,
                 tvd_lo: float = -500.0, tvd_hi: float = 100.0, step_m: float = 250.0,
                 cell_m: float = 1800.0) -> DataFrame:
    """V4: per well the nearest East and West neighbour (ties: smallest offset
    id), its spacing in feet and vertical difference."""
    ranked = ranked_neighbours(well_pairs(w, min_incl, radius_m, step_m, cell_m),
                               tvd_lo, tvd_hi)
    piv = direction_pivot(ranked, "subject_well_id", "offset_direction",
                          ["distance_ft", "offset_well_id"],
                          ["offset_well_id", "distance_ft", "tvd_diff_ft"], ["East", "West"])
    return piv.select(
        F.col("subject_well_id").alias("well_id"),
        F.col("east_offset_well_id"), F.col("east_distance_ft").alias("east_spacing_ft"),
        F.col("east_tvd_diff_ft").alias("east_vertical_diff_ft"),
        F.col("west_offset_well_id"), F.col("west_distance_ft").alias("west_spacing_ft"),
        F.col("west_tvd_diff_ft").alias("west_vertical_diff_ft"))


def county_spacing(w: WellTables, ws: DataFrame, attrs: DataFrame | None = None) -> DataFrame:
    """Q3a: mean spacing per county (mean of both sides when both exist)."""
    attrs = attrs if attrs is not None else well_attributes(w)
    e, wv = F.col("east_spacing_ft"), F.col("west_spacing_ft")
    sp = (F.when(e.isNotNull() & wv.isNotNull(), (e + wv) / 2.0)
          .when(e.isNotNull(), e).when(wv.isNotNull(), wv))
    # Merges: attributes and headers grow with the wells.
    j = (ws.where(e.isNotNull() | wv.isNotNull())
         .join(attrs.select(F.col("wellview_id").alias("a_wellview_id")).hint("merge"),
               F.col("well_id") == F.col("a_wellview_id"))
         .join(w.header.select(F.col("idwell").alias("h_idwell"), "county").hint("merge"),
               F.col("well_id") == F.col("h_idwell")))
    return (j.groupBy("county").agg(F.avg(sp).alias("avg_spacing_ft"))
            .orderBy(F.col("avg_spacing_ft").asc_nulls_last()))


def formation_dip(ws: DataFrame) -> DataFrame:
    """Q3b: mean vertical difference to the East and to the West neighbour
    (one pass, two rows)."""
    a = ws.agg(F.avg("east_vertical_diff_ft").alias("East"), F.avg("west_vertical_diff_ft").alias("West"))
    return a.select(F.expr("stack(2, 'East', East, 'West', West) as (direction, avg_vertical_diff_ft)"))


def spacing_corr(w: WellTables, ws: DataFrame, attrs: DataFrame | None = None,
                 summary: DataFrame | None = None, **summary_args) -> DataFrame:
    """Q3c: correlation of East / West spacing with six-month cumulative oil."""
    attrs = attrs if attrs is not None else well_attributes(w)
    sm = summary if summary is not None else well_summary(w, attrs, **summary_args)
    j = (ws.join(attrs.select(F.col("id").alias("a_id"), F.col("wellview_id").alias("a_wellview_id")).hint("merge"),
                 F.col("well_id") == F.col("a_wellview_id"))
         .join(sm.select(F.col("well_id").alias("s_well_id"), "six_month_cumulative_oil").hint("merge"),
               F.col("a_id") == F.col("s_well_id")))
    oil = F.col("six_month_cumulative_oil")
    return j.agg(safe_corr(F.col("east_spacing_ft"), oil).alias("correlation_east_spacing_vs_oil"),
                 safe_corr(F.col("west_spacing_ft"), oil).alias("correlation_west_spacing_vs_oil"))
