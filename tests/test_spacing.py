from pyspark.sql import functions as F

from wellnote.plans import spacing as S
from wellnote.plans.inputs import WellTables


def _lateral(well, north, east_from, east_to, tvd, step=1000.0):
    pts, md, e = [], 0.0, east_from
    pts.append((well, md, 10.0, 0.0, 0.0, tvd - 500))          # vertical section, not lateral
    while e <= east_to + 1e-9:
        md += 1000.0
        pts.append((well, md, 88.0, e, north, tvd))
        e += step
    return pts


def _wells(spark):
    pts = (_lateral("A", 0.0, 0.0, 2000.0, 9000.0)
           + [("A", 9000.0, 80.0, 0.0, 5000.0, 1.0),               # inclination exactly 80: not lateral
              ("A", 9500.0, 88.0, None, 0.0, 9000.0)]              # NULL easting: point skipped
           + _lateral("B", 500.0, 0.0, 2000.0, 9100.0)              # due north, tvd diff -100
           + _lateral("C", -300.0, 500.0, 2500.0, 8900.0)           # south-east, tvd diff +100 (edge)
           + _lateral("D", 200.0, -3000.0, -1000.0, 8899.0)         # tvd diff +101: outside the band
           + _lateral("E", -400.0, -2500.0, -500.0, 9500.0)         # west, tvd diff -500 (edge)
           + [("F", 100.0, 88.0, 1000.0, 700.0, 9000.0)])           # one-point lateral
    survey = spark.createDataFrame(pts, "well_id string, measured_depth_ft double, inclination_deg double, "
                                        "easting_offset_ft double, northing_offset_ft double, tvd_offset_ft double")
    header = spark.createDataFrame([(w, "x", "f", "C1", 31.5, -102.0) for w in "ABCDEF"],
                                   "idwell string, wellida string, fieldname string, county string, "
                                   "latitude double, longitude double")
    empty = spark.createDataFrame([], "a int")
    return WellTables(empty, empty, empty, header, empty, empty, empty, empty, survey)


def test_trajectory_stats(spark):
    traj, seg = S.trajectories(_wells(spark))
    t = {r.well_id: r for r in traj.collect()}
    assert t["A"].avg_lateral_tvd == 9000.0 and abs(t["A"].cx - 1000.0) < 1e-9 and t["A"].cy == 0.0
    assert t["F"].cx == 1000.0 and t["F"].cy == 700.0               # one point: the point itself
    assert seg.where("well_id = 'A'").count() == 2 and seg.where("well_id = 'F'").count() == 1


def test_well_spacing_sides_and_band(spark):
    ws = {r.well_id: r for r in S.well_spacing(_wells(spark)).collect()}
    a = ws["A"]
    assert a.east_offset_well_id == "C" and abs(a.east_spacing_ft - 300.0) < 3.0
    assert a.east_vertical_diff_ft == 100.0                         # band edge included
    assert a.west_offset_well_id == "E" and abs(a.west_spacing_ft - 640.3) < 7.0
    assert a.west_vertical_diff_ft == -500.0                        # band edge included
    pairs = S.well_pairs(_wells(spark))
    ab = pairs.where("subject_well_id = 'A' and offset_well_id = 'B'").collect()[0]
    assert ab.azimuth_degrees == 90.0                               # due north counts as East
    assert pairs.where("subject_well_id = 'A' and offset_well_id = 'D'").count() == 1
    ranked = S.ranked_neighbours(pairs)
    assert ranked.where("subject_well_id = 'A' and offset_well_id = 'D'").count() == 0   # diff 101
    # mirrored pair: same distance, negated vertical difference
    ba = pairs.where("subject_well_id = 'B' and offset_well_id = 'A'").collect()[0]
    assert ba.distance_ft == ab.distance_ft and ba.tvd_diff_ft == -ab.tvd_diff_ft


def test_spacing_answers(spark):
    w = _wells(spark)
    ws = S.well_spacing(w)
    dip = dict((r.direction, r.avg_vertical_diff_ft) for r in S.formation_dip(ws).collect())
    east = [r.east_vertical_diff_ft for r in ws.collect() if r.east_vertical_diff_ft is not None]
    assert abs(dip["East"] - sum(east) / len(east)) < 1e-9


def test_lateral_lines_keep_order_and_depth(spark):
    lines = {r.well_id: r.points for r in S.lateral_lines(_wells(spark)).collect()}
    assert [(p.md, p.e, p.n, p.tvd) for p in lines["A"]] == \
        [(1000.0, 0.0, 0.0, 9000.0), (2000.0, 1000.0, 0.0, 9000.0), (3000.0, 2000.0, 0.0, 9000.0)]
    assert [p.tvd for p in lines["F"]] == [9000.0]


def test_candidates_carry_keys_only(spark):
    _, seg = S.trajectories(_wells(spark))
    cand = S.candidate_segments(seg, 250.0, 1800.0)
    assert cand.columns == [c + i for i in ("_1", "_2") for c in S.SEGMENT]
    assert cand.count() == cand.distinct().count()


def test_geometry_travels_with_the_cells(spark):
    # No side of the cell join is a broadcast, however small the planner takes it for, and pairs of
    # segments are not dealt a second time.
    from conftest import plan_text
    pairs = S.well_pairs(_wells(spark))
    plan = plan_text(pairs)
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
    assert not any("seg_no_1" in line for line in plan.splitlines() if "Exchange" in line)
    seg = S.trajectories(_wells(spark))[1]
    met = S.met_segments(seg, 250.0, 1800.0, ["lon_a"])
    keys = [c + i for i in ("_1", "_2") for c in S.SEGMENT]
    assert sorted(met.select(keys).distinct().collect()) == sorted(S.candidate_segments(seg, 250.0, 1800.0).collect())
    place = {(r.well_id, r.seg_no): r.lon_a for r in seg.collect()}
    assert all(place[r.well_id_1, r.seg_no_1] == r.lon_a_1 and place[r.well_id_2, r.seg_no_2] == r.lon_a_2 for r in met.collect())


def test_county_spacing_broadcasts_no_wells(spark):
    # Headers, attributes and properties grow with the wells: none of them is a broadcast through the driver.
    from conftest import plan_text
    from wellnote.plans.production import well_attributes
    w = _wells(spark)
    w.completion = spark.createDataFrame(
        [(i, n, 1, 1, None if n in "AB" else f"P{n}", None, None if n == "F" else n) for i, n in enumerate("ABCDEF")],
        "merrickid long, wellname string, areaid long, batteryid long, apiwellnumber string, ariesid string, wellviewid string")
    w.prop = spark.createDataFrame([("R1", None), ("R2", "PC"), ("R3", "PC"), ("R4", "\0" + "17")], "propnum string, apinum string")
    w.area = spark.createDataFrame([(1, "a")], "areamerrickid long, areaname string")
    w.battery = spark.createDataFrame([(1, "b")], "batterymerrickid long, batteryname string")
    attrs = well_attributes(w)
    assert sorted((r.id, r.aries_id) for r in attrs.collect() if r.aries_id) == [(2, "R2"), (2, "R3")]
    assert sorted(r.id for r in attrs.collect()) == [0, 1, 2, 2, 3, 4, 5]
    ws = spark.createDataFrame([("A", 10.0, None), ("B", 20.0, 40.0), ("C", None, 90.0), ("D", None, None), ("E", 7.0, 7.0)],
                               "well_id string, east_spacing_ft double, west_spacing_ft double")
    got = S.county_spacing(w, ws, attrs.select("id", "wellview_id"))
    assert [(r.county, r.avg_spacing_ft) for r in got.collect()] == [("C1", (10 + 30 + 90 * 2 + 7) / 5)]
    joins = [line for line in plan_text(got).splitlines() if "Join [" in line]
    for key in ("[a_wellview_id", "[h_idwell", "[p_apinum"):  # keys joined on
        assert any(key in line for line in joins)
        assert all("SortMergeJoin" in line for line in joins if key in line)
