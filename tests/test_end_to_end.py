"""Landed files -> staging tables -> answers, against the same plans on the
in-memory inputs."""

import os

from pyspark.sql import functions as F

from wellnote.__main__ import answers, load_specs
from wellnote.plans import production as P
from wellnote.plans import spacing as S
from wellnote.plans.inputs import driver_note_tables, driver_well_tables
from wellnote.sources.tables import load_all
from wellnote.schemas import NOTE_TABLE, USER_TABLE

SF = "/root/testdata/sf0.001"


def _land(w, n, csv_dir, pages_dir):
    # one CSV file per lookup, named after its table
    for name, df in (("areatb", w.area), ("batterytb", w.battery), ("completiontb", w.completion),
                     ("ac_property", w.prop)):
        part = os.path.join(csv_dir, "_parts", name)
        df.coalesce(1).write.option("header", True).option("quoteAll", True).csv(part)
        src = [f for f in os.listdir(part) if f.endswith(".csv")][0]
        os.link(os.path.join(part, src), os.path.join(csv_dir, f"{name}.csv"))
    survey = w.survey.select("well_id", "measured_depth_ft", F.col("inclination_deg").alias("inclination"),
                             F.col("easting_offset_ft").alias("easting"),
                             F.col("northing_offset_ft").alias("northing"), F.col("tvd_offset_ft").alias("tvd"))
    pages = {"wellview_wellheader": w.header, "procount_completiondailytb": w.daily,
             "aries_daily_capacities": w.capacity, "wellview_job": w.job, "wellview_surveypoint": survey,
             NOTE_TABLE: n.note, USER_TABLE: n.user}
    for name, df in pages.items():
        df.write.json(os.path.join(pages_dir, name))


def test_landed_files_to_answers(spark, scratch):
    assert os.path.isdir(SF)
    w, n = driver_well_tables(spark, SF), driver_note_tables(spark, SF)
    csv_dir, pages_dir = os.path.join(scratch, "csv"), os.path.join(scratch, "pages")
    os.makedirs(csv_dir)
    _land(w, n, csv_dir, pages_dir)
    report = {r.table: r for r in load_all(spark, load_specs(spark, csv_dir, pages_dir, "dedupe"), "stg_e2e").collect()}
    assert all(r.status == "loaded" for r in report.values()), report
    assert len(report) == 11
    got = answers(spark, "stg_e2e", 1998, 1999, "BUILDING")
    fp = got["field_production"].collect()[0]
    ref = P.field_production(w, field="BUILDING", year=1998).collect()[0]
    assert abs(fp[1] - ref[1]) < 1e-6 * max(1.0, abs(ref[1]))
    assert got["cleanout_losses"].count() == P.cleanout_losses(w).count()
    dip = dict((r.direction, r.avg_vertical_diff_ft) for r in got["formation_dip"].collect())
    ref_dip = dict((r.direction, r.avg_vertical_diff_ft) for r in S.formation_dip(S.well_spacing(w)).collect())
    assert dip == ref_dip
    assert got["user_summary"].count() == n.user.count()
    assert got["top_conversation"].count() == 1
