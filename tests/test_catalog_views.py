import uuid

import pytest
from pyspark.sql import functions as F

from wellnote.plans.catalog_views import create_views
from wellnote.plans.inputs import driver_note_tables, driver_well_tables
from wellnote.plans.views import VIEW_NAMES, build_views
from wellnote.schemas import NOTE_TABLE, USER_TABLE
from wellnote.sources.tables import write_table

SF = "/root/testdata/sf0.001"
YEARS = {"year_a": 1998, "year_b": 1999}


def staged(spark, db):
    w, n = driver_well_tables(spark, SF), driver_note_tables(spark, SF)
    tables = {"completiontb": w.completion, "areatb": w.area, "batterytb": w.battery, "wellview_wellheader": w.header,
              "ac_property": w.prop, "procount_completiondailytb": w.daily, "aries_daily_capacities": w.capacity,
              "wellview_job": w.job, "wellview_surveypoint": w.survey, NOTE_TABLE: n.note, USER_TABLE: n.user}
    for name, df in tables.items():
        write_table(df, db, name)
    return w, n


def content(df):
    def plain(v):
        return round(v, 5) if isinstance(v, float) else sorted(map(str, v)) if isinstance(v, list) else v
    return sorted((tuple(plain(v) for v in r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def published(spark):
    key = uuid.uuid4().hex[:8]
    w, n = staged(spark, f"stg_{key}")
    assert create_views(spark, f"stg_{key}", f"an_{key}", **YEARS) == VIEW_NAMES
    return f"stg_{key}", f"an_{key}", w, n


def test_views_hold_what_the_plans_give(spark, published):
    _, views, w, n = published
    built = build_views(w, n, **YEARS)
    for name in VIEW_NAMES:
        assert content(spark.newSession().table(f"{views}.{name}")) == content(built[name]), name


def test_a_changed_staging_table_shows_without_publishing(spark, published):
    db, views, w, _ = published
    total = lambda: spark.newSession().sql(
        f"SELECT sum(total_oil), count(*) FROM {views}.well_summary").first()
    before = total()
    extra = spark.createDataFrame([(99_999_999, 1000.0)], "merrickid long, oilproduction double").select(
        *[F.col(c).cast(t).alias(c) if c in ("merrickid", "oilproduction") else
          F.lit("1998-05-05" if c == "productiondate" else None).cast(t).alias(c) for c, t in w.daily.dtypes])
    write_table(w.daily.unionByName(extra), db, "procount_completiondailytb")
    after = total()
    assert after[1] == before[1] + 1 and after[0] == pytest.approx(before[0] + 1000.0)


def test_plans_have_no_nested_loops(spark, published):
    from conftest import plan_text
    for name in VIEW_NAMES:
        text = plan_text(spark.table(f"{published[1]}.{name}"))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_columns_that_no_feed_delivered_are_null(spark):
    key = uuid.uuid4().hex[:8]
    w, _ = staged(spark, f"stg_{key}")
    write_table(w.daily.drop("chokesize", "casingpressure"), f"stg_{key}", "procount_completiondailytb")
    create_views(spark, f"stg_{key}", f"an_{key}", **YEARS)
    got = spark.table(f"an_{key}.daily_series")
    assert dict(got.dtypes)["choke_size"] == "double" and got.where("choke_size is not null").count() == 0


def test_live_spacing_deals_no_pairs_of_segments(spark, published):
    _, views, _, _ = published
    plan = spark.table(f"{views}.well_spacing")._jdf.queryExecution().executedPlan().toString()
    cells = [line for line in plan.splitlines() if "ix#" in line and "Join" in line]
    assert cells and all("SortMergeJoin" in line for line in cells)
    assert not any("HashAggregate(keys=[w1" in line and "s1#" in line for line in plan.splitlines())


def test_live_histories_are_cut_after_the_last_join(spark, published):
    _, views, _, _ = published
    lines = spark.table(f"{views}.note_relationships")._jdf.queryExecution().executedPlan().toString().splitlines()
    cut = [i for i, line in enumerate(lines) if "slice(" in line]
    assert cut and max(cut) < min(i for i, line in enumerate(lines) if "Join" in line)
