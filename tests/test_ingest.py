import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from wellnote.operators.ingest import column_profile, dedupe, typed_projection, with_duplicate_flag
from wellnote.sources.csv_dir import list_csv_files, read_csv_text, table_name
from wellnote.sources.paged import MissingPages, read_json_records, read_pages, records_of_responses
from wellnote.sources.tables import TableSpec, csv_specs, load_all, prepare, write_table
from wellnote.plans.inputs import landed_answers
from wellnote.schemas import NA_TOKENS, NOTE_TABLE, USER_TABLE

CSV_EDGE = (
    'producingmethodsmerrickid,producingmethodsdescription,extra\n'
    '"0"," Unassigned","x"\n'
    '"1","Flowing","y"\n'
    '"1","Flowing","y"\n'
    '"2","NA",""\n'
    '"3.0","say ""hi""",\n'
    '"007","<New Record>","z"\n'
    '"abc","bad id","w"\n'
)


def test_csv_edge_typed_by_name(spark, scratch):
    path = os.path.join(scratch, "producingmethodstb.csv")
    with open(path, "w") as f:
        f.write(CSV_EDGE)
    text = read_csv_text(spark, path)
    assert all(isinstance(f.dataType, T.StringType) for f in text.schema.fields)
    typed = typed_projection(text, "producingmethodstb")
    assert typed.columns == ["producingmethodmerrickid", "producingmethodname", "extra"]
    assert typed.schema["producingmethodmerrickid"].dataType == T.IntegerType()
    got = rows(typed)
    assert (0, " Unassigned", "x") in got            # leading blank kept
    assert (2, None, None) in got                     # NA token and empty -> NULL
    assert (3, 'say "hi"', None) in got               # 3.0 -> 3, doubled quotes
    assert (7, "<New Record>", "z") in got            # leading zeros of an int column
    assert (None, "bad id", "w") in got               # unparseable -> NULL
    assert dedupe(typed).count() == 6
    flagged = with_duplicate_flag(typed)
    assert rows(flagged.where("duplicate_flag"), "producingmethodmerrickid") == [(1,), (1,)]


def test_csv_tables_folder(spark, scratch):
    for name in ("areatb", "routetb"):
        with open(os.path.join(scratch, f"{name}.csv"), "w") as f:
            f.write(f'{name[:-2]}merrickid,{name[:-2]}name\n"0","Unassigned"\n"1","{name} 1"\n')
    with open(os.path.join(scratch, "notes.txt"), "w") as f:
        f.write("not a table")
    tabs = {table_name(p): p for p in list_csv_files(spark, scratch)}
    assert sorted(tabs) == ["areatb", "routetb"] == sorted(t.table for t in csv_specs(spark, scratch))
    area = typed_projection(read_csv_text(spark, tabs["areatb"]), "areatb")
    assert rows(area) == [(0, "Unassigned"), (1, "areatb 1")]


def test_duplicate_flag_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, None)], "a int, b string")
    got = rows(with_duplicate_flag(df))
    assert got.count((1, None, True)) == 2 and (2, "a", False) in got and (None, None, False) in got


def test_timestamp_and_int_casts(spark):
    df = spark.createDataFrame([("1.0", "2024-01-02T05:00:00+02:00", "2024-01-02", "true", "1.5")],
                               "user_id string, note_timestamp string, d string, is_edited string, event_id string")
    t = typed_projection(df, NOTE_TABLE).collect()[0]
    assert t.user_id == 1 and t.is_edited is True and t.event_id is None
    assert str(t.note_timestamp) == "2024-01-02 05:00:00" and t.d == "2024-01-02"


def test_column_profile_first_non_null(spark):
    df = spark.createDataFrame([(3, "c" * 150, None), (1, None, 5.0), (2, "b", None)],
                               "k int, s string, x double")
    got = dict((r.column_name, r.sample_value) for r in column_profile(df, "k").collect())
    assert got == {"k": "1", "s": "b", "x": "5.0"}
    got2 = dict((r.column_name, r.sample_value) for r in column_profile(df.where("k = 3"), "k").collect())
    assert got2["s"] == "c" * 100 and got2["x"] is None


def test_integers_are_exact_over_64_bits(spark):
    values = ["9007199254740993", "-9007199254740993", "9223372036854775807", "9223372036854775808", "007", "3.0",
              "3.5", "9007199254740993.0", "", "x", None, "-0", "1e3"]
    df = spark.createDataFrame([(v,) for v in values], "event_id string")
    got = [r.event_id for r in typed_projection(df, NOTE_TABLE, missing=()).collect()]
    assert got == [9007199254740993, -9007199254740993, 9223372036854775807, None, 7, 3, None,
                   9007199254740993, None, None, None, 0, 1000]


def test_flag_column_of_the_feed_gives_way(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "a int, duplicate_flag string")
    out = with_duplicate_flag(df)
    assert out.columns == ["a", "duplicate_flag"]
    assert sorted(r.duplicate_flag for r in out.collect()) == [False, True, True]


class Feed:
    """Test fetcher: ``n`` records, ``total`` announced, an empty or failing page at ``hole``."""

    def __init__(self, n="2500", total="", hole="-1", fail="0"):
        self.n, self.hole, self.fail = int(n), int(hole), fail == "1"
        self.announced = None if total == "none" else int(total or n)

    def total(self):
        return self.announced

    def columns(self):
        return ["id", "v", "s", "b"]

    def fetch(self, offset, limit):
        if offset <= self.hole < offset + limit:
            if self.fail:
                raise OSError("page cannot be fetched")
            return []
        return [{"id": i, "v": i / 4, "b": i % 2 == 0} | ({} if i % 7 == 0 else {"s": f"r{i}"})
                for i in range(offset, min(offset + limit, self.n))]


def test_paged_source_three_pages(spark):
    df = read_pages(spark, Feed, page_size=1000, pages_per_partition=1)
    assert df.rdd.getNumPartitions() == 3
    typed = typed_projection(df, declared=[("id", T.LongType()), ("v", T.DoubleType()), ("b", T.BooleanType())],
                             missing=())
    assert typed.agg(F.sum("id"), F.sum("v"), F.count("s"), F.count_if("b")).collect()[0] == (
        sum(range(2500)), sum(i / 4 for i in range(2500)), 2500 - len(range(0, 2500, 7)), 1250)


def test_paged_source_without_a_total_is_one_page(spark):
    assert read_pages(spark, Feed, page_size=1000, total="none", n="800").count() == 800


@pytest.mark.parametrize("options", [{"hole": "1500"}, {"hole": "1500", "fail": "1"}, {"total": "2600"}])
def test_missing_pages_fail_the_read(spark, options):
    with pytest.raises(Exception, match="announced|fetched"):
        read_pages(spark, Feed, page_size=100, pages_per_partition=4, **options).count()


def test_landed_responses(spark):
    rows_ = spark.range(2345).select(F.col("id").alias("place"), F.col("id").cast("string").alias("k"),
                                     F.when(F.col("id") % 3 == 0, None).otherwise("NA").alias("t"))
    answers = landed_answers(rows_, "place", 100)
    assert answers.count() == 24
    got = records_of_responses(answers, ["k", "t"])
    assert rows(got) == rows(rows_, "k", "t")
    for bad in (answers.where("offset <> 700"), answers.withColumn("body", F.when(F.col("offset") == 0, "[{").otherwise(F.col("body")))):
        with pytest.raises(MissingPages):
            records_of_responses(bad, ["k"])
    one = spark.createDataFrame([(0, None, '[{"k": 1, "x": {"y": [1]}}, {"k": "NA"}, {}]')],
                                "offset long, content_range string, body string")
    assert rows(records_of_responses(one, ["k", "x"])) == sorted([("1", '{"y":[1]}'), ("NA", None), (None, None)], key=repr)


def test_load_all_reports_and_skips(spark, scratch):
    path = os.path.join(scratch, "batterytb.csv")
    with open(path, "w") as f:
        f.write('batterymerrickid,batteryname\n"0","Unassigned"\n"0","Unassigned"\n"5","Battery 5"\n')
    def broken(_):
        raise OSError("gone " * 200)

    specs = [TableSpec("batterytb", lambda s: read_csv_text(s, path)), TableSpec("broken", broken),
             TableSpec("empty", lambda s: s.createDataFrame([], "a string"))]
    report = load_all(spark, specs, db="stg_test").collect()
    assert [r.error for r in report][1] == "gone " * 200
    rep = dict((r.table, (r.rows, r.status)) for r in report)
    assert rep["batterytb"] == (2, "loaded")
    assert rep["broken"][1] == "failed" and rep["empty"] == (0, "skipped_empty")
    assert spark.table("stg_test.batterytb").count() == 2
    assert write_table(spark.createDataFrame([], "a string"), "stg_test", "batterytb") == 0
    assert spark.table("stg_test.batterytb").count() == 2   # empty input leaves the old table


def test_json_records_union_of_keys(spark, scratch):
    path = os.path.join(scratch, "page-0.json")
    with open(path, "w") as f:
        f.write('{"user_id": 1.0, "handle": "ann"}\n{"user_id": 2, "note": "x"}\n')
    text = read_json_records(spark, path)
    assert sorted(text.columns) == ["handle", "note", "user_id"]
    typed = typed_projection(text, USER_TABLE, missing=())
    assert sorted((r.user_id, r.handle, r.note) for r in typed.collect()) == [(1, "ann", None), (2, None, "x")]


def test_json_text_is_no_missing_value(spark, scratch):
    path = os.path.join(scratch, "page.json")
    with open(path, "w") as f:
        f.write('[{"user_id": 1, "handle": "NA"},\n {"user_id": 2, "handle": "N/A"},\n {"user_id": 3, "handle": ""},\n'
                ' {"user_id": 4, "handle": null}]')
    got = prepare(read_json_records(spark, path, ["user_id", "handle"], arrays=True), USER_TABLE)
    assert sorted((r.user_id, r.handle) for r in got.collect()) == [(1, "NA"), (2, "N/A"), (3, None), (4, None)]
    csv = spark.createDataFrame([("1", "NA")], "user_id string, handle string")
    assert prepare(csv, USER_TABLE, missing=NA_TOKENS).first().handle is None


def test_malformed_records_fail_the_read(spark, scratch):
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as f:
        f.write('{"user_id": 1}\n{"user_id": \n')
    with pytest.raises(Exception):
        read_json_records(spark, path, ["user_id"]).collect()
    path = os.path.join(scratch, "bad.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception):
        read_csv_text(spark, path).collect()


def test_preset_session_settings_survive(spark):
    from wellnote.session import get_spark
    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
    same = get_spark()
    assert (same.sparkContext.master, same.conf.get("spark.sql.shuffle.partitions")) == before


def test_publish_views(spark):
    from wellnote.plans.inputs import driver_note_tables, driver_well_tables
    from wellnote.plans.views import VIEW_NAMES, publish_views
    sf = "/root/testdata/sf0.001"
    counts = publish_views(driver_well_tables(spark, sf), driver_note_tables(spark, sf), "analytics_test",
                           year_a=1998, year_b=1999)
    assert list(counts) == VIEW_NAMES
    other = spark.newSession()
    for name in VIEW_NAMES:
        assert other.table(f"analytics_test.{name}").count() == counts[name] > 0


def test_register_views(spark):
    from wellnote.plans.inputs import driver_note_tables, driver_well_tables
    from wellnote.plans.views import VIEW_NAMES, register_views
    sf = "/root/testdata/sf0.001"
    assert os.path.isdir(sf)
    lazy = register_views(driver_well_tables(spark, sf), driver_note_tables(spark, sf), year_a=1998, year_b=1999)
    for name in VIEW_NAMES:
        assert spark.sql(f"select count(*) from {name}").collect()[0][0] > 0
    from wellnote.plans.views import build_views
    mat = build_views(driver_well_tables(spark, sf), driver_note_tables(spark, sf), materialize=True,
                      year_a=1998, year_b=1999)
    assert mat["daily_series"].count() == lazy["daily_series"].count()
    def rounded(df):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()),
                      key=repr)
    assert rounded(mat["well_summary"]) == rounded(lazy["well_summary"])   # sums differ only in order


def test_profile_loaded_tables(spark, scratch):
    from wellnote.sources.tables import profile_tables
    path = os.path.join(scratch, "routetb.csv")
    with open(path, "w") as f:
        f.write('routemerrickid,routename\n"2","Route 2"\n"1",""\n"3","R' + "x" * 150 + '"\n')
    load_all(spark, [TableSpec("routetb", lambda s: read_csv_text(s, path))], db="stg_prof")
    got = {(r.table, r.column_name): r.sample_value
           for r in profile_tables(spark, ["routetb"], "stg_prof", {"routetb": ["routemerrickid"]}).collect()}
    assert got == {("routetb", "routemerrickid"): "1", ("routetb", "routename"): "Route 2"}
