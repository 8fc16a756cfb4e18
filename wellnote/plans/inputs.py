"""Input bundles for the derived views.

``WellTables`` / ``NoteTables`` hold the staging tables the views read, with
the column names the analytics use.  They can come from the staging database
(``from_staging``) or — for the driver's correctness runs — from the TPC-H-like
test tables (``driver_well_tables`` / ``driver_note_tables``), mapped onto the
same shapes by the ``dx_*`` definitions shared with the DuckDB oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellnote.schemas import DECLARED, NOTE_TABLE, SURVEY_ANALYTIC_NAMES, USER_TABLE


@dataclass
class WellTables:
    completion: DataFrame   # merrickid, wellname, areaid, batteryid, apiwellnumber, ariesid, wellviewid
    area: DataFrame         # areamerrickid, areaname
    battery: DataFrame      # batterymerrickid, batteryname
    header: DataFrame       # idwell, wellida, fieldname, county, latitude, longitude
    prop: DataFrame         # propnum, apinum, nri
    daily: DataFrame        # merrickid, productiondate, dailydowntime, casingpressure, tubingpressure,
                            # chokesize, oilproduction, allocestgasvolmcf, waterproduction
    capacity: DataFrame     # well_id, date, oil, gas, water
    job: DataFrame          # idwell, idrec, dttmstart, dttmend, jobsubtyp
    survey: DataFrame       # well_id, measured_depth_ft, inclination_deg, easting_offset_ft,
                            # northing_offset_ft, tvd_offset_ft


@dataclass
class NoteTables:
    note: DataFrame         # note_id, event_uuid, user_id, note_timestamp, note_text
    user: DataFrame         # user_id, handle


def with_declared_columns(df: DataFrame, table: str) -> DataFrame:
    """Add declared columns a feed never delivered (e.g. always-NULL fields
    that record pages omit) as typed NULLs, so the views can read them."""
    for c, dtype in DECLARED.get(table, []):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(dtype))
    return df


def from_staging(spark: SparkSession, db: str = "stg") -> tuple[WellTables, NoteTables]:
    """Bundles over tables written by :func:`wellnote.sources.tables.load_all`."""
    t = lambda name: with_declared_columns(spark.table(f"{db}.{name}"), name)
    survey = t("wellview_surveypoint")
    for src, dst in SURVEY_ANALYTIC_NAMES.items():
        if src in survey.columns and dst not in survey.columns:
            survey = survey.withColumnRenamed(src, dst)
    wells = WellTables(
        completion=t("completiontb"), area=t("areatb"), battery=t("batterytb"),
        header=t("wellview_wellheader"), prop=t("ac_property"),
        daily=t("procount_completiondailytb"), capacity=t("aries_daily_capacities"),
        job=t("wellview_job"), survey=survey)
    notes = NoteTables(note=t(NOTE_TABLE), user=t(USER_TABLE))
    return wells, notes


# ---------------------------------------------------------------------------
# Driver inputs: the dx_* views over the TPC-H-like test tables.
# ---------------------------------------------------------------------------

def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def dx_completion(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("merrickid"), F.col("c_name").alias("wellname"),
        F.col("c_nationkey").alias("areaid"),
        (F.col("c_nationkey") % 5).cast("int").alias("batteryid"),
        F.when(k % 4 == 0, None).otherwise(F.concat(F.lit("W"), _s(k))).alias("wellviewid"),
        F.when(k % 3 == 0, None).otherwise(F.concat(F.lit("A"), _s(k))).alias("apiwellnumber"),
        F.when(k % 5 == 0, None).otherwise(F.concat(F.lit("P"), _s(k))).alias("ariesid"))


def dx_area(spark, sf_dir):
    # keys from 20 on are shifted, so that some completions find no area
    k = F.col("n_nationkey")
    return _read(spark, sf_dir, "nation").select(
        (k + F.when(k >= 20, 100).otherwise(0)).alias("areamerrickid"), F.col("n_name").alias("areaname"))


def dx_battery(spark, sf_dir):
    return _read(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("batterymerrickid"), F.col("r_name").alias("batteryname"))


def dx_header(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("W"), _s(k)).alias("idwell"),
        F.concat(F.lit("A"), _s(k + F.when(k % 7 == 0, 1).otherwise(0))).alias("wellida"),
        F.col("c_mktsegment").alias("fieldname"), F.col("n_name").alias("county"),
        (F.lit(31.5) + (k % 10) * F.lit(0.004)).alias("latitude"),
        (F.lit(-102.0) + F.floor(k / F.lit(10.0)) * F.lit(0.006)).alias("longitude"))


def dx_property(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(F.concat(F.lit("P"), _s(k)).alias("propnum"),
                    F.concat(F.lit("A"), _s(k)).alias("apinum"),
                    (F.lit(0.7) + (k % 20) / F.lit(100.0)).alias("nri"))


def dx_daily(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    nd = F.lit(None).cast("double")
    return o.select(
        F.col("o_custkey").alias("merrickid"),
        F.col("o_orderdate").cast("date").alias("productiondate"),
        (k % 24).cast("double").alias("dailydowntime"),
        nd.alias("casingpressure"), nd.alias("tubingpressure"), nd.alias("chokesize"),
        F.when(k % 11 == 0, None).otherwise(F.col("o_totalprice")).alias("oilproduction"),
        (F.col("o_totalprice") * F.lit(0.5)).alias("allocestgasvolmcf"),
        (k % 100).cast("double").alias("waterproduction"))


def dx_capacity(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    nd = F.lit(None).cast("double")
    # every fourth order belongs to a property of its own that no well has
    prefix = F.when(F.col("o_orderkey") % 4 == 0, "X").otherwise("P")
    return (o.groupBy(F.concat(prefix, _s("o_custkey")).alias("well_id"),
                      F.col("o_orderdate").cast("date").alias("date"))
            .agg((F.max("o_totalprice") * F.lit(1.1)).alias("oil"))
            .select("well_id", "date", "oil", nd.alias("gas"), nd.alias("water")))


def dx_job(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    o = _read(spark, sf_dir, "orders")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("W"), _s("o_custkey")).alias("idwell"),
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("idrec"),
        F.col("l_shipdate").alias("dttmstart"),
        # a few jobs are still open
        F.when((F.col("l_orderkey") % 1000 == 7) & (F.col("l_linenumber") == 1),
               F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("l_shipdate") + F.expr("INTERVAL 45 DAYS")).alias("dttmend"),
        F.when(F.col("l_returnflag") == "A", "Tubing Cleanout").otherwise("Other").alias("jobsubtyp"))


def dx_survey(spark, sf_dir):
    s = _read(spark, sf_dir, "supplier").select("s_suppkey")
    s = s.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(9))))
    k, i = F.col("s_suppkey"), F.col("i")
    return s.select(
        F.concat(F.lit("W"), _s(k)).alias("well_id"),
        (i * 1000).cast("double").alias("measured_depth_ft"),
        F.when(i >= 3, F.lit(88.0)).otherwise(F.lit(10.0)).alias("inclination_deg"),
        F.when(i >= 3, (i - 3) * 700 + (k * 37) % 300).otherwise(0).cast("double")
        .alias("easting_offset_ft"),
        ((k * 53) % 200 + i * (k % 7) * 5).cast("double").alias("northing_offset_ft"),
        (9000 + (k * 11) % 300).cast("double").alias("tvd_offset_ft"))


def dx_user(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    return (e.select("user_id").distinct()
            .select("user_id", F.concat(F.lit("u"), _s("user_id")).alias("handle")))


def dx_note(spark, sf_dir):
    """Events as notes: some ids stand for two notes, some notes have no id; the
    users mentioned follow from the author's id, so mentions reach all users."""
    e = _read(spark, sf_dir, "events")
    eid, user = F.col("event_id"), F.col("user_id")
    text = F.concat(
        F.lit("hey @u"), _s(user + 1 + eid % 3),
        F.when(eid % 3 == 0, F.concat(F.lit(" cc @U"), _s(user - 2))).otherwise(F.lit("")))
    return e.select(
        F.when(eid % 61 == 0, None).otherwise(eid - F.when(eid % 50 == 7, 1).otherwise(0)).alias("note_id"),
        F.concat(F.col("event_type"), F.lit("-"), _s(F.dayofmonth("ts"))).alias("event_uuid"),
        "user_id", F.col("ts").alias("note_timestamp"), text.alias("note_text"))


def driver_well_tables(spark: SparkSession, sf_dir: str) -> WellTables:
    return WellTables(
        completion=dx_completion(spark, sf_dir), area=dx_area(spark, sf_dir),
        battery=dx_battery(spark, sf_dir), header=dx_header(spark, sf_dir),
        prop=dx_property(spark, sf_dir), daily=dx_daily(spark, sf_dir),
        capacity=dx_capacity(spark, sf_dir), job=dx_job(spark, sf_dir),
        survey=dx_survey(spark, sf_dir))


def driver_note_tables(spark: SparkSession, sf_dir: str) -> NoteTables:
    return NoteTables(note=dx_note(spark, sf_dir), user=dx_user(spark, sf_dir))


# Above 2**53: doubles cannot tell such keys apart.
LARGE_KEY = 9007199254740993


def dx_landed_orders(spark, sf_dir):
    """Orders as a text feed would land them: 64-bit keys, integers sometimes
    written as ``123.0`` and some that are none, missing-value tokens in two text
    columns, everything text."""
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        _s(k + F.lit(LARGE_KEY)).alias("o_orderkey"),
        F.when(k % 89 == 0, F.concat(_s("o_custkey"), F.lit(".5")))
        .when(k % 2 == 0, F.concat(_s("o_custkey"), F.lit(".0"))).otherwise(_s("o_custkey"))
        .alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        _s("o_totalprice").alias("o_totalprice"), _s("o_orderdate").alias("o_orderdate"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("NA"))
        .when(k % 97 == 0, F.lit("null")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))


def dx_numbered_events(spark, sf_dir):
    """Events with their place in the feed (from 0, by event_id) for a paged interface."""
    e = _read(spark, sf_dir, "events")
    first = e.agg(F.min("event_id").alias("m")).first()["m"]
    return e.withColumn("place", F.col("event_id") - F.lit(first))


def landed_answers(records: DataFrame, order: str, page_size: int = 1000) -> DataFrame:
    """``records`` as the landed answers (offset, content_range, body) of the paged feeds.

    ``order`` numbers the records from 0 without gaps; bodies are JSON arrays of one page, and NULLs
    are keys that a record lacks.
    """
    total = records.agg(F.count(F.lit(1)).alias("total"))
    columns = [c for c in records.columns if c != order]
    page = F.floor(F.col(order) / page_size)
    pages = records.groupBy(page.alias("page")).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*columns).alias("r")))),
                              lambda x: x["r"])).alias("body"), F.count(F.lit(1)).alias("n"))
    offset = F.col("page") * page_size
    return pages.join(total).select(
        offset.alias("offset"),
        F.concat(offset.cast("string"), F.lit("-"), (offset + F.col("n") - 1).cast("string"), F.lit("/"),
                 F.col("total").cast("string")).alias("content_range"), "body")


def land_csv_files(records: DataFrame, header: str, directory: str, stem: str) -> None:
    """Lines of CSV text (column ``record``) as files ``stem_0.csv``, ``stem_1.csv``, ... of one folder, each
    with the header: as many as the records have partitions.  Any Hadoop file system."""
    spark = records.sparkSession
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    path = f"{directory}/_{stem}"
    records.select(F.when(first, F.concat(F.lit(header + "\n"), F.col("record"))).otherwise(F.col("record")).alias("record")) \
        .write.text(path)
    of = spark._jvm.org.apache.hadoop.fs.Path
    fs = of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in fs.listStatus(of(path)) if f.getPath().getName().startswith("part-"))
    for k, name in enumerate(names):
        fs.rename(of(f"{path}/{name}"), of(f"{directory}/{stem}_{k}.csv"))
