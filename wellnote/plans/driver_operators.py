"""Operator-level driver queries: each isolates one operator of the survey's
inventory over the driver tables, with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellnote.functions.text import except_chain, mentions
from wellnote.operators import aggs as A
from wellnote.operators import ingest as G
from wellnote.operators import joins as J
from wellnote.operators import windows as W
from wellnote.plans import notes as N
from wellnote.plans import oracle as O
from wellnote.plans import production as P
from wellnote.plans import spacing as SP
from wellnote.plans.driver import notes, register, wells
from wellnote.plans.inputs import LARGE_KEY, dx_landed_orders, dx_numbered_events, landed_answers
from wellnote.plans.oracle import rnd, with_ctes, with_note_ctes, with_spacing_ctes
from wellnote.schemas import EMPTY_TEXT, NA_TOKENS
from wellnote.session import ensure_checkpoint_dir, written_once

PL = O.PLACES


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- ingest ----

ORDERS_DECLARED = [("o_orderkey", T.LongType()), ("o_custkey", T.LongType()),
                   ("o_orderstatus", T.StringType()), ("o_totalprice", T.DoubleType()),
                   ("o_orderdate", T.TimestampNTZType()), ("o_orderpriority", T.StringType())]

_TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def _clean(c):
    return f"case when {c} in ({_TOKENS_SQL}) then null else {c} end"


def _exact_int(c):
    """Digits alone, or digits with a fraction of zeros; anything else is no integer."""
    return (f"case when regexp_full_match({c}, '-?[0-9]+(\\.0*)?') then cast(split_part({c}, '.', 1) as bigint) end")


ORDERS_TYPED_SQL = f"""select {_exact_int('o_orderkey')} as o_orderkey,
    {_exact_int('o_custkey')} as o_custkey, {_clean('o_orderstatus')} as o_orderstatus,
    try_cast({_clean('o_totalprice')} as double) as o_totalprice,
    try_cast({_clean('o_orderdate')} as timestamp) as o_orderdate,
    {_clean('o_orderpriority')} as o_orderpriority from dx_landed_orders"""


def typed_orders(spark, sf_dir):
    return G.typed_projection(dx_landed_orders(spark, sf_dir), declared=ORDERS_DECLARED)


@register("null_tokens", with_ctes(f"""select o_orderkey, {_clean('o_custkey')} as o_custkey,
    {_clean('o_orderstatus')} as o_orderstatus, {_clean('o_orderpriority')} as o_orderpriority
    from dx_landed_orders"""))
def q_null_tokens(spark, sf_dir):
    return (G.normalise_missing(dx_landed_orders(spark, sf_dir))
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@register("typed_projection", with_ctes(f"""select o_orderkey, o_custkey, o_orderstatus,
    round(o_totalprice, {PL}) as o_totalprice, o_orderdate, o_orderpriority
    from ({ORDERS_TYPED_SQL})"""))
def q_typed_projection(spark, sf_dir):
    return typed_orders(spark, sf_dir)


@register("dedupe_rows", with_ctes(f"""select distinct o_custkey, o_orderstatus, o_orderpriority
    from ({ORDERS_TYPED_SQL})"""))
def q_dedupe_rows(spark, sf_dir):
    return G.dedupe(typed_orders(spark, sf_dir).select("o_custkey", "o_orderstatus", "o_orderpriority"))


@register("duplicate_flag", with_ctes(f"""select o_custkey, o_orderstatus, o_orderpriority,
    count(*) over (partition by o_custkey, o_orderstatus, o_orderpriority) > 1 as duplicate_flag
    from ({ORDERS_TYPED_SQL})"""))
def q_duplicate_flag(spark, sf_dir):
    return G.with_duplicate_flag(
        typed_orders(spark, sf_dir).select("o_custkey", "o_orderstatus", "o_orderpriority"))


_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@register("column_profile", " union all ".join(
    f"""select '{c}' as column_name,
        substring(cast(first({c} order by doc_id) filter (where {c} is not null) as varchar), 1, 100)
        as sample_value from documents""" for c in _DOC_COLS))
def q_column_profile(spark, sf_dir):
    return G.column_profile(_read(spark, sf_dir, "documents"), "doc_id", 100, _DOC_COLS)


EVENTS_DECLARED = [("event_id", T.LongType()), ("ts", T.TimestampNTZType()),
                   ("user_id", T.LongType()), ("event_type", T.StringType()),
                   ("value", T.DoubleType()), ("props", T.StringType())]


@register("paged_source", f"""select event_id, ts, user_id, event_type, round(value, {PL}) as value,
    nullif(props, '') as props from events""")
def q_paged_source(spark, sf_dir):
    # The events as the answers of a paged interface, landed in the shared folder and decoded from there.
    from wellnote.sources.paged import records_of_responses
    names = [c for c, _ in EVENTS_DECLARED]
    answers = written_once(landed_answers(dx_numbered_events(spark, sf_dir).select(
        "place", *[F.col(c).cast("string").alias(c) for c in names]), "place"))
    return G.typed_projection(records_of_responses(answers, names), declared=EVENTS_DECLARED, missing=EMPTY_TEXT)


@register("json_records", """select user_id, event_type, case when event_id % 5 = 0 then 'NA' when event_id % 7 = 0
    then null else concat('N/A ', event_type) end as remark, cast(event_id + 9007199254740993 as bigint) as event_id
    from events""")
def q_json_records(spark, sf_dir):
    # Records of a JSON feed keep texts that a CSV read would take for missing values; the empty text is missing.
    from wellnote.sources.paged import read_json_records
    e = _read(spark, sf_dir, "events")
    eid = F.col("event_id")
    landed = e.select("user_id", "event_type", (eid + F.lit(LARGE_KEY)).alias("event_id"),
                      F.when(eid % 5 == 0, "NA").when(eid % 7 == 0, "")
                      .otherwise(F.concat(F.lit("N/A "), F.col("event_type"))).alias("remark"))
    path = _landing(spark)
    landed.write.json(path)
    text = read_json_records(spark, path, ["user_id", "event_type", "remark", "event_id"])
    return G.typed_projection(text, declared=[("user_id", T.LongType()), ("event_id", T.LongType())], missing=EMPTY_TEXT)


def _landing(spark):
    import uuid
    return f"{ensure_checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"


@register("csv_folder", with_ctes(f"""select o_orderkey, o_custkey, o_orderstatus,
    round(o_totalprice, {PL}) as o_totalprice, o_orderdate, o_orderpriority from ({ORDERS_TYPED_SQL})"""))
def q_csv_folder(spark, sf_dir):
    from wellnote.sources.csv_dir import read_csv_text
    path = _landing(spark)
    dx_landed_orders(spark, sf_dir).write.option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(path)
    return G.typed_projection(read_csv_text(spark, path), declared=ORDERS_DECLARED)


def _loaded(spark, sf_dir):
    """The load job over landed orders, an empty feed and a broken one, in a database of its own."""
    import uuid

    from wellnote.sources.tables import TableSpec, load_all
    db = f"wellnote_load_{uuid.uuid4().hex[:10]}"
    orders = dx_landed_orders(spark, sf_dir).select("o_custkey", "o_orderstatus", "o_orderpriority")

    def unreachable(_):
        raise OSError("the feed cannot be reached")

    specs = [TableSpec("orders", lambda s: orders, "dedupe", NA_TOKENS),
             TableSpec("orders", lambda s: orders.withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("2"))), "dedupe",
                       NA_TOKENS),
             TableSpec("flagged", lambda s: orders, "flag", NA_TOKENS),
             TableSpec("nothing", lambda s: orders.where("o_custkey is null")),
             TableSpec("broken", unreachable)]
    return db, load_all(spark, specs, db, parallel=1)


_LANDED_TEXT = f"""select {_clean('o_custkey')} as o_custkey, {_clean('o_orderstatus')} as o_orderstatus,
    {_clean('o_orderpriority')} as o_orderpriority, o_orderstatus as landed from dx_landed_orders"""


@register("load_report", with_ctes("""select 'orders' as "table", (select count(*) from (select distinct o_custkey,
      o_orderstatus, o_orderpriority from t)) as rows, 'loaded' as status, false as failed
    union all select 'orders', (select count(*) from (select distinct o_custkey, concat(landed, '2'), o_orderpriority
      from t)), 'loaded', false
    union all select 'flagged', (select count(*) from t), 'loaded', false
    union all select 'nothing', 0, 'skipped_empty', false
    union all select 'broken', null, 'failed', true""", {"t": _LANDED_TEXT}))
def q_load_report(spark, sf_dir):
    _, report = _loaded(spark, sf_dir)
    return report.select("table", "rows", "status", F.col("error").isNotNull().alias("failed"))


@register("staging_overwrite", with_ctes("""select distinct o_custkey, concat(landed, '2') as o_orderstatus, o_orderpriority
    from t""", {"t": _LANDED_TEXT}))
def q_staging_overwrite(spark, sf_dir):
    db, _ = _loaded(spark, sf_dir)
    return spark.table(f"{db}.orders")


@register("named_views", with_spacing_ctes("""select 'well_attributes' as view_name, count(*) as rows from well_attributes
    union all select 'daily_series', count(*) from daily_series
    union all select 'well_summary', count(*) from well_summary
    union all select 'well_spacing', count(*) from well_spacing
    union all select 'note_relationships', count(*) from note_relationships""",
    {k: O.DX[k] for k in ("dx_user", "dx_note")} | O.NOTE_VIEWS))
def q_named_views(spark, sf_dir):
    import uuid

    from wellnote.plans.views import VIEW_NAMES, publish_views
    namespace = f"analytics_{uuid.uuid4().hex[:10]}"
    publish_views(wells(spark, sf_dir), notes(spark, sf_dir), namespace, year_a=O.YEAR_A, year_b=O.YEAR_B)
    out = None
    for name in VIEW_NAMES:
        one = spark.table(f"{namespace}.{name}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("view_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


# ----------------------------------------------------------------- joins ----

@register("lookup_left", with_ctes("""select ct.merrickid, ar.areaname
    from dx_completion ct left join dx_area ar on ct.areaid = ar.areamerrickid"""))
def q_lookup_left(spark, sf_dir):
    w = wells(spark, sf_dir)
    return (w.completion.join(w.area, F.col("areaid") == F.col("areamerrickid"), "left")
            .select("merrickid", "areaname"))


@register("disjunctive_left", with_ctes("""select ct.merrickid, wvh.idwell, wvh.wellida
    from dx_completion ct left join dx_header wvh
      on ct.wellviewid = wvh.idwell or ct.apiwellnumber = wvh.wellida"""))
def q_disjunctive_left(spark, sf_dir):
    w = wells(spark, sf_dir)
    ct = w.completion.select("merrickid", "wellviewid", "apiwellnumber")
    hdr = w.header.select("idwell", "wellida")
    return (J.disjunctive_left_join(ct, hdr, [("wellviewid", "idwell"), ("apiwellnumber", "wellida")])
            .select("merrickid", "idwell", "wellida"))


@register("composite_left", with_ctes(f"""select d.merrickid, d.productiondate,
    round(c.oil, {PL}) as oil_capacity
    from dx_daily d left join dx_capacity c
      on concat('P', cast(d.merrickid as varchar)) = c.well_id and d.productiondate = c.cap_date"""))
def q_composite_left(spark, sf_dir):
    w = wells(spark, sf_dir)
    d = w.daily.select("merrickid", "productiondate",
                       F.concat(F.lit("P"), F.col("merrickid").cast("string")).alias("d_aries"))
    c = w.capacity.select(F.col("well_id").alias("c_well_id"), F.col("date").alias("c_date"),
                          F.col("oil").alias("oil_capacity"))
    return (d.join(c, (F.col("d_aries") == F.col("c_well_id"))
                   & (F.col("productiondate") == F.col("c_date")), "left")
            .select("merrickid", "productiondate", "oil_capacity"))


@register("band_join", with_ctes(f"""select j.idrec, d.merrickid, d.productiondate,
    round(d.oilproduction, {PL}) as oilproduction
    from dx_job j join dx_daily d on j.idwell = concat('W', cast(d.merrickid as varchar))
     and d.productiondate between cast(j.dttmstart as date) and cast(j.dttmend as date)"""))
def q_band_join(spark, sf_dir):
    w = wells(spark, sf_dir)
    d = w.daily.select("merrickid", "productiondate", "oilproduction",
                       F.concat(F.lit("W"), F.col("merrickid").cast("string")).alias("d_well"))
    jobs = w.job.select("idwell", "idrec", "dttmstart", "dttmend")
    j = J.band_join(d, jobs, [("d_well", "idwell")], "productiondate",
                    F.to_date("dttmstart"), F.to_date("dttmend"))
    return j.select("idrec", "merrickid", "productiondate", "oilproduction")


@register("forward_asof", with_note_ctes("""select note_id, tagged_user_id, tag_timestamp,
    response_timestamp from tag_responses"""))
def q_forward_asof(spark, sf_dir):
    return N.tag_responses(notes(spark, sf_dir)).select(
        "note_id", "tagged_user_id", "tag_timestamp", "response_timestamp")


@register("spatial_pairs", with_spacing_ctes(f"""select subject_well_id, offset_well_id,
    {rnd('distance_ft')}, {rnd('tvd_diff_ft')}, {rnd('azimuth_degrees')} from well_pairs"""))
def q_spatial_pairs(spark, sf_dir):
    return SP.well_pairs(wells(spark, sf_dir))


@register("lateral_mentions", with_note_ctes("""select note_id,
    unnest(regexp_extract_all(note_text, '@(\\w+)', 1)) as mention from spoken
    union all
    select doc_id, unnest(regexp_extract_all(text, '@([\\p{L}\\p{N}\\p{M}_]+)', 1)) from documents"""))
def q_lateral_mentions(spark, sf_dir):
    nb = N.note_base(notes(spark, sf_dir)).select("note_id", F.col("note_text").alias("t"))
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("note_id"), F.col("text").alias("t"))
    return nb.unionByName(docs).select("note_id", F.explode(mentions("t")).alias("mention"))


# ------------------------------------------------------------ aggregates ----

@register("filtered_avg", with_ctes(f"""select merrickid,
    round(avg(oilproduction) filter (where extract(year from productiondate) = {O.YEAR_A}), {PL}) as avg_oil
    from dx_daily group by merrickid"""))
def q_filtered_avg(spark, sf_dir):
    d = wells(spark, sf_dir).daily
    return d.groupBy("merrickid").agg(
        A.filtered_avg(F.col("oilproduction"), A.year_range("productiondate", O.YEAR_A)).alias("avg_oil"))


@register("top1_per_group", with_note_ctes("""select tagged_user_id, min(author_user_id) as top_tagger_user_id
    from (select tagged_user_id, author_user_id, count(*) as n from tag_rows group by all)
    join (select tagged_user_id, max(n) as n from (select tagged_user_id, count(*) as n from tag_rows
          group by tagged_user_id, author_user_id) group by tagged_user_id) using (tagged_user_id, n)
    group by tagged_user_id"""))
def q_top1_per_group(spark, sf_dir):
    tags = N.explicit_tags_table(notes(spark, sf_dir))
    return A.count_then_top1(tags, "tagged_user_id", "tagger_user_id", "top_tagger_user_id")


@register("direction_pivot", with_spacing_ctes(f"""select subject_well_id as well_id,
    any_value(near) filter (where side = 'East') as east_offset_well_id,
    {rnd("any_value(d) filter (where side = 'East')", "east_distance_ft")},
    any_value(near) filter (where side = 'West') as west_offset_well_id,
    {rnd("any_value(d) filter (where side = 'West')", "west_distance_ft")}
    from (select distinct on (subject_well_id, side) subject_well_id, offset_well_id as near, distance_ft as d,
            case when azimuth_degrees >= -90 and azimuth_degrees <= 90 then 'East' else 'West' end as side
          from well_pairs order by subject_well_id, side, distance_ft, offset_well_id)
    group by subject_well_id"""))
def q_direction_pivot(spark, sf_dir):
    pairs = SP.well_pairs(wells(spark, sf_dir))
    east = F.coalesce(F.col("azimuth_degrees").between(-90, 90), F.lit(False))
    ranked = pairs.withColumn("d", F.when(east, "East").otherwise("West"))
    return A.direction_pivot(ranked, "subject_well_id", "d", ["distance_ft", "offset_well_id"],
                             ["offset_well_id", "distance_ft"], ["East", "West"]).withColumnRenamed(
        "subject_well_id", "well_id")


def _sql_corr(x, y):
    xx = f"case when {x} is not null and {y} is not null then {x} end"
    yy = f"case when {x} is not null and {y} is not null then {y} end"
    den = f"(stddev_pop({xx}) * stddev_pop({yy}))"
    return f"covar_pop({xx}, {yy}) / case when {den} <> 0 then {den} end"


@register("safe_corr", f"""select l_returnflag, l_linestatus,
    round({_sql_corr('l_quantity', 'l_extendedprice')}, {PL}) as corr_qty_price,
    round({_sql_corr('l_discount', 'l_tax')}, {PL}) as corr_discount_tax,
    round({_sql_corr('l_quantity', 'case when l_quantity > 0 then 1.0 end')}, {PL}) as corr_constant
    from lineitem group by l_returnflag, l_linestatus""")
def q_safe_corr(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    const = F.when(F.col("l_quantity") > 0, F.lit(1.0))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        A.safe_corr(F.col("l_quantity"), F.col("l_extendedprice")).alias("corr_qty_price"),
        A.safe_corr(F.col("l_discount"), F.col("l_tax")).alias("corr_discount_tax"),
        A.safe_corr(F.col("l_quantity"), const).alias("corr_constant"))


@register("avg_response_seconds", with_note_ctes("""select tagged_user_id,
    cast(round(avg(epoch_us(response_timestamp) - epoch_us(tag_timestamp))) as bigint) as avg_response_us,
    count(*) as responses
    from tag_responses where response_timestamp is not null group by tagged_user_id"""))
def q_avg_response(spark, sf_dir):
    r = N.tag_responses(notes(spark, sf_dir)).where(F.col("response_timestamp").isNotNull())
    g = r.groupBy("tagged_user_id").agg(
        F.avg(F.col("response_timestamp") - F.col("tag_timestamp")).alias("iv"),
        F.count(F.lit(1)).alias("responses"))
    return g.select("tagged_user_id",
                    (F.col("iv").cast("interval second").cast("decimal(38,6)") * 1_000_000)
                    .cast("long").alias("avg_response_us"), "responses")


@register("ordered_line", with_spacing_ctes(f"""select well_id, row_number() over (
      partition by well_id, lat0, lon0 order by md nulls last, e, n, tvd) as place,
    {rnd('md')}, {rnd('e')}, {rnd('n')}, {rnd('tvd')}
    from sv_pts where incl > 80 and e is not null and n is not null and tvd is not null"""))
def q_ordered_line(spark, sf_dir):
    lines = SP.lateral_lines(wells(spark, sf_dir))
    return lines.select("well_id", F.posexplode("points").alias("place", "p")).select(
        "well_id", (F.col("place") + 1).cast("long").alias("place"), "p.md", "p.e", "p.n", "p.tvd")


# -------------------------------------------------------- windows, sets ----

@register("first_date_window", with_ctes("""select merrickid, productiondate,
    min(productiondate) over (partition by merrickid) as first_prod_date from dx_daily"""))
def q_first_date_window(spark, sf_dir):
    d = wells(spark, sf_dir).daily.select("merrickid", "productiondate")
    return W.group_min(d, ["merrickid"], "productiondate", "first_prod_date")


@register("row_number_nearest", with_spacing_ctes(f"""select subject_well_id, side as offset_direction,
    offset_well_id, {rnd('distance_ft')} from closest"""))
def q_row_number_nearest(spark, sf_dir):
    ranked = SP.ranked_neighbours(SP.well_pairs(wells(spark, sf_dir)))
    top = W.first_rank(ranked, ["subject_well_id", "offset_direction"],
                       [F.col("distance_ft").asc(), F.col("offset_well_id").asc()])
    return top.select("subject_well_id", "offset_direction", "offset_well_id", "distance_ft")


@register("running_participants", with_note_ctes("""select a.note_id, a.place as place,
    count(b.place) as n_earlier,
    ifnull(array_to_string(list_sort(list(distinct b.author_handle)), ','), '') as participants
    from spoken a left join spoken b on b.event_uuid is not distinct from a.event_uuid and b.place < a.place
    group by a.note_id, a.place"""))
def q_running_participants(spark, sf_dir):
    # The running list of the view holds all pairs of a conversation; its observable content is the
    # number of earlier notes and the set of earlier authors, computed without that list.
    nb = written_once(N.note_base(notes(spark, sf_dir)))
    counted = written_once(W.with_distinct_before(nb, "event_uuid", N.ORDER, "author_handle"))
    whole = W.with_running_count(nb.withColumn("__one", F.lit("all")), "__one", N.ORDER, "place")
    own = W.with_running_count(nb, "event_uuid", N.ORDER, "n_earlier")
    same = ["note_id", "event_uuid", "note_timestamp", "author_user_id", "author_handle", "note_text"]
    key = W.null_safe_key(*same)
    rows = written_once(counted.select("note_id", "__g", "__k", key.alias("__row"))
                        .join(whole.select(key.alias("__row"), (F.col("place") + 1).alias("place")), "__row")
                        .join(own.select(key.alias("__row"), "n_earlier"), "__row").drop("__row"))
    past = W.first_values(F.col("__values"), F.col("__k"), T.StringType())
    return W.with_value_lists(rows, counted, "author_handle", "__g", "__k").select(
        "note_id", "place", "n_earlier", F.array_join(F.sort_array(past), ",").alias("participants"))


@register("running_lists", with_note_ctes("""select note_id, note_timestamp, author_user_id,
    ifnull(array_to_string((select list(b.author_handle order by b.place) from spoken b
      where b.event_uuid is not distinct from a.event_uuid and b.place < a.place), ','), '') as earlier
    from spoken a"""))
def q_running_lists(spark, sf_dir):
    pointers, pieces = N.earlier_participants(notes(spark, sf_dir))
    lists = W.expanded_lists(pointers, written_once(pieces), "event_uuid", "earlier")
    return lists.select("note_id", "note_timestamp", "author_user_id", F.array_join("earlier", ",").alias("earlier"))


@register("array_except_chain", with_note_ctes("""select note_id, note_timestamp,
    array_to_string(list_sort(implicit_tagged_users), ',') as implicit_tagged_users
    from note_relationships"""))
def q_array_except_chain(spark, sf_dir):
    nb = written_once(N.note_base(notes(spark, sf_dir)))
    counted = written_once(W.with_distinct_before(nb, "event_uuid", N.ORDER, "author_handle"))
    rows = W.with_value_lists(written_once(N.relationship_rows(nb, counted)), counted, "author_handle", "h_g", "h_k")
    past = W.first_values(F.col("__values"), F.col("h_k"), T.StringType())
    return rows.select("note_id", "note_timestamp", F.array_join(
        except_chain(past, F.col("explicit_tagged_users"), F.array("author_handle")), ",")
        .alias("implicit_tagged_users"))


@register("union_directions", with_spacing_ctes(f"""select direction, round(avg(v), {PL}) as avg_spacing_ft
    from (select unnest(['East', 'West']) as direction, unnest([east_spacing_ft, west_spacing_ft]) as v
          from well_spacing) group by direction"""))
def q_union_directions(spark, sf_dir):
    # UNION ALL of two one-row aggregates over the same view, as one pass + stack
    ws = SP.well_spacing(wells(spark, sf_dir))
    a = ws.agg(F.avg("east_spacing_ft").alias("East"), F.avg("west_spacing_ft").alias("West"))
    return a.select(F.expr("stack(2, 'East', East, 'West', West) as (direction, avg_spacing_ft)"))


@register("top1_limit", f"""select o_custkey, round(sum(o_totalprice), {PL}) as total_value
    from orders group by o_custkey order by sum(o_totalprice) desc, o_custkey limit 1""")
def q_top1_limit(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    return (o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total_value"))
            .orderBy(F.col("total_value").desc(), F.col("o_custkey").asc()).limit(1))


# --------------------------------------------------------------- geometry ----

@register("line_project", with_spacing_ctes(f"""select well_id, seg_no, {rnd('lon_a')},
    {rnd('lat_a')}, {rnd('lon_b')}, {rnd('lat_b')} from sv_geo"""))
def q_line_project(spark, sf_dir):
    _, geo_seg = SP.trajectories(wells(spark, sf_dir))
    return geo_seg.select("well_id", F.col("seg_no").cast("long").alias("seg_no"),
                          "lon_a", "lat_a", "lon_b", "lat_b")


@register("line_centroid", with_spacing_ctes(f"""select well_id, {rnd('avg_lateral_tvd')},
    {rnd('cx')}, {rnd('cy')} from sv_traj"""))
def q_line_centroid(spark, sf_dir):
    traj, _ = SP.trajectories(wells(spark, sf_dir))
    return traj.select("well_id", "avg_lateral_tvd", "cx", "cy")


@register("line_distance", with_spacing_ctes(f"""select w1, w2, {rnd('d_m')} from sv_near
    where w1 < w2"""))
def q_line_distance(spark, sf_dir):
    _, geo_seg = SP.trajectories(wells(spark, sf_dir))
    return SP.near_pairs(geo_seg).select(F.col("well_id_1").alias("w1"),
                                         F.col("well_id_2").alias("w2"), "d_m")
