"""Declared staging schemas, header aliases and missing-value tokens.

A declared schema is an *override*, not a contract: declared columns that are
present get cast, undeclared columns get the type that their values have in
common, declared columns that are absent are ignored.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DoubleType()
B = T.BooleanType()
DT = T.DateType()
TS = T.TimestampNTZType()

# --- fixed values: staging table names, column names and types as the source
# --- systems declare them (every table also declares duplicate_flag boolean)
DECLARED: dict[str, list[tuple[str, T.DataType]]] = {
    "ac_property": [("propnum", S), ("allocid", I), ("propname", S), ("apinum", S), ("nri", D)],
    "completiontb": [
        ("merrickid", I), ("wellname", S), ("completiontype", I), ("producingstatus", I),
        ("producingmethod", I), ("apiwellnumber", S), ("routeid", I), ("groupid", I),
        ("divisionid", I), ("fieldgroupid", I), ("areaid", I), ("batteryid", I), ("stateid", I),
        ("countyid", I), ("ariesid", S), ("wellviewid", S), ("activeflag", I),
        ("mmsapiwellnumber", S),
    ],
    "areatb": [("areamerrickid", I), ("areaname", S)],
    "batterytb": [("batterymerrickid", I), ("batteryname", S)],
    "divisiontb": [("divisionmerrickid", I), ("divisionname", S)],
    "fieldgrouptb": [("fieldgroupmerrickid", I), ("fieldgroupname", S)],
    "producingmethodstb": [("producingmethodmerrickid", I), ("producingmethodname", S)],
    "producingstatustb": [("producingstatusmerrickid", I), ("producingstatusname", S)],
    "routetb": [("routemerrickid", I), ("routename", S)],
    "statecountynamestb": [("statecode", I), ("countycode", I), ("countyname", S)],
    "aries_daily_capacities": [("well_id", S), ("date", DT), ("oil", D), ("gas", D), ("water", D)],
    "procount_completiondailytb": [
        ("merrickid", I), ("recorddate", DT), ("productiondate", DT), ("producingmethod", I),
        ("dailydowntime", D), ("allocestoilvol", D), ("oilproduction", D),
        ("allocestgasvolmcf", D), ("allocestinjgasvolmcf", D), ("allocestwatervol", D),
        ("waterproduction", D), ("chokesize", D), ("casingpressure", D), ("tubingpressure", D),
    ],
    "wellview_job": [
        ("idwell", S), ("idrec", S), ("dttmend", TS), ("dttmstart", TS), ("jobsubtyp", S),
        ("jobtyp", S), ("status1", S), ("status2", S), ("targetform", S), ("usertxt1", S),
        ("wvtyp", S),
    ],
    "wellview_jobreport": [
        ("idwell", S), ("idrecparent", S), ("idrec", S), ("condhole", S), ("condlease", S),
        ("condroad", S), ("condwave", S), ("condweather", S), ("condwind", S),
        ("depthtvdendprojmethod", S), ("dttmend", TS), ("dttmstart", TS), ("rigtime", D),
    ],
    "wellview_surveypoint": [
        ("well_id", S), ("measured_depth_ft", D), ("inclination", D), ("azimuth", D),
        ("tvd", D), ("easting", D), ("northing", D),
    ],
    "wellview_wellheader": [
        ("idwell", S), ("area", S), ("basin", S), ("basincode", I), ("country", S), ("county", S),
        ("currentwellstatus1", S), ("district", S), ("dttmfirstprod", TS), ("dttmspud", TS),
        ("fieldname", S), ("fieldoffice", S), ("latitude", D), ("latlongdatum", S), ("lease", S),
        ("longitude", D), ("operated", I), ("operator", S), ("padname", S), ("stateprov", S),
        ("wellconfig", S), ("wellida", S), ("spuddate", DT), ("wellname", S),
    ],
    "eia_oil_price": [("period", DT), ("value", D)],
    "wiserock_note": [
        ("id", S), ("event_type", S), ("event_id", L), ("user_id", I), ("user_overwrite", S),
        ("note_timestamp", TS), ("note_text", S), ("is_edited", B), ("event_uuid", S),
        ("note_id", S),
    ],
    "wiserock_user": [("user_id", I), ("handle", S)],
}

# --- fixed values: names found in the data or the SQL that differ from the
# --- declaration (actual name -> declared name)
HEADER_ALIASES: dict[str, dict[str, str]] = {
    "producingmethodstb": {
        "producingmethodsmerrickid": "producingmethodmerrickid",
        "producingmethodsdescription": "producingmethodname",
    },
    "producingstatustb": {"producingdescription": "producingstatusname"},
}

# The survey feed delivers easting/northing/tvd/inclination; the analytics read
# them under these names (declared name -> analytic name).
SURVEY_ANALYTIC_NAMES = {
    "easting": "easting_offset_ft",
    "northing": "northing_offset_ft",
    "tvd": "tvd_offset_ft",
    "inclination": "inclination_deg",
}

# --- fixed values: text that a pandas CSV read treats as missing, plus the
# --- strings a stringified NaN/NaT/None leaves behind
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "NaT",
]

# --- fixed value: the one text that the load of a JSON feed turns into NULL
EMPTY_TEXT = [""]

# Columns by which large staging tables are dealt and sorted where asked for: the keys of their first joins.
BUCKETED = {
    "wiserock_note": ["user_id"], "wiserock_user": ["user_id"], "procount_completiondailytb": ["merrickid"],
    "completiontb": ["merrickid"],
}

# The note and user feeds (staging table names, fixed values).
NOTE_TABLE = "wiserock_note"
USER_TABLE = "wiserock_user"

# CSV/JSON page feeds of the source systems (table names as landed).
API_TABLES = [
    "aries_daily_capacities", "procount_completiondailytb", "wellview_job",
    "wellview_jobreport", "wellview_surveypoint", "wellview_wellheader", "eia_oil_price",
    "wiserock_note", "wiserock_user",
]


def declared_struct(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, t in DECLARED.get(table, [])])
