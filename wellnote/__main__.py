"""Command line: load landed data into staging, then compute the answers.

    python -m wellnote load --csv-dir DIR [--pages-dir DIR] [--db stg] [--flag-duplicates] [--buckets N] [--profile]
    python -m wellnote views [--db stg] [--namespace analytics] [--year-a 2022] [--year-b 2023]
    python -m wellnote answers [--db stg] [--out DIR] [--year-a 2022] [--year-b 2023] [--field "Field 1"]

``--pages-dir`` holds one folder per record table (named as in ``schemas.API_TABLES``)
with its landed JSON page files.  ``views`` creates the five derived views over staging as permanent views
of the catalog.  ``answers`` prints each answer whole, or writes
it as Parquet under ``--out`` (a shared folder on a cluster).
"""

from __future__ import annotations

import argparse
import os
import sys

from wellnote.schemas import API_TABLES


def load_specs(spark, csv_dir: str | None, pages_dir: str | None, mode: str):
    from wellnote.sources.tables import csv_specs, json_spec
    specs = csv_specs(spark, csv_dir, mode) if csv_dir else []
    for t in API_TABLES if pages_dir else ():
        path = f"{pages_dir.rstrip('/')}/{t}"
        if exists(spark, path):
            specs.append(json_spec(t, path, mode))
    return specs


def exists(spark, path: str) -> bool:
    """Whether any Hadoop file system path exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def show_all(df) -> None:
    """Print every row of a report, as it streams to the driver, and their number."""
    print(" | ".join(df.columns))
    n = 0
    for row in df.toLocalIterator():
        print(" | ".join("" if v is None else str(v) for v in row))
        n += 1
    print(f"({n} rows)")


def answers(spark, db: str, year_a: int, year_b: int, field: str, materialize: bool = False) -> dict:
    from wellnote.plans import notes as N
    from wellnote.plans import production as P
    from wellnote.plans import spacing as S
    from wellnote.plans.inputs import from_staging
    from wellnote.plans.views import build_views
    wells, notes = from_staging(spark, db)
    v = build_views(wells, notes, materialize=materialize, year_a=year_a, year_b=year_b)
    attrs, daily, ws = v["well_attributes"], v["daily_series"], v["well_spacing"]
    return {
        "field_production": P.field_production(wells, attrs, daily, field=field, year=year_a),
        "cleanout_losses": P.cleanout_losses(wells, attrs, daily),
        "county_spacing": S.county_spacing(wells, ws, attrs),
        "formation_dip": S.formation_dip(ws),
        "spacing_corr": S.spacing_corr(wells, ws, attrs, summary=v["well_summary"]),
        "top_conversation": N.top_conversation(notes),
        "user_summary": N.user_summary(notes),
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="wellnote")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--csv-dir")
    ld.add_argument("--pages-dir")
    ld.add_argument("--db", default="stg")
    ld.add_argument("--flag-duplicates", action="store_true")
    ld.add_argument("--buckets", type=int, default=0, help="deal notes, users, daily rows and completions into so many buckets")
    ld.add_argument("--profile", action="store_true", help="show a sample value per column")
    vw = sub.add_parser("views")
    vw.add_argument("--db", default="stg")
    vw.add_argument("--namespace", default="analytics")
    vw.add_argument("--year-a", type=int, default=2022)
    vw.add_argument("--year-b", type=int, default=2023)
    an = sub.add_parser("answers")
    an.add_argument("--db", default="stg")
    an.add_argument("--out")
    an.add_argument("--year-a", type=int, default=2022)
    an.add_argument("--year-b", type=int, default=2023)
    an.add_argument("--field", default="Field 1")
    an.add_argument("--materialize", action="store_true")
    args = ap.parse_args(argv)

    from wellnote.session import get_spark
    spark = get_spark()
    if args.cmd == "load":
        from wellnote.sources.tables import bucketed, load_all, profile_tables
        mode = "flag" if args.flag_duplicates else "dedupe"
        specs = load_specs(spark, args.csv_dir, args.pages_dir, mode)
        report = load_all(spark, bucketed(specs, args.buckets) if args.buckets else specs, args.db)
        show_all(report)
        if args.profile:
            loaded = [r.table for r in report.where("status = 'loaded'").select("table").collect()]
            show_all(profile_tables(spark, loaded, args.db))
        return 0
    if args.cmd == "views":
        from wellnote.plans.catalog_views import create_views
        for name in create_views(spark, args.db, args.namespace, args.year_a, args.year_b):
            print(f"{args.namespace}.{name}")
        return 0
    for name, df in answers(spark, args.db, args.year_a, args.year_b, args.field, args.materialize).items():
        if args.out:
            df.write.mode("overwrite").parquet(os.path.join(args.out, name))
        else:
            print(f"== {name}")
            show_all(df)
    return 0


if __name__ == "__main__":
    sys.exit(main())
