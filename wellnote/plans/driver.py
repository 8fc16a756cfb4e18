"""Registry of driver queries: Spark callables and their DuckDB oracles.

Every query reads the driver's test tables (through the ``dx_*`` mappings) over
whole tables — no row caps or id subsets.  Doubles are rounded to ``oracle.PLACES`` places on
both sides because distributed sums are order dependent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellnote.plans import oracle as O
from wellnote.plans import production as P
from wellnote.plans.inputs import driver_note_tables, driver_well_tables

QueryFn = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, places: int = O.PLACES) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields])


_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        _QUERIES[name] = lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all():
    # importing the modules registers their queries
    from wellnote.plans import driver_ingest, driver_operators, driver_queries  # noqa: F401


def wells(spark: SparkSession, sf_dir: str):
    return driver_well_tables(spark, sf_dir)


def notes(spark: SparkSession, sf_dir: str):
    return driver_note_tables(spark, sf_dir)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field production (Q1) on the driver tables."""
    w = wells(spark, sf_dir)
    return round_doubles(P.field_production(w, field=O.FIELD, year=O.YEAR_A))
