"""Paged record sources.

The page protocol is the one of the source systems: a total record count in the first answer, then
pages of ``page_size`` records by offset.  Without a total the one page is the whole feed.

Two ways in, with one decoder:

* :func:`read_pages` — a Python data source with one input partition per range of pages, so pages are
  fetched by the executors.  ``fetcher`` is a class whose constructor takes the options as texts
  and which offers ``total() -> int | None``, ``columns() -> list[str]`` and
  ``fetch(offset, limit) -> list[dict]`` (an HTTP client, say).  Pages become Arrow batches of text.
* :func:`records_of_responses` — answers landed as rows (offset, content_range, body), on any file
  system Spark reads: bodies are decoded by Spark, and pages that are missing are found.

A page that is missing or empty inside the announced range is an error in both, never a shorter feed.
Typing happens afterwards by name (:func:`wellnote.operators.ingest.typed_projection`).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from wellnote.operators.ingest import BOOLEAN, TEXT, kind_of_text, type_of_kinds
from wellnote.session import written_once

SOURCE_NAME = "paged_records"
# --- fixed value: records per page of the source systems' REST interface
DEFAULT_PAGE_SIZE = 1000


class MissingPages(Exception):
    """Announced records that no page delivered."""


def _options(options: dict) -> dict:
    return {k[len("fetcher."):]: v for k, v in options.items() if k.startswith("fetcher.")}


class PageRange(InputPartition):
    def __init__(self, first_offset: int, last_offset: int | None, page_size: int):
        super().__init__((first_offset, last_offset))
        self.first_offset, self.last_offset, self.page_size = first_offset, last_offset, page_size


def _text(v) -> str | None:
    if v is None or isinstance(v, float) and v != v:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


class PagedReader(DataSourceReader):
    def __init__(self, fetcher: type, options: dict, schema: T.StructType):
        self.fetcher, self.options = fetcher, dict(options)
        self.columns = [f.name for f in schema.fields]

    def partitions(self):
        total = self.fetcher(**_options(self.options)).total()
        size = int(self.options.get("page_size", DEFAULT_PAGE_SIZE))
        if total is None:
            return [PageRange(0, None, size)]
        step = size * int(self.options.get("pages_per_partition", 64))
        return [PageRange(o, min(o + step, total), size) for o in range(0, total, step)]

    def read(self, partition: PageRange) -> Iterator:
        import pyarrow as pa
        fetcher = self.fetcher(**_options(self.options))
        schema = pa.schema([(c, pa.string()) for c in self.columns])

        def batch(records: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([_text(r.get(c)) for r in records], pa.string()) for c in self.columns], schema=schema)

        if partition.last_offset is None:
            yield batch(fetcher.fetch(0, partition.page_size))
            return
        offset = partition.first_offset
        while offset < partition.last_offset:
            records = fetcher.fetch(offset, min(partition.page_size, partition.last_offset - offset))
            if not records:
                raise MissingPages(f"empty page at offset {offset}; records up to {partition.last_offset} announced")
            yield batch(records)
            offset += len(records)


class PagedRecordsSource(DataSource):
    fetcher: type

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> T.StructType:
        names = self.fetcher(**_options(self.options)).columns()
        return T.StructType([T.StructField(c, T.StringType(), True) for c in names])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(self.fetcher, self.options, schema)


def read_pages(spark: SparkSession, fetcher: type, page_size: int = DEFAULT_PAGE_SIZE,
               pages_per_partition: int = 64, **options: str) -> DataFrame:
    """Read all pages of a record source as a text DataFrame.

    This module and the fetcher's are shipped to the Python workers by value, so
    executors need no installed copy of them.  A page that cannot be fetched
    fails the read.
    """
    from pyspark import cloudpickle
    for module in {__name__, fetcher.__module__}:
        cloudpickle.register_pickle_by_value(sys.modules[module])
    spark.dataSource.register(type("Paged" + fetcher.__name__, (PagedRecordsSource,), {"fetcher": fetcher}))
    r = (spark.read.format(SOURCE_NAME).option("page_size", page_size)
         .option("pages_per_partition", pages_per_partition))
    for k, v in options.items():
        r = r.option(f"fetcher.{k}", v)
    return r.load()


def _decoded(responses: DataFrame) -> DataFrame:
    """(offset, content_range, bad, records), stored: every answer decoded once.  A record is the texts of its
    values by key, and the kinds of these values (:mod:`wellnote.operators.ingest`)."""
    texts = F.from_json("body", T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    values = F.from_json("body", "array<map<string,variant>>")
    number = lambda text: F.coalesce(kind_of_text(text), F.lit(TEXT))
    kind = lambda value, text: F.when(F.schema_of_variant(value) == "VOID", F.lit(0)).when(
        F.schema_of_variant(value) == "BOOLEAN", F.lit(BOOLEAN)).when(
        F.rlike(F.schema_of_variant(value), F.lit("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")), number(text)).otherwise(TEXT)
    record = F.transform(F.arrays_zip("texts", "values"), lambda r: F.struct(
        r["texts"].alias("texts"),
        F.map_from_entries(F.transform(F.map_entries(r["values"]), lambda e: F.struct(
            e["key"].alias("key"), kind(e["value"], F.try_element_at(r["texts"], e["key"])).alias("kind")))).alias("kinds")))
    both = responses.select("offset", "content_range", texts.alias("texts"), values.alias("values"))
    return written_once(both.select("offset", "content_range", F.col("texts").isNull().alias("bad"), record.alias("records")))


def _check_pages(decoded: DataFrame) -> None:
    """Raises unless the pages lie end to end from the first record to the announced total."""
    told = F.regexp_extract("content_range", r"/(\d+)", 1)
    # Answers of one offset are the same page asked for again.
    pages = decoded.groupBy("offset").agg(
        F.max(F.when(told != "", told.cast("long"))).alias("total"),
        F.max(F.coalesce(F.size("records"), F.lit(0))).alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad"))
    pages = written_once(pages)
    found = pages.agg(F.max("total").alias("total"), F.sum("bad").alias("bad"), F.min("offset").alias("first")).first()
    total = found["total"]
    if found["bad"]:
        raise MissingPages(f"{found['bad']} unreadable answers")
    if total is None:
        return
    # Every page ends where another begins, or at the total; with a first page none is missing then.
    ends = pages.where(F.col("offset") < total).select((F.col("offset") + F.col("n")).alias("end"), "offset", "n")
    loose = ends.where(F.col("end") != total).join(pages.where("n > 0").select(F.col("offset").alias("begin")),
                                                   F.col("end") == F.col("begin"), "left_anti")
    lost = loose.unionByName(ends.where("n = 0")).agg(F.min("end").alias("end"), F.count(F.lit(1)).alias("n")).first()
    if lost["n"] or (total > 0 and found["first"] != 0):
        at = lost["end"] if lost["n"] else 0
        raise MissingPages(f"records from {at} on did not come with the answers; {total} announced")


def keys_of_records(decoded: DataFrame) -> DataFrame:
    """(key, kinds): the union of all records' keys in the order in which they first come, with the kinds of
    their values.  One aggregate, combined in every task."""
    rows = decoded.select("offset", F.posexplode("records").alias("at", "r"))
    keys = rows.select("offset", "at", F.posexplode(F.map_keys("r.kinds")).alias("nth", "key"), F.col("r.kinds").alias("k"))
    return keys.groupBy("key").agg(F.min(F.struct("offset", "at", "nth")).alias("first"),
                                   F.bit_or(F.try_element_at("k", F.col("key"))).alias("kinds")) \
        .orderBy("first").select("key", "kinds")


def records_and_types(responses: DataFrame, columns: Sequence[str] | None = None,
                      places: bool = False) -> tuple[DataFrame, dict[str, T.DataType]]:
    """:func:`records_of_responses` and the type of each column: that of its JSON values, where text
    stays text whatever it looks like; a column of NULLs alone is text.  With ``places`` the records also
    have ``__offset`` and ``__at``, their page and place in it: the order in which they were delivered."""
    decoded = _decoded(responses)
    _check_pages(decoded)
    types = {r["key"]: type_of_kinds(r["kinds"], T.StringType()) for r in keys_of_records(decoded).collect()}
    names = list(columns) if columns is not None else list(types)
    rows = decoded.select(F.col("offset").alias("__offset"), F.posexplode("records").alias("__at", "r"))
    return rows.select(*[F.try_element_at("r.texts", F.lit(c)).alias(c) for c in names],
                       *(["__offset", "__at"] if places else [])), types


def records_of_responses(responses: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The records of landed answers (offset, content_range, body) as text columns: those
    named, or the union of all records' keys.

    A key missing from a record is NULL, every value is kept as its text.  Raises
    :class:`MissingPages` when announced records did not come, or a body is
    no JSON array; an answer without a total is one page and the whole feed.
    A page that landed twice is counted once and gives its records twice (the
    load removes full duplicates).  The answers are decoded once, into the shared folder, when this is called.
    """
    if columns is None:
        return records_and_types(responses)[0]
    decoded = _decoded(responses)
    _check_pages(decoded)
    rows = decoded.select(F.explode("records").alias("r"))
    return rows.select(*[F.try_element_at("r.texts", F.lit(c)).alias(c) for c in columns])


def json_types(spark: SparkSession, path: str, arrays: bool = False) -> dict[str, T.DataType]:
    """Keys of landed record files and the types of their values: truth values, integers and
    doubles; anything else, also mixed kinds and integers over 64 bits, is text."""
    found = spark.read.option("multiLine", arrays).option("mode", "FAILFAST").json(path).schema
    plain = (T.BooleanType, T.LongType, T.DoubleType)
    return {f.name: f.dataType if isinstance(f.dataType, plain) else T.StringType() for f in found.fields}


def read_json_records(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                      arrays: bool = False) -> DataFrame:
    """Landed record files as text columns: a missing key is NULL, every value is
    read as its text (so ``1.0`` in an integer column and zoned timestamps survive
    until the typed projection).

    Files hold one record a line, or with ``arrays`` one JSON array that may span
    lines (one task per file).  With ``columns`` the keys are given; without, they
    are found by reading all files once more.  A malformed record fails the read.
    """
    r = spark.read.option("primitivesAsString", True).option("multiLine", arrays).option("mode", "FAILFAST")
    if columns is not None:
        r = r.schema(T.StructType([T.StructField(c, T.StringType(), True) for c in columns]))
    return r.json(path)
