"""CSV folder source: every ``*.csv`` file is one table named after its stem.

Files are read by Spark as text with their header (quoted values, doubled
quotes as escapes) and typed by column name
afterwards (:func:`wellnote.operators.ingest.typed_projection`) — never by
position, so a file whose header differs from the declaration cannot be
mis-bound silently.

A row with fewer values than the header is filled with NULL, one with more
fails the read.  Quoted values may hold line breaks; such files are still read
in splits (:func:`whole_records`).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellnote.session import written_once

_FORMAT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__odd"}


def read_csv_text(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """One CSV file (or folder of parts, each with the header) with every column as text.

    A large file is read in splits.  ``line_breaks`` allows quoted line breaks inside values;
    the lines are then written once to the shared folder, as they are looked at twice, and so are the records.
    """
    columns = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, "__odd"])
    if line_breaks:
        # A load reads a table several times: the records are dealt and put together once.
        # What is asked of them is asked afterwards: below the join it would keep its two readers from sharing a shuffle.
        rows = written_once(whole_records(spark, path).select("number", "record")).where("trim(record) <> ''") \
            .select("number", F.from_csv("record", schema, _FORMAT).alias("r")).select("number", "r.*")
        named = F.lit(True)
        for c in columns:
            named = named & F.col(f"`{c}`").eqNullSafe(F.lit(c))
        # Empty or repeated names of a header are changed by Spark: those are not compared.
        given = F.lit(not any(c.startswith("_c") or c.endswith(str(k)) for k, c in enumerate(columns)))
        body = F.when((F.col("number") == 0) & given & ~named, F.raise_error(
            F.lit("parts of one table differ in their headers")).cast("boolean")).otherwise(F.col("number") > 0)
        # The checks look at the number too, so that no plan asks them of a part of a record.
        checked = F.when(F.col("number") > 0, _no_surplus(F.col("__odd"), len(columns))).otherwise(F.lit(False))
        rows = rows.where(body).where(checked)
    else:
        rows = spark.read.options(header=True, enforceSchema=False, columnPruning=False, **_FORMAT) \
            .schema(schema).csv(path)
        # Spark reads no file for the odd records alone: a count asks for a column beside them.
        beside = F.coalesce(F.length(f"`{columns[0]}`"), F.lit(0)) >= 0
        rows = rows.where(_no_surplus(F.when(beside, F.col("__odd")), len(columns)))
    return rows.select(*[f"`{c}`" for c in columns])


def _no_surplus(odd: Column, columns: int) -> Column:
    """True; fails on a record with more values than the header has.  ``odd`` holds the
    records whose number of values differs."""
    bare = F.regexp_replace(odd, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1 > columns
    return F.when(F.coalesce(surplus, F.lit(False)), F.raise_error(F.concat(
        F.lit(f"more than {columns} values: "), F.substring(odd, 1, 200))).cast("boolean")).otherwise(F.lit(True))


# A line leaves the reader outside (0) or inside (1) of a quoted value, depending on where it found
# him: two bits.  Bits of consecutive lines compose, so the state before every line follows from
# running totals inside a split and one row per split.

def _open_after(line: Column) -> Column:
    """1 where a line begun outside of quotes ends inside a quoted value, else 0."""
    bare = F.regexp_replace(line, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.when(F.rlike(bare, F.lit(r'(^|,)"')), 1).otherwise(0)


def _still_open_after(line: Column) -> Column:
    """The same for a line begun inside a quoted value."""
    rest = F.regexp_replace(line, r'^[^"]*+(?:""[^"]*+)*+"', "x")
    closes = F.rlike(line, F.lit(r'^[^"]*+(?:""[^"]*+)*+"'))
    return F.when(closes, _open_after(rest)).otherwise(1)


def _state_before(window, start: Column | int) -> Column:
    """The state before each row: the last constant row's (``outside`` = ``inside``), turned by the
    swaps since, or else ``start`` turned by all swaps."""
    swap = F.when((F.col("outside") == 1) & (F.col("inside") == 0), 1).otherwise(0)
    swaps = F.coalesce(F.sum(swap).over(window), F.lit(0))
    seen = F.last(F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").alias("to"), F.col("turns").alias("at"))),
                  ignorenulls=True).over(window)
    begin = start if isinstance(start, Column) else F.lit(start)
    return F.when(seen.isNotNull(), F.pmod(seen["to"] + swaps - seen["at"], F.lit(2))) \
        .otherwise(F.pmod(begin + swaps, F.lit(2))).cast("int")


def _with_turns(rows: DataFrame, window) -> DataFrame:
    """``turns``: the swaps up to and with each row."""
    swap = F.when((F.col("outside") == 1) & (F.col("inside") == 0), 1).otherwise(0)
    return rows.withColumn("turns", F.sum(swap).over(window.rowsBetween(Window.unboundedPreceding, 0)))


def whole_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, record): the records of CSV files with their number in the file, 0 the header;
    a record whose quoted values hold line breaks is one text.

    Lines are read in splits.  A quoted value that runs over a split's end is followed by the state in
    which each split leaves its reader, one row per split.  Only lines of records of several lines
    are dealt by record; the others stay where they are.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    line = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.monotonically_increasing_id().alias("at"), "value")
    quoted = F.contains(F.col("value"), F.lit('"'))
    lines = written_once(line.select(
        "file", "split", "at", "value", F.when(quoted, _open_after(F.col("value"))).otherwise(0).alias("outside"),
        F.when(quoted, _still_open_after(F.col("value"))).otherwise(1).alias("inside")))
    inside_split = Window.partitionBy("file", "split").orderBy("at")
    before = inside_split.rowsBetween(Window.unboundedPreceding, -1)
    told = _with_turns(lines.select("file", "split", "at", "outside", "inside"), inside_split) \
        .withColumn("s0", _state_before(before, 0)).withColumn("s1", _state_before(before, 1)).drop("turns")
    after = lambda s: F.when(F.col(s) == 0, F.col("outside")).otherwise(F.col("inside"))
    ends = told.groupBy("file", "split").agg(
        F.max_by(after("s0"), "at").alias("outside"), F.max_by(after("s1"), "at").alias("inside"),
        F.sum(1 - F.col("s0")).alias("n0"), F.sum(1 - F.col("s1")).alias("n1"))
    along = Window.partitionBy("file").orderBy("split")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    starts = _with_turns(ends, along).withColumn("start", _state_before(earlier, 0)).withColumn(
        "records", F.when(F.col("start") == 0, F.col("n0")).otherwise(F.col("n1"))).select(
        "file", "split", "start", F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("earlier"))
    starts = written_once(starts)
    state = F.when(F.col("start") == 0, F.col("s0")).otherwise(F.col("s1"))
    placed = told.join(starts, ["file", "split"]).withColumn("state", state).withColumn(
        "leaves", F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside")))
    begun = F.sum(1 - F.col("state")).over(inside_split.rowsBetween(Window.unboundedPreceding, 0))
    numbered = placed.select("file", "split", "at", (F.col("state") + F.col("leaves") > 0).alias("part"),
                             (F.col("earlier") + begun - 1).alias("number"))
    rows = lines.select("file", "split", "at", "value").join(numbered, ["file", "split", "at"])
    ending = lambda c: F.regexp_replace(c, r"\r$", "")
    single = rows.where("not part").select("file", "number", ending(F.col("value")).alias("record"))
    # A record has no more lines than its values have line breaks.
    glued = rows.where("part").groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("lines")) \
        .select("file", "number", ending(F.array_join(F.col("lines.value"), "\n")).alias("record"))
    return single.unionByName(glued)


def list_csv_files(spark: SparkSession, directory: str) -> list[str]:
    """Paths of the ``*.csv`` files in a folder on any Hadoop file system.

    Only the file listing reaches the driver (``binaryFile`` with just the
    ``path`` column prunes the content).
    """
    rows = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", False).load(directory).select("path").collect())
    return sorted(r.path for r in rows)


def table_name(path: str) -> str:
    return os.path.splitext(os.path.basename(path.rstrip("/")))[0]
