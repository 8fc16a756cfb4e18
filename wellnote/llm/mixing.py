"""Mixing sources to target weights by capped water-filling.

All sources together keep their total size, shared by weight; a source that would be repeated
more than ``MAX_EPOCHS`` times is clamped there, and the excess is shared again among the others
by weight until none is above.  A source then takes every document ``floor(target / size)`` times
and a seeded part of its documents once more: in the order of a seeded hash, as long as the
running size stays below the rest of the target, and the one across it if that comes nearer.

The running sizes come from sums per hash range, then rows inside a range, so no task orders a
whole source.  Built-in functions only.

Defined results: a null text has size 0; a null source is a source of its own, last; a source
without words has target 0; an empty table gives no rows; repeated rows count as often as they stand.
A row without words is taken as often as a row at its place in the order; all those of a source without words once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wellnote.llm.common import cut

MAX_EPOCHS = 3
SEED = "mix-1"
#: Hash ranges per source; a range of a source is the largest group ordered by one task.
RANGES = 4096
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``rank`` (from 0) of each source by code point, null last; sources may be many.

    Sorted by ranges; the ranks inside a sorted part start after the counts of the parts before it.
    """
    order = F.asc_nulls_last("source")
    parts = cut(sizes.repartitionByRange(order).sortWithinPartitions(order)
                .withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    counts = parts.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row for each partition of the sort.
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return parts.withColumn("_part", part).join(starts, "_part") \
        .withColumn("rank", F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))) \
        .drop("_part", "_id", "_start")


def water_filling(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``target`` of each source from ``source_size`` and ``weight``: clamp, share again, until feasible.

    Each round is one aggregate over the sources that brings one row to the driver.
    """
    total = sources.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    share, free = F.lit(0.0), F.lit(True)
    level = None
    while True:
        clamped = F.lit(False) if level is None else \
            F.lit(max_epochs) * F.col("source_size") < F.lit(level) * F.col("weight")
        row = sources.agg(F.sum(F.when(clamped, F.col("source_size"))).alias("s"),
                          F.sum(F.when(~clamped, F.col("weight"))).alias("w")).first()
        if not row["w"]:
            break
        found = (total - max_epochs * (row["s"] or 0)) / row["w"]
        if level is not None and found <= level:
            break
        level = found
    level = F.lit(0.0 if level is None else float(level))
    return sources.withColumn("target", F.least(
        (F.lit(max_epochs) * F.col("source_size")).cast("double"), level * F.col("weight")))


def _key(source: str = "source") -> Column:
    """Null-safe join key."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def with_repetitions(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
                     weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS,
                     seed: str = SEED, ranges: int = RANGES, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with size, source_size, target and repetitions (0 and up).

    Sources by code point weigh ``weights`` in turn.  Columns of the names made are replaced.
    """
    made = ("size", "source_size", "target", "repetitions")
    seeded = F.md5(F.concat_ws("\x1f", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                               F.coalesce(F.substring(F.md5(F.col(text)), 1, 8), F.lit(""))))
    sized = docs.select(
        F.struct(*[F.col(c) for c in keep or docs.columns if c not in made]).alias("row"),
        F.col(source).alias("source"), _key(source).alias("key"), n_words(text).alias("size"),
        F.conv(F.substring(seeded, 1, 13), 16, 10).cast("long").alias("hash")) \
        .withColumn("range", F.shiftright("hash", 52 - (ranges.bit_length() - 1)).cast("int"))
    sums = cut(sized.groupBy("source", "key", "range").agg(F.sum("size").alias("range_size")))
    by_source = sums.groupBy("source", "key").agg(F.sum("range_size").alias("source_size"))
    ranked = ranked_sources(by_source)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = cut(water_filling(ranked.withColumn("weight", turn), max_epochs)
                 .withColumn("whole", F.when(F.col("source_size") > 0,
                                             F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
                 .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
                 .select("key", "source_size", "target", "whole", "rest"))
    before = W.partitionBy("key").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("range_size").over(before), F.lit(0))) \
        .drop("source").join(filled, "key")
    placed = sized.drop("source").join(starts, ["key", "range"])
    running = F.sum("size").over(W.partitionBy("key", "range").orderBy("hash", "size")
                                 .rowsBetween(W.unboundedPreceding, -1))
    at = F.col("start") + F.coalesce("running", F.lit(0))
    once_more = (at + F.col("size") / 2 <= F.col("rest")).cast("long")
    return placed.withColumn("running", running).select(
        "row.*", "size", "source_size", "target",
        F.least(F.lit(max_epochs), F.col("whole") + once_more).cast("long").alias("repetitions"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is taken, with its own columns."""
    names = {k: options.get(k, k) for k in ("text", "doc_id", "source")}
    whole = docs.select(F.struct("*").alias("whole_row"), *[F.col(v).alias(k) for k, v in names.items()])
    taken = with_repetitions(whole, keep=["whole_row"],
                             **{k: v for k, v in options.items() if k not in names}) \
        .filter("repetitions > 0")
    return taken.select("whole_row", F.explode(F.sequence(F.lit(1), F.col("repetitions").cast("int")))) \
        .select("whole_row.*")


def mixture_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) and repetitions of every row.

    The texts are only read for their word counts and hashes.
    """
    narrow = with_repetitions(docs, keep=["doc_id"])
    return narrow.select("doc_id", "size", "source_size", "target",
                         (F.col("size") * F.col("repetitions")).alias("taken"), "repetitions")


#: The contract's result over documents.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('mix-1' || chr(31) || coalesce(CAST(doc_id AS VARCHAR), '') || chr(31)
                                 || coalesce(substr(md5(text), 1, 8), '')), 1, 13) AS BIGINT) AS hash
  FROM documents),
s AS (
  SELECT source, size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source)),
o AS (
  SELECT *, sum(size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(size) OVER (ORDER BY size * 1.0 / weight, weight, source NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_before,
         coalesce(sum(weight) OVER (ORDER BY size * 1.0 / weight, weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before
  FROM s),
l AS (
  SELECT max(CAST(total - 3 * size_before AS DOUBLE) / CAST(weights - weight_before AS DOUBLE)) AS level
  FROM o WHERE CAST(3 * size AS DOUBLE) >= CAST(total - 3 * size_before AS DOUBLE)
               / CAST(weights - weight_before AS DOUBLE) * weight),
f AS (
  SELECT source, CAST(size AS BIGINT) AS source_size,
         least(CAST(3 * size AS DOUBLE), (SELECT coalesce(level, 0) FROM l) * weight) AS target FROM s),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest
  FROM f),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, g.rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * repetitions AS BIGINT) AS taken, repetitions
FROM (SELECT *, CAST(least(3, whole + CASE WHEN start + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS repetitions FROM r)
"""
