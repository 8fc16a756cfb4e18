"""Weighted rendezvous hashing of stable record keys.

A record goes to the shard with the highest score ``weight / -ln(u)``, where ``u`` in (0, 1) is a
hash of the key and the shard's number.  One more shard takes records only into itself; one
shard fewer moves only that shard's records.  The key is the id, or a hash of the text where the
id is null, so that a large number of null ids spreads as well.

Built-in functions only; the work per record is one hash per shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARDS = 16
#: Hash ranges in which slots are counted; a group is one range of one shard.
RANGES = 4096


def key_hash(doc_id: Column, text: Column) -> Column:
    return F.when(doc_id.isNotNull(), F.xxhash64(doc_id.cast("long"))) \
        .otherwise(F.xxhash64(F.coalesce(text, F.lit("")), F.lit("no id")))


def shard_of(key: Column, weights: list[float]) -> Column:
    """Number of the shard with the highest score; ties go to the lower number."""
    def score(i: int) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        # All weights equal: the order of the scores is that of u.
        return unit if len(set(weights)) == 1 else F.lit(float(weights[i])) / -F.log(unit)

    best = F.greatest(*[F.struct(score(i).alias("score"), F.lit(-i).alias("nr"))
                        for i in range(len(weights))]) if len(weights) > 1 else None
    return F.lit(0) if best is None else -best["nr"]


def with_shards(docs: DataFrame, weights: list[float], doc_id: str = "doc_id", text: str = "text",
                grown: float | None = None, ranges: int = RANGES) -> DataFrame:
    """All columns of ``docs`` with shard, grown_shard and a gapless slot in the shard.

    ``grown`` is the weight of one more shard (null: the same as the last).  Slots are counted by
    ranges of the hash of key and text: row numbers inside a (shard, range), after the counts of
    the ranges before it, so no task sees a whole shard.  Repeated rows share a range and get slots
    of their own.  Columns of the names made are replaced.
    """
    made = ("shard", "grown_shard", "slot")
    # Added shards need numbers of their own, so the first ones keep their scores.
    more = weights + [weights[-1] if grown is None else grown]
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns if c not in made]).alias("row"),
        key_hash(F.col(doc_id), F.col(text)).alias("key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tid"))
    scored = rows.withColumn("shard", shard_of(F.col("key"), weights).cast("int")) \
        .withColumn("grown_shard", shard_of(F.col("key"), more).cast("int")) \
        .withColumn("range", F.pmod(F.xxhash64("key", "tid"), F.lit(ranges)).cast("int"))
    counts = scored.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    # At most shards x ranges rows, whatever the input.
    starts = counts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("shard", "range").orderBy("key", "tid")
    return scored.withColumn("at", F.row_number().over(inside)).join(starts, ["shard", "range"]) \
        .select("row.*", "shard", "grown_shard", (F.col("start") + F.col("at") - 1).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row (law: ``key``).

    A null text has no bytes (size 1) and the checksum of the empty text.  An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                         (F.octet_length(text).cast("long") + 1).alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = with_shards(narrow, [1.0] * shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"),
                         "shard", "slot", "grown_shard")
