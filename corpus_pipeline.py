"""Corpus pipeline over ``documents``: quality, near duplicates, decontamination, mixing, sharding.

Each stage works on all rows that the stage before it kept and returns the columns of the
documents it was given; the last one adds shard, grown_shard and slot.

* quality classifier: rows with a score under 0.5 go.  Learns from ``labels`` and the rows it is given.
* n-gram Jaccard join: of each group of near duplicates the row with the smallest (doc_id, text
  hash) stays, null ids last, one of fully repeated rows; rows without words are no duplicates.
* benchmark decontamination: rows with at least one in twenty words inside benchmark phrases go.
* mixing: every row stands as often as the mixture takes it, up to three times or not at all.
* sharding: rendezvous hashing by doc_id; each row, repeated ones too, has a slot of its own.

Null texts count as empty in every stage; an empty table passes all stages empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellnote.llm import contamination, jaccard, mixing, quality, sharding
from wellnote.llm.common import cut, shared_folder, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.select(F.struct("*").alias("row"), quality.score_column(model).alias("score")) \
        .filter("score >= 0.5").select("row.*")


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.linked_components(docs)
    # One keeper per group; rows without words stay by themselves.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), "tid")
    keepers = found.filter("n_shingles > 0").groupBy("label").agg(F.min(place).alias("first")) \
        .select("first.doc_id", "first.tid", F.lit(True).alias("worded"))
    alone = found.filter("n_shingles = 0").select("doc_id", "tid", F.lit(False).alias("worded")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("own_tid"))
    kept = rows.join(keepers.union(alone), (F.col("own_tid") == F.col("tid"))
                     & F.col("own_id").eqNullSafe(F.col("doc_id")))
    nth = F.row_number().over(Window.partitionBy("own_tid", "own_id").orderBy(F.lit(0)))
    return kept.withColumn("nth", nth).filter("not worded or nth = 1").select("row.*")


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(text).alias("tid"),
                       F.crc32(text.cast("binary")).alias("crc"))
    # Stored, so that its size is known: mostly few texts, which then need no shuffle of all others.
    bad = cut(found.filter("contaminated").select("tid", "crc").distinct())
    return rows.join(bad, ["tid", "crc"], "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.with_shards(docs, [1.0] * sharding.SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_distinct),
    ("benchmark decontamination", keep_clean),
    ("mixing sources", mix_sources),
    ("sharding", deal_shards),
]
#: The classifier is learned, which SQL cannot express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
