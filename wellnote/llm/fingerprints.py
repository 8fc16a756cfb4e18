"""Winnowing fingerprints of documents.

Every ``k`` code points give a rolling hash; of every ``w`` consecutive hashes the smallest is
kept, the rightmost one on ties, with its position.  Any passage of at least ``w + k - 1`` code
points shared by two texts therefore leaves a common fingerprint.

Defined results: a null text counts as empty; an empty text has an empty fingerprint; a text
shorter than ``k`` is one gram; one with fewer than ``w`` grams is one window.  Two empty
fingerprints have likeness 1, an empty and a non-empty one 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellnote.llm.common import Powers, U64, batches_of, mix64, rows_of, shuffle_partitions

K, W = 20, 31


def winnow(text: str, k: int, w: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Kept gram hashes (32 bits) and their positions in code points, by position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(U64)
    n = len(points)
    if n == 0:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    k = min(k, n)
    up, down = powers.upto(n)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, U64)
        np.cumsum(mix64(points + U64(1)) * up, out=sums[1:])
        grams = mix64((sums[k:] - sums[:-k]) * down[: n - k + 1])
    # The low half of a key holds the position from the right, so that the minimum breaks ties rightmost.
    keys = (grams & U64(0xFFFFFFFF00000000)) | (U64(0xFFFFFFFF) - np.arange(len(grams), dtype=U64))
    width = 1
    w = min(w, len(keys))
    while 2 * width <= w:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < w:
        keys = np.minimum(keys[: len(keys) - (w - width)], keys[w - width:])
    kept = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    return (kept >> U64(32)).astype(np.uint32), \
        (U64(0xFFFFFFFF) - (kept & U64(0xFFFFFFFF))).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """All columns of ``docs`` with ``grams`` and ``gram_positions`` (arrays, by position).

    No shuffle.  Existing columns of these names are replaced.
    """
    @F.pandas_udf(T.StructType([T.StructField("grams", T.ArrayType(T.LongType())),
                                T.StructField("positions", T.ArrayType(T.LongType()))]))
    def udf(texts):
        import pandas as pd
        powers = Powers()
        found = [winnow(t or "", k, w, powers) for t in texts]
        return pd.DataFrame({"grams": [g.astype(np.int64) for g, _ in found],
                             "positions": [p for _, p in found]})

    row = F.struct(*[F.col(c) for c in docs.columns if c not in ("grams", "gram_positions")])
    return docs.select(row.alias("row"), udf(F.col(text)).alias("made")) \
        .select("row.*", "made.grams", F.col("made.positions").alias("gram_positions"))


EDITED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
_EDITED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def in_order_with_successor(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, ghost, doc_id, text), each bucket sorted by descending doc_id within one partition.

    A bucket is a range of ids (split at quantiles of all ids; null ids come last).  The first rows
    of the next bucket are repeated at the end of each as ghosts, after the last bucket the very
    first ones, so that every row's successor stands directly behind it.  The texts are shuffled
    once; the driver sees one bound and one head per bucket.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * buckets).alias("q")).first()["q"] \
        if shares else None
    bounds = sorted(set(found or []))
    # Exact long arithmetic beside null ids: the number of bounds at or over an id, nulls behind all.
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]).cast("array<bigint>"),
                        lambda b: b >= F.col("doc_id")))).cast("int")
    placed = docs.withColumn("bucket", bucket)

    heads = sorted((r["bucket"], r["head"]) for r in
                   placed.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect())
    # Where the head of each bucket goes as a ghost: to the bucket before it, in a circle.
    before = {heads[i][0]: heads[i - 1][0] for i in range(len(heads))}
    entries = [x for p, head in heads for x in (
        F.lit(p), F.struct(F.lit(head).cast("long").alias("head"), F.lit(before[p]).alias("before")))]
    if entries:
        seat = F.try_element_at(F.create_map(*entries), F.col("bucket"))
        placed = placed.withColumn("ghost_bucket", F.when(
            seat["head"].isNull() | (seat["head"] == F.col("doc_id")), seat["before"]).otherwise(-1))
    else:
        placed = placed.withColumn("ghost_bucket", F.lit(-1))
    spread = placed.select("doc_id", "text", F.explode(
        F.when(F.col("ghost_bucket") >= 0,
               F.array(F.struct(F.col("bucket"), F.lit(False).alias("ghost")),
                       F.struct(F.col("ghost_bucket").alias("bucket"), F.lit(True).alias("ghost"))))
        .otherwise(F.array(F.struct(F.col("bucket"), F.lit(False).alias("ghost"))))).alias("at"))
    return spread.select("at.bucket", "at.ghost", "doc_id", "text") \
        .repartitionById(len(bounds) + 2, F.col("bucket")) \
        .sortWithinPartitions("bucket", "ghost", F.desc_nulls_last("doc_id"), "text")


def edited_fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprint of every text and of its edited text.

    The edited text keeps the first half of the code points; the last ``n_chars // 2`` give way to
    as many first code points (or all) of the next document by descending doc_id, after the last
    one the first.  Repeated rows and equal ids are ordered by text; null ids come last.  An empty
    table gives no rows; a single document follows itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()

        def hashed(text: str) -> np.ndarray:
            return np.unique(winnow(text, k, w, powers)[0])

        def as_text(grams: np.ndarray) -> str:
            return grams.astype(">u4").tobytes().hex()

        def results() -> Iterator[tuple]:
            held = None
            for bucket, ghost, doc_id, text in rows_of(batches):
                grams = hashed(text)
                if held is not None and held[0] == bucket and not held[1]:
                    _, _, own_id, own, own_grams = held
                    half = len(own) // 2
                    edited = own[: len(own) - half] + text[:half]
                    edited_grams = hashed(edited)
                    yield (own_id, len(own),
                           hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                           as_text(own_grams), as_text(edited_grams),
                           likeness(own_grams, edited_grams), likeness(own_grams, grams))
                held = (bucket, ghost, doc_id, text, grams)

        yield from batches_of(results(), _EDITED_ARROW)

    ordered = in_order_with_successor(docs, shuffle_partitions(docs.sparkSession))
    return ordered.mapInArrow(run, EDITED)
