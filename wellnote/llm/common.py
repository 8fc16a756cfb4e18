"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

U64 = np.uint64
#: Odd multiplier of the rolling polynomials, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local session without it gets a folder of its own (tests)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="wellnote-checkpoints-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame, **options: str) -> DataFrame:
    """The rows written once to a Parquet table in the shared folder and read from there.

    Cuts the lineage so that lost executors cost a re-read of files; unlike a checkpoint the table
    is compressed, is read by column, and its size is known to the planner, which then decides by
    its own threshold whether to broadcast it.  ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/wellnote-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the fast built-in serves texts without other letters."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
        .otherwise(F.translate(text, upper, upper.lower()))


def text_key(text: Column) -> Column:
    """Two independent 64-bit hashes of the text, as 32 hex digits; null and empty texts differ.

    Stands for the text where equal texts are computed once and joined back, so that null or
    repeated ids need no care.
    """
    return F.concat(F.hex(F.xxhash64(text)), F.lit(":"), F.md5(text).substr(1, 16))


def training_fold(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 3: 1 marks the held-out rows; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def is_held_out(doc_id: Column) -> Column:
    return training_fold(doc_id) == 1


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a few hundred at a time in memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*[part.column(i).to_pylist() for i in range(part.num_columns)])


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024,
               max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows and about ``max_bytes`` of strings."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, (str, bytes, list)))
        if len(held) >= size or weight >= max_bytes:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(col), type=f.type) for col, f in zip(zip(*rows), schema)], schema=schema)


def text_id(text: str = "text") -> Column:
    return F.xxhash64(F.col(text))


def bounded_sample(texts: DataFrame, labelled: DataFrame, per_label: int,
                   max_bytes: int | None = None) -> list[tuple[str, object]]:
    """At most ``per_label`` different texts of each label, as (text, label) on the driver.

    ``labelled`` has ``tid`` (:func:`text_id`) and ``label``; rows without a label are left out.  The
    choice is by a hash of the text, so it is the same whatever the order or the number of tasks;
    it is made on ids alone, and only the chosen texts are then fetched from ``texts`` (``text``), whole.
    With ``max_bytes`` (and a column ``bytes``) a label's texts end with the one that reaches so many bytes.
    """
    spot = F.pmod(F.xxhash64("tid", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    size = F.col("bytes") if max_bytes is not None else F.lit(0)
    known = labelled.select("tid", "label", size.cast("long").alias("bytes")).filter("label is not null").distinct() \
        .withColumn("spot", spot)
    known = cut(known)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, 4.0 * per_label / n)])
    first = Window.partitionBy("label").orderBy("spot", "tid")
    picked = cut(known.filter(F.col("spot") < F.try_element_at(shares, F.col("label")))
                 .withColumn("at", F.row_number().over(first)).filter(F.col("at") <= per_label)
                 .withColumn("before", F.sum("bytes").over(first.rowsBetween(Window.unboundedPreceding, -1)))
                 .filter(F.coalesce("before", F.lit(0)) < (max_bytes or 1)).drop("at", "before", "bytes"))
    # At most per_label rows for each label, so this side may be broadcast.
    wanted = F.broadcast(picked.select("tid").distinct())
    found = texts.select("text", text_id().alias("tid")).filter("text is not null") \
        .join(wanted, "tid", "left_semi").groupBy("tid").agg(F.min("text").alias("text"))
    by_tid = {r["tid"]: r["text"] for r in found.collect()}
    return [(by_tid[r["tid"]], r["label"]) for r in picked.orderBy("spot", "tid", "label").collect()
            if r["tid"] in by_tid]


class Adam:
    """Adam steps over a dictionary of arrays, in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float) -> None:
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], rate: float | None = None) -> None:
        self.t += 1
        rate = self.rate if rate is None else rate
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (rate * (self.m[k] / (1 - 0.9 ** self.t))
                               / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)).astype(self.params[k].dtype)


class Powers:
    """Powers of ``BASE`` and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 14)
            with np.errstate(over="ignore"):
                for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                    steps = np.full(size, base, U64)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps, dtype=U64))
        return self.up[:n], self.down[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))
