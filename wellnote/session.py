"""Spark session helpers.

The library takes the session it is given: master, memory and partition counts come from the
cluster (``spark-submit``, the bench or the tests), never from here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "wellnote") -> SparkSession:
    """The running session, or one with the settings it was submitted with."""
    return SparkSession.builder.appName(app_name).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only where it is unset.

    On a cluster this must be a shared folder (HDFS/S3/ABFS); the fallback is
    meant for tests on a single machine only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if path is None:
        import tempfile
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
        path = tempfile.mkdtemp(prefix="wellnote-shared-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def written_once(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    For inputs that several branches of a plan read: they scan the narrow files instead of
    repeating joins, a lost executor costs a re-read, and the planner knows the size.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/wellnote-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
