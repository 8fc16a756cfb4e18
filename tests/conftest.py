import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from wellnote.session import ensure_checkpoint_dir
    scratch = tempfile.mkdtemp(prefix="wellnote-tests-")
    s = (SparkSession.builder.master("local[4]").appName("wellnote-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, fallback=os.path.join(scratch, "checkpoints"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="wellnote-case-")


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison helper)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
