import random
import zlib
from collections import Counter

import duckdb
import pytest
import test_contamination
import test_jaccard
from llm_samples import no_docs, odd_docs, words  # noqa: F401

import corpus_pipeline as pipeline
from wellnote.llm import mixing, quality, queries
from wellnote.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def brute_stages(spark, docs, sf_dir):
    """Rows (doc_id, text, lang, source, n_chars) after each stage but the last, in plain Python."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    rows = [r for r, s in zip(rows, model.scores([r[1] for r in rows])) if s >= 0.5]
    yield rows
    kept, seen = [], set()
    groups = test_jaccard.brute([(r[0], r[1]) for r in rows])
    for r, (_, n, component) in sorted(zip(rows, groups), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if n == 0:
            kept.append(r)
        elif component not in seen:
            seen.add(component)
            kept.append(r)
    yield kept
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    kept = [r for r, b in zip(kept, test_contamination.brute([(r[0], r[1]) for r in kept], items)) if not b[5]]
    yield kept
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[3]) for r in kept])
    times = {r[0]: int(r[-1]) for r in con.execute(f"select doc_id, repetitions from ({mixing.ORACLE})").fetchall()}
    yield [r for r in kept for _ in range(times[r[0]])]


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, SF, "documents")
    for number, ((name, stage), expect) in enumerate(zip(pipeline.STAGES, brute_stages(spark, docs, SF))):
        path = str(tmp_path / str(number))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert sorted(docs.columns) == sorted(COLUMNS)
        assert rows_of(docs) == sorted(expect, key=repr), name
    last = pipeline.STAGES[-1][1](spark, docs, SF)
    assert rows_of(last) == rows_of(docs)
    run = pipeline.run(spark, SF)
    assert sorted(map(tuple, run.select("doc_id", "shard", "slot", "grown_shard").collect())) == \
        sorted(map(tuple, last.select("doc_id", "shard", "slot", "grown_shard").collect()))
    slots = {}
    for r in run.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    for name, stage in pipeline.STAGES:
        out = stage(spark, odd_docs, SF)
        if name != "sharding":
            assert out.columns == odd_docs.columns and out.schema.simpleString() == odd_docs.schema.simpleString()
            own = Counter(map(tuple, odd_docs.collect()))
            assert set(map(tuple, out.collect())) <= set(own)
        assert stage(spark, no_docs, SF).count() == 0


def test_one_row_of_each_group_stays(spark, odd_docs):
    out = pipeline.keep_distinct(spark, odd_docs, SF).collect()
    ids = Counter(r.doc_id for r in out)
    assert ids[3] == 1 and not ids[20] and not ids[21]
    assert {22, 23, 24} <= set(ids) and ids[1] == 1


def test_every_operator_has_a_query_and_the_entry_lists_it(spark):
    import __spark_entry__ as entry
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    expect = con.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(expect.columns)
    assert cols == sorted(got.columns)
    a = expect[cols].sort_values(cols).reset_index(drop=True)
    b = got[cols].sort_values(cols).reset_index(drop=True)
    assert a.equals(b.astype(a.dtypes.to_dict()))


def test_folds_are_crc32(spark):
    from pyspark.sql import functions as F
    from wellnote.llm.common import training_fold
    df = spark.createDataFrame([(i * 37 - 50,) for i in range(200)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", training_fold(F.col("doc_id")).alias("f")).collect():
        assert r.f == zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3


def test_words_helper():
    assert len(words(random.Random(1), 9).split()) == 9
