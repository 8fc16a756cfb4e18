import random

import duckdb
from llm_samples import no_docs, odd_docs, words  # noqa: F401

from wellnote.llm import mixing


def fixture(spark, n=300):
    rng = random.Random(4)
    sources = ["b", "a", "é", None, "Z", "tiny"]
    rows = []
    for i in range(n):
        s = rng.choices(sources, [50, 20, 10, 8, 10, 1])[0]
        rows.append((i, s, None if i % 37 == 0 else words(rng, rng.randint(0, 60))))
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def in_sql(docs):
    con = duckdb.connect()
    con.register("given", docs.toPandas())
    con.execute("create table documents as select * from given")
    return con.execute(mixing.ORACLE).df()


def test_report_equals_sql(spark):
    docs = fixture(spark)
    expect = in_sql(docs)
    got = mixing.mixture_report(docs).toPandas()
    cols = sorted(expect.columns)
    a = expect[cols].sort_values(cols).reset_index(drop=True)
    b = got[cols].sort_values(cols).reset_index(drop=True)
    assert a.equals(b.astype(a.dtypes.to_dict()))


def test_targets_are_feasible_and_near(spark):
    docs = fixture(spark, 600)
    rows = mixing.with_repetitions(docs).collect()
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.source_size, r.target, 0])[2] += r["size"] * r.repetitions
        assert 0 <= r.repetitions <= 3
    assert abs(sum(v[1] for v in by.values()) - total) < 1e-6
    for size, target, taken in by.values():
        assert target <= 3 * size + 1e-9 and abs(taken - target) <= 60


def test_water_filling_clamps_in_rounds(spark):
    sources = spark.createDataFrame([("a", 10, 1), ("b", 100, 2), ("c", 1000, 3), ("d", 0, 1)],
                                    "source string, source_size long, weight int")
    got = {r.source: r.target for r in mixing.water_filling(sources).collect()}
    assert got["a"] == 30 and got["b"] == 300 and got["d"] == 0 and abs(got["c"] - 780) < 1e-9


def test_rows_without_words_stay(spark):
    docs = spark.createDataFrame([(1, "a", "some words here"), (2, "a", ""), (3, "a", None), (4, "a", "and a few more"),
                                  (5, "empty", " "), (6, "empty", None)], "doc_id long, source string, text string")
    got = sorted(r.doc_id for r in mixing.mix(docs).collect())
    assert set(got) == {1, 2, 3, 4, 5, 6} and got.count(5) == got.count(6) == 1


def test_rows_come_as_often_as_taken_with_their_own_columns(spark, odd_docs, no_docs):
    reps = mixing.with_repetitions(odd_docs.drop("size"))
    expect = sum(r.repetitions for r in reps.collect())
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == expect
    assert mixed.schema["size"].dataType.simpleString() == "int"
    own = {tuple(r) for r in odd_docs.collect()}
    assert {tuple(r) for r in mixed.collect()} <= own
    assert mixing.mix(no_docs).count() == 0 and mixing.mixture_report(no_docs).count() == 0


def test_reruns_and_partitions_agree(spark):
    docs = fixture(spark)
    a = sorted(map(tuple, mixing.mixture_report(docs).collect()))
    b = sorted(map(tuple, mixing.mixture_report(docs.repartition(7)).collect()))
    assert a == b
