import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_samples import no_docs, odd_docs  # noqa: F401

from wellnote.llm import language as lg
from wellnote.llm import quality as ql

SF = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 1


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in ql.score_documents(docs, labels).collect()}
    assert len(got) == docs.count() and all(r.held_out == held_out(d) for d, r in got.items())
    marks = [(got[r.doc_id], r.quality) for r in labels.collect() if held_out(r.doc_id)]
    assert np.mean([r.predicted == q for r, q in marks]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_quality_gradients_match_differences():
    rng = np.random.default_rng(1)
    model = ql.AttentionModel()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    bags = [rng.random((n, ql.BUCKETS)) for n in (1, 3, 5, 2)]
    labels = np.array([0.0, 1.0, 1.0, 0.0])
    x, starts = np.concatenate(bags), np.array([0, 1, 4, 9])

    def loss():
        s, _ = model.forward(x, starts)
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))
    captured = {}

    class Spy:
        def __init__(self, params, rate):
            pass

        def step(self, grads, rate=None):
            captured.update(grads)
    old = ql.Adam, ql.STEPS, ql.BATCH, np.random.default_rng
    try:
        ql.Adam, ql.STEPS, ql.BATCH = Spy, 1, 4

        class Pick:
            def choice(self, g, n):
                return g
        ql.np.random.default_rng = lambda seed: Pick()
        x, starts = np.concatenate([bags[0], bags[3], bags[1], bags[2]]), np.array([0, 1, 3, 6])
        labels_in_order, labels = labels, np.array([0.0, 0.0, 1.0, 1.0])
        model.fit(bags, labels_in_order, encode=lambda bag: bag)
    finally:
        ql.Adam, ql.STEPS, ql.BATCH, ql.np.random.default_rng = old
    for name in ("W", "V", "U", "a", "o", "b", "c"):
        p, at = model.p[name], tuple(0 for _ in model.p[name].shape)
        keep = p[at]
        p[at] = keep + 1e-5
        up = loss()
        p[at] = keep - 1e-5
        down = loss()
        p[at] = keep
        slope = (up - down) / 2e-5
        found = captured[name][at] - (1e-5 * keep if name == "W" else 0)
        assert abs(slope - found) < 1e-5 + 1e-3 * abs(slope), name


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (2, None)],
                                   "doc_id long, quality int")
    got = ql.score_documents(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    none = ql.score_documents(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert ql.score_documents(no_docs, labels).count() == 0


def test_every_passage_counts():
    model = ql.AttentionModel()
    text = "word " * 400
    assert len(ql.passages(text)) == -(-len(text) // ql.PASSAGE)
    assert model.scores([text])[0] != model.scores([text[:-600] + "%$# " * 150])[0]
    both = model.scores([text, None, "", "a"])
    assert np.allclose(both, [model.scores([t])[0] for t in (text, None, "", "a")])


def test_the_deciding_passage_may_stand_anywhere(spark):
    # The passage that earns the label is one of sixty, and not where evenly spread ones would look.
    import random
    rng = random.Random(4)
    plain = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "amet", "sit"]) for _ in range(n))
    docs, labels = [], []
    for i in range(240):
        parts = [plain(90) for _ in range(60)]
        good = i % 2
        if good:
            parts[rng.choice([7, 23, 41, 55])] = "QZX#17 " * 70
        docs.append((i, "".join(parts)))
        labels.append((i, good))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = ql.score_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.held_out]) > 0.95


def test_sampled_texts_are_bounded_in_rows_and_bytes(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat(concat('t', id, ' '), 100) as text", "'x' as lang")
    from wellnote.llm.common import bounded_sample, text_id
    labelled = docs.select(text_id().alias("tid"), F.col("lang").alias("label"), F.octet_length("text").alias("bytes"))
    some = bounded_sample(docs, labelled, 50)
    few = bounded_sample(docs, labelled, 50, 5000)
    assert len(some) == 50 and 5000 <= sum(len(t) for t, _ in few) < 5000 + 600 and few == some[:len(few)]


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in lg.identify(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    out = [(got[r.doc_id].lang_pred, r.lang) for r in rows if held_out(r.doc_id)]
    assert len(got) == len(rows) and np.mean([a == b for a, b in out]) > 0.97


def test_language_gradients_match_differences():
    rng = np.random.default_rng(3)
    model = lg.BiGRU(["a", "b", "c"])
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x = rng.integers(1, 20, (6, 9)).astype(np.uint8)
    weight = rng.standard_normal((9, 6, lg.HIDDEN))

    def loss(way):
        states, _ = model._states(x.T, way)
        return float((states.astype(np.float64) * weight).sum())
    for way in "fb":
        _, kept = model._states(x.T, way, keep=True)
        grads = model._gradients(x.T, way, kept, weight)
        for name in ("E" + way, "U" + way):
            for at in ((int(x[0, 0]), 1), (int(x[0, 3]), 2 * lg.HIDDEN + 1)) if name[0] == "E" else ((0, 0), (1, 20)):
                keep = model.p[name][at]
                model.p[name][at] = keep + 1e-3
                up = loss(way)
                model.p[name][at] = keep - 1e-3
                down = loss(way)
                model.p[name][at] = keep
                slope = (up - down) / 2e-3
                assert abs(slope - grads[name][at]) < 2e-2 * (1 + abs(slope)), (name, at)


def test_both_layouts_of_the_network_agree():
    model = lg.BiGRU(["a", "b", "c"])
    x = np.random.default_rng(4).integers(0, 255, (64, 33)).astype(np.uint8)
    for way in "fb":
        states, _ = model._states(x, way)
        assert np.allclose(states.transpose(0, 2, 1), model._scan(x, way), atol=1e-5)
    p = model.probabilities(x)
    assert p.shape == (64, 3, 33) and np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_language_reads_every_window():
    model = lg.BiGRU(["a", "b"])
    text = "abc " * 100
    x, sizes = lg.windows([text.encode(), b"", b"x"])
    assert sizes.tolist() == [7, 0, 1] and len(x) == 8
    a = model.label([text, None, "", "123 ...", "x" * 70])
    assert [k for k, _ in a[1:4]] == [lg.UNKNOWN] * 3
    alone = model.label(["x" * 70])[0]
    assert a[4][0] == alone[0] and a[4][1] == pytest.approx(alone[1], abs=1e-6)
    assert model.label([text])[0][1] != model.label([text[:-60] + "z" * 60])[0][1]


def test_language_odd_rows(spark, odd_docs, no_docs):
    got = lg.identify(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.lang_pred == lg.UNKNOWN for r in got if r.doc_id in (22, 23, 24))
    assert all(r.lang_pred in ("en", "de", "fr", lg.UNKNOWN) and 0 <= r.score <= 1 for r in got)
    assert lg.identify(no_docs).count() == 0
    assert {r.lang_pred for r in lg.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == \
        {lg.UNKNOWN}
