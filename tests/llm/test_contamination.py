import hashlib
import random
import re

from llm_samples import no_docs, odd_docs, words  # noqa: F401

from wellnote.llm import contamination as ct

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def brute(docs, items, window=13):
    phrases = {}
    for item, text in items:
        w = split(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            phrases.setdefault(tuple(w[i: i + size]), set()).add("" if item is None else str(item))
    sizes = {len(p) for p in phrases}
    out = []
    for doc_id, text in docs:
        w = split(text)
        hit, found = set(), set()
        for i in range(len(w)):
            for n in sizes:
                p = tuple(w[i: i + n])
                if len(p) == n and p in phrases:
                    hit |= set(range(i, i + n))
                    found |= phrases[p]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def same(spark, docs, items):
    got = ct.contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                                               "contaminated").collect()
    expect = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                   [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, got), key=repr) == sorted(expect, key=repr)


def case(spark):
    rng = random.Random(8)
    items = [(i, words(rng, rng.randint(10, 40))) for i in range(12)]
    items += [(50, "short item here"), (51, "the"), (52, ""), (53, None), (54, "the the the the"),
              (55, "A-b c_d 4x!"), (55, "another text, same id"), (None, "without an id at all")]
    docs = []
    for i in range(60):
        w = words(rng, rng.randint(0, 150)).split(" ")
        if i % 4 == 0:
            passage = items[i % 12][1].split()
            lo = rng.randrange(max(1, len(passage) - 13))
            w[len(w) // 2: len(w) // 2] = passage[lo: lo + rng.randint(8, 20)]
        docs.append((i, " ".join(w)))
    docs += [(100, items[0][1].upper()), (101, "a b C d 4X and short, item; HERE"), (102, None), (103, ""),
             (104, "the the the the the the"), (None, items[3][1]), (100, items[0][1].upper())]
    return spark.createDataFrame(docs, "doc_id long, text string"), \
        spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark):
    docs, items = case(spark)
    same(spark, docs, items)


def test_no_benchmark_and_no_documents(spark, odd_docs, no_docs):
    _, items = case(spark)
    same(spark, odd_docs, items.limit(0))
    same(spark, odd_docs, items)
    assert ct.contamination(no_docs, items).count() == 0


def test_more_or_fewer_anchor_lists_change_nothing(spark):
    docs, items = case(spark)
    phrases = ct.phrases_of(items)
    results = [sorted(map(tuple, ct.phrase_matches(ct.tokenised(docs), phrases, n).collect())) for n in (1, 2, 5)]
    assert results[0] == results[1] == results[2] and results[0]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha beta"),
                                  (4, "alpha a b c d e f g beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    phrases = ct.phrases_of(items)
    tids = {r.tid: r.doc_id for r in ct._named(docs).collect()}
    found = {slop: {tids[r.tid] for r in ct.proximity_matches(ct.tokenised(docs), phrases, slop).collect()} for slop in (0, 2, 7)}
    assert found == {0: {2}, 2: {1, 2}, 7: {1, 2, 4}}
