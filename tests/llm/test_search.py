import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_samples import no_docs, odd_docs, words  # noqa: F401

from wellnote.llm import search as sr

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UP))


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    lists = [(i, Counter(w), len(w)) for i, t in docs for w in [split(t)]]
    rows, total = sum(n > 0 for _, _, n in lists), sum(n for _, _, n in lists)
    df = Counter(t for _, c, _ in lists for t in c)
    weight = {t: math.floor(1000 * math.log((2 * rows + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        q = Counter(split(text))
        scored = []
        for doc_id, c, n in lists:
            m = 25 + 75 * n * rows // max(total, 1)
            s = sum(k * weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in q.items() if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        for rank, (s, none, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if none else i, -s))
    return sorted(out, key=repr)


def result(docs, items, **kw):
    return sorted((tuple(r) for r in sr.ranked(docs, items, **kw).collect()), key=repr)


def same(docs, items, **kw):
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                 [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], kw.get("top", 10))
    got = result(docs, items, **kw)
    assert got == want
    return got


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(12)
    texts = [words(rng, rng.randint(1, 120), rng.choice(["en", "de", "fr"])) for _ in range(400)]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [(1000 + i, texts[7]) for i in range(60)] + [(2000 + i, texts[i].upper()) for i in range(40)]
    docs += [(3000, None), (3001, ""), (3002, "?! --"), (None, texts[3]), (None, texts[3]), (5, texts[5]), (5, texts[9]),
             (3003, "É é ÉÉ x_y a1"), (3004, words(rng, 6000))]
    items = [(i, words(rng, rng.randint(3, 30), rng.choice(["en", "de"]))) for i in range(15)]
    items += [(50, texts[7]), (51, texts[9] + " " + texts[9]), (52, ""), (53, None), (54, "zzz unknown"), (55, "é ÉÉ A1 x y"),
              (50, texts[7]), (50, "the same id with another text"), (None, texts[3])]
    return spark.createDataFrame(docs, "doc_id long, text string"), \
        spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(corpus):
    got = same(*corpus)
    assert len({r[0] for r in got}) > 15


def test_small_pieces_blocks_and_passes_change_nothing(corpus):
    for kw in ({"piece": 37, "block": 5}, {"at_once": 4}, {"cells": 4000, "block": 9}, {"top": 3, "piece": 64}):
        same(*corpus, **kw)


def test_odd_rows_and_empty_tables(corpus, odd_docs, no_docs):
    _, items = corpus
    same(odd_docs, items)
    assert result(no_docs, items) == [] == result(odd_docs, items.limit(0))


def test_words_of_every_document_weigh_nothing(spark):
    docs = spark.createDataFrame([(i, f"common w{i % 3}") for i in range(1200)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "common"), (2, "common w1")], "item_id long, text string")
    got = same(docs, items)
    assert sorted(r[1:3] for r in got) == [(k, 3 * k - 2) for k in range(1, 11)] and {r[0] for r in got} == {2}


def test_blocks_are_skipped_only_under_the_bar():
    rng = np.random.default_rng(3)
    n, width = 3000, 60
    names = [(0, 0, False, i) for i in range(n)]
    # Thirty kinds of texts, one after the other as their places would put them, each with terms of its own.
    own = np.array([rng.permutation(width) < 12 for _ in range(30)])
    there = own[np.arange(n) // 100] & (rng.random((n, width)) < 0.6)
    there[:, 0] = True
    impacts = np.where(there, rng.integers(1, 1_000_000, (n, width)), 0)
    rows, at = np.nonzero(there)
    ends = np.concatenate(([0], np.cumsum(there.sum(1))))
    terms = sr.pa.array([f"t{k}" for k in at])
    met = skipped = 0
    bests = [sr.Best(10) for _ in range(20)]
    asked = [(rng.choice(width, 8, replace=False), rng.integers(1, 9000, 8)) for _ in range(20)]
    for row in sr._blocked(names, terms, ends, impacts[rows, at], 1000, 1 << 24, 64):
        piece = sr.Piece(row)
        for best, (t, w) in zip(bests, asked):
            a, b = sr.search_piece(piece, [f"t{k}" for k in t], w, best)
            met, skipped = met + a, skipped + b
    for best, (t, w) in zip(bests, asked):
        scores = impacts[:, t] @ w
        want = sorted((-int(s), False, i) for i, s in enumerate(scores) if s > 0)[:10]
        assert [r[:3] for r in best.rows] == want
    assert met > 500 and skipped > met // 4
