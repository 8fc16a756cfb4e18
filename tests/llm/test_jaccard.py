import random
import re

import numpy as np
import pytest
from llm_samples import no_docs, odd_docs, words  # noqa: F401

from wellnote.llm import jaccard as jc

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i: i + size]) for i in range(len(w) - size + 1))


def brute(rows, threshold=75):
    """(doc_id, n_shingles, component_id) of every row, from all pairs of different sets."""
    sets = [shingle_set(t) for _, t in rows]
    kinds = list({s for s in sets if s})
    at = {s: i for i, s in enumerate(kinds)}
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(kinds):
        for j in range(i):
            both = len(a & kinds[j])
            if 100 * both >= threshold * (len(a) + len(kinds[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            g = find(at[s])
            least[g] = min(least.get(g, doc_id), doc_id)
    return [(d, len(s), least.get(find(at[s])) if s else d) for (d, _), s in zip(rows, sets)]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jc.linked_components(docs).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_sets_are_the_definition():
    s = jc.Shingler()
    for text in (None, "", " \n", "one", "A b C d", "a b c d e", "a b c d e f a b c d e", "É é  ß x y z"):
        assert len(s(text)) == len(shingle_set(text))
    assert np.array_equal(s("A b c D e"), s("a B C d E")) and not np.array_equal(s("É a"), s("é a"))
    assert not np.array_equal(s("ab c"), s("a bc"))


@pytest.mark.parametrize("frequent_share", [0.0, 0.3, 0.9, 1.0])
def test_matching_sets_always_share_a_signature(frequent_share):
    rng = np.random.default_rng(int(frequent_share * 10))
    counters = np.where(rng.random(1 << 10) < frequent_share, rng.integers(11, 99, 1 << 10), rng.integers(0, 10, 1 << 10))
    for n in (1, 2, 3, 4, 8, 20, 23, 24, 30, 32, 33, 40, 96, 120, 128, 129, 400, 513, 2000):
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            # The smallest overlap that still reaches the threshold, with a set of about the same or another size.
            extra = int(rng.integers(0, max(1, n // 3) + 1))
            drop = 0
            while 100 * (len(a) - drop - 1) >= 75 * (len(a) + extra) and drop + 1 < len(a):
                drop += 1
            if 100 * (len(a) - drop) < 75 * (len(a) + extra):
                extra = drop = 0
            b = np.unique(np.concatenate((rng.permutation(a)[drop:],
                                          rng.integers(0, 1 << 63, extra).astype(np.uint64))))
            one, two = jc.signatures(a, counters, 10), jc.signatures(b, counters, 10)
            assert set(one[0]) & set(two[0]) or set(one[1]) & set(two[1])


def test_parity_rows_never_overstate_the_difference():
    rng = np.random.default_rng(2)
    for n in (1, 5, 63, 64, 65, 300, 5000):
        for m in (0, 1, n // 4, n):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.concatenate((a[m:], rng.integers(0, 1 << 63, m // 2).astype(np.uint64)))
            differ = len(np.setxor1d(a, b))
            found = jc.fewest_differences(jc.parity_bits(np.unique(a)), jc.parity_bits(np.unique(b)))
            assert found <= differ and (found > 0 or not differ or differ % 2 == 0)


def test_pairs_stay_linear_in_the_size():
    counters = np.full(1 << 10, 50)
    rng = np.random.default_rng(1)
    for n in (100, 1000, 10_000, 50_000):
        single, pairs = jc.signatures(np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)), counters, 10)
        assert len(single) + len(pairs) < 3 * n


def test_near_copies_chains_and_common_lines(spark, monkeypatch):
    rng = random.Random(6)
    line = words(rng, 14)
    rows = [(i, words(rng, rng.randint(1, 90))) for i in range(60)]
    # A chain in which ends do not match, groups of near copies, many short texts around one line.
    text = words(rng, 100).split()
    for i in range(12):
        rows.append((100 + i, " ".join(text)))
        text[8 * i % 100] = f"new{i}"
    base = words(rng, 80).split()
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(80)] = f"edit{i}"
        rows.append((200 + i, " ".join(copy)))
    rows += [(300 + i, line + " " + words(rng, i % 7)) for i in range(80)]
    rows += [(400 + i, line) for i in range(5)]
    rng.shuffle(rows)
    check(spark, rows)


def test_frequent_tokens_through_pairs(spark, monkeypatch):
    """With most tokens counted as frequent, the result stays the same."""
    monkeypatch.setattr(jc, "token_counters", lambda profile: (np.full(jc.SKETCH, 1000), 10.0))
    rng = random.Random(7)
    base = [words(rng, n).split() for n in (30, 60, 150)]
    rows = []
    for i in range(45):
        copy = list(base[i % 3])
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    check(spark, rows)


def test_copies_of_which_only_some_pairs_match(spark):
    rng = random.Random(11)
    base = words(rng, 120).split()
    rows = []
    for i in range(90):
        copy = list(base)
        for at in rng.sample(range(120), rng.randint(0, 5)):
            copy[at] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    check(spark, rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jc.linked_components(odd_docs).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert jc.linked_components(no_docs).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in jc.components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[100] == 100


def test_components_grow_by_further_links(spark):
    def frame(pairs):
        return spark.createDataFrame(pairs, "a long, b long")
    first = [(1, 2), (2, 3), (10, 11), (20, 21), (21, 22)]
    more = [(3, 11), (30, 31), (22, 31), (40, 41)]
    step = {r.node: r.label for r in jc.merged(jc.components(frame(first)), frame(more)).collect()}
    whole = {r.node: r.label for r in jc.components(frame(first + more)).collect()}
    assert step == whole


def test_long_lists_go_by_differences(spark, monkeypatch):
    """Groups of near copies of which few pairs match: right components, and far fewer pairs than a group has."""
    tried = []
    whole = jc.verified
    monkeypatch.setattr(jc, "verified", lambda docs, classes, pairs, *t: (tried.append(pairs.count()), whole(docs, classes, pairs, *t))[1])
    monkeypatch.setattr(jc, "token_counters", lambda profile: (np.full(jc.SKETCH, 1000), 10.0))
    monkeypatch.setattr(jc, "LONG_LIST", 16)
    rng = random.Random(12)
    rows = []
    for group in range(2):
        base = words(rng, 120).split()
        for i in range(200):
            copy = list(base)
            for at in rng.sample(range(120), rng.choice((0, 1, 2, 4, 5, 6, 7))):
                copy[at] = f"edit{group}x{i}x{at}"
            rows.append((1000 * group + i, " ".join(copy)))
            if i % 20 == 0:  # chains: further copies of a changed copy
                for k in range(3):
                    copy[rng.randrange(120)] = f"more{group}x{i}x{k}"
                    rows.append((1000 * group + 300 + 3 * i + k, " ".join(copy)))
    rng.shuffle(rows)
    check(spark, rows)
    assert tried[-1] < 2 * 230 * 230 / 2 / 8


def test_long_texts_around_a_passage_are_paired_within_their_lists(spark, monkeypatch):
    """Long texts that share a passage are no near copies: their tokens are not spread out, and no link is lost."""
    rng = random.Random(13)
    passage = words(rng, 5)
    spread, found = [], []
    by_differences, in_lists = jc.difference_pairs, jc.far_pairs

    def counted(members, *rest):
        spread.append(members.selectExpr("coalesce(sum(size(diff)), 0) s").first().s)
        return by_differences(members, *rest)

    def kept(*args):
        pairs = in_lists(*args)
        found.append(pairs.count())
        return pairs

    counters = np.full(jc.SKETCH, 1000)
    counters[(jc.Shingler()(passage) % np.uint64(jc.SKETCH)).astype(np.int64)] = 0  # the passage stands first in each order
    monkeypatch.setattr(jc, "token_counters", lambda profile: (counters, 10.0))
    monkeypatch.setattr(jc, "LONG_LIST", 16)
    monkeypatch.setattr(jc, "difference_pairs", counted)
    monkeypatch.setattr(jc, "far_pairs", kept)
    rows = [(i, f"{passage} {' '.join(f'own{i}x{k}' for k in range(200 + i % 30))}") for i in range(60)]
    for i in range(0, 60, 6):  # of some texts further copies, changed now and then
        copy = rows[i][1].split()
        for k in range(3):
            copy[40 + 50 * k] = f"more{i}x{k}"
            rows.append((100 + 3 * i + k, " ".join(copy)))
    base = f"{passage} {words(rng, 120)}".split()
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(5, 125), rng.choice((0, 2, 4, 6))):
            copy[at] = f"edit{i}x{at}"
        rows.append((1000 + i, " ".join(copy)))
    rng.shuffle(rows)
    check(spark, rows)
    assert 0 < found[0] and spread[0] < 60 * 200


def test_far_pairs_are_all_that_may_link(spark):
    """Pairs of a list with a far class: none that links is missing, whatever the sizes of the differences."""
    rng = np.random.default_rng(14)
    centre = set(range(100))
    sets, rows, changed = {}, [], []
    for cid in range(40):
        own = {int(x) for x in rng.integers(1000 * (cid // 4), 1000 * (cid // 4) + 60, 90)} if cid < 24 else set()
        sets[cid] = own | set(list(centre)[: 100 if cid >= 24 else 6 * (cid % 4)]) - {int(x) for x in rng.integers(0, 100, cid % 9)}
        d = len(sets[cid] ^ centre)
        changed.append((7, cid, len(sets[cid]), cid % 39, [0], d, d > 40))
        rows += [(sig, cid, len(sets[cid]), cid % 39, 40, 7) for sig in (1, 2) if sig == 1 or cid % 2]
    lists = spark.createDataFrame(rows, "sig long, cid long, n int, label long, rows long, top long")
    found = jc.far_pairs(lists, spark.createDataFrame(
        changed, "top long, cid long, n int, label long, tokens array<long>, d int, far boolean"))
    got = [(r.a, r.b) for r in found.collect()]
    far = {c[1] for c in changed if c[6]}
    links = {(a, b) for a in sets for b in sets if a < b and a % 39 != b % 39 and far & {a, b}
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert len(got) == len(set(got)) and links and links <= set(got)
    assert all(far & {a, b} for a, b in got) and len(got) < 40 * 39 / 2 / 3


def test_sets_of_texts_around_passages_do_not_travel(spark, monkeypatch):
    """Long texts that share passages with many groups: neither their sets nor their differences are stored for each group."""
    rng = random.Random(15)
    passages = [words(rng, 5) for _ in range(6)]
    stored, asked = [], []
    differences, whole_sets = jc.centre_differences, jc.token_sets

    def kept(*args):
        changed = differences(*args)
        stored.append(changed.selectExpr("count(*) n", "count(distinct top) t", "coalesce(sum(size(tokens)), 0) s").first())
        return changed

    def sets(docs, tids):
        asked.append(tids.distinct().count())
        return whole_sets(docs, tids)

    counters = np.full(jc.SKETCH, 1000)
    for passage in passages:
        counters[(jc.Shingler()(passage) % np.uint64(jc.SKETCH)).astype(np.int64)] = 0
    monkeypatch.setattr(jc, "token_counters", lambda profile: (counters, 10.0))
    monkeypatch.setattr(jc, "LONG_LIST", 8)
    monkeypatch.setattr(jc, "centre_differences", kept)
    monkeypatch.setattr(jc, "token_sets", sets)
    rows = []
    for i in range(60):
        own = [f"own{i}x{k}" for k in range(200 + i % 30)]
        for k in range(3):
            own.insert(60 * k, passages[(i + k * (1 + i % 2)) % 6])
        rows.append((i, " ".join(own)))
    for i in range(0, 60, 6):
        copy = rows[i][1].split()
        copy[30] = f"more{i}"
        rows.append((100 + i, " ".join(copy)))
    check(spark, rows)
    assert stored[0].t > 1 and stored[0].n > 100 and stored[0].s < 60 * 200
    assert asked[-2] < 20  # the centres' round asks for hardly any of the 70 texts
