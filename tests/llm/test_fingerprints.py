import hashlib

import pytest
from llm_samples import no_docs, odd_docs  # noqa: F401

from wellnote.llm import fingerprints as fp
from wellnote.llm.common import Powers, mix64


def brute(text, k, w):
    """Kept positions, by the definition: minimum of each window, rightmost on ties."""
    grams, _ = fp.winnow(text, k, 1, Powers())
    hashes = [int(h) for h in grams] if len(text) else []
    kept = set()
    w = min(w, len(hashes))
    if not hashes:
        return []
    for start in range(len(hashes) - w + 1):
        window = range(start, start + w)
        low = min(hashes[i] for i in window)
        kept.add(max(i for i in window if hashes[i] == low))
    return [(p, hashes[p]) for p in sorted(kept)] if hashes else []


@pytest.mark.parametrize("text", ["", "a", "abc", "aaaaaaaaaaaaaaaaaaaa", "abcabcabcabcabcabcabc",
                                  "the quick brown fox jumps over the lazy dog", "é😀ü" * 9])
@pytest.mark.parametrize("k,w", [(3, 4), (5, 1), (4, 7), (20, 31)])
def test_winnow_is_the_definition(text, k, w):
    hashes, positions = fp.winnow(text, k, w, Powers())
    expect = brute(text, k, w)
    if w == 1:
        expect = [(i, int(h)) for i, h in enumerate(hashes)]
    assert list(zip(positions.tolist(), hashes.tolist())) == expect


def test_gram_hashes_depend_on_the_gram_alone():
    text = "abcabc abcabc"
    hashes, positions = fp.winnow(text, 3, 1, Powers())
    by_gram = {}
    for h, p in zip(hashes, positions):
        by_gram.setdefault(text[p: p + 3], set()).add(int(h))
    assert all(len(v) == 1 for v in by_gram.values()) and len(by_gram) == len({min(v) for v in by_gram.values()})


def test_shared_passage_is_always_found():
    shared = "a passage that is exactly as long as the guarantee asks "[: 8 + 10 - 1]
    a, _ = fp.winnow("some text before " + shared + " and more", 8, 10, Powers())
    b, _ = fp.winnow("other " + shared + " end", 8, 10, Powers())
    assert set(a) & set(b)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    ordered = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expect = []
    for i, (doc_id, text) in enumerate(ordered):
        nxt = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        expect.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = fp.edited_fingerprints(odd_docs).collect()
    key = repr
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(expect, key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    empties = [r for r in got if r.n_chars == 0]
    assert empties and all(r.fingerprint == "" for r in empties)
    same = {r.fingerprint for r in got if r.doc_id in (3, 21)}
    assert len(same) == 1
    assert fp.edited_fingerprints(no_docs).count() == 0
    one = odd_docs.filter("doc_id = 1")
    assert fp.edited_fingerprints(one).first().near_next == 1.0


def test_arrays_keep_positions_and_other_columns(spark, odd_docs):
    out = fp.fingerprints(odd_docs, k=5, w=4)
    assert set(odd_docs.columns) < set(out.columns)
    row = out.filter("doc_id = 1").first()
    hashes, positions = fp.winnow(row.text, 5, 4, Powers())
    assert row.grams == hashes.tolist() and row.gram_positions == positions.tolist()
    assert row.row == "mine"


def test_mixer_is_a_bijection_on_samples():
    import numpy as np
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(mix64(x))) == len(x)


def test_null_ids_beside_ids_over_2_to_53(spark):
    low = (1 << 62) + 1
    rows = [(low + 3 * i, f"text {i} " * 9) for i in range(60)] + [(-low - i, f"low {i} " * 7) for i in range(9)] \
        + [(None, f"none {i} " * 8) for i in range(7)]
    rows = rows[::2] + rows[1::2]
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expect = []
    for i, (doc_id, text) in enumerate(ordered):
        half = len(text) // 2
        edited = text[: len(text) - half] + ordered[(i + 1) % len(ordered)][1][:half]
        expect.append((doc_id, hashlib.sha256(edited.encode()).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for given in (docs, docs.filter("doc_id is null or doc_id > 0")):
        got = fp.edited_fingerprints(given).collect()
        assert len(got) == given.count()
    got = fp.edited_fingerprints(docs).collect()
    assert sorted(((r.doc_id, r.edited_sha256) for r in got), key=repr) == sorted(expect, key=repr)
