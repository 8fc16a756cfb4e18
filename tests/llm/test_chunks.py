import random

from llm_samples import no_docs, odd_docs, words  # noqa: F401

from wellnote.llm import chunks as ch


def test_boundaries_cover_whole_texts_and_split_no_character():
    rng = random.Random(1)
    for text in ("", "a", "é" * 500, "x" * 5000, words(rng, 800, "fr"), "😀" * 99):
        data = text.encode()
        ends = ch.boundaries(data)
        assert (ends[-1] if ends else 0) == len(data)
        start = 0
        for end in ends:
            assert 0 < end - start <= ch.MAX_CHUNK
            data[start:end].decode()
            start = end


def test_insertion_moves_only_near_chunks():
    rng = random.Random(2)
    text = words(rng, 1000).encode()
    changed = text[:300] + b"inserted words" + text[300:]

    def pieces(data):
        out, start = set(), 0
        for end in ch.boundaries(data):
            out.add(data[start:end])
            start = end
        return out
    a, b = pieces(text), pieces(changed)
    assert len(a - b) <= 6 and len(a & b) > 0.9 * len(a) - 6


def planted(spark):
    rng = random.Random(3)
    passage = words(rng, 60)
    rows = []
    for i in range(40):
        text = words(rng, 120)
        if i in (5, 11, 30):
            text = words(rng, 37) + " " + passage + " " + words(rng, 51)
        rows.append((i, text))
    rows.append((40, rows[7][1]))
    return passage, spark.createDataFrame(rows, "doc_id long, text string")


def test_planted_passages_are_found_and_clean_documents_left(spark):
    passage, docs = planted(spark)
    found = ch.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} == {5, 11, 30, 7, 40}
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    for r in found:
        part = texts[r.doc_id][r.start: r.start + r.n_bytes]
        assert part in (passage.encode() if r.doc_id in (5, 11, 30) else texts[7])
    first = {r.doc_id: (r.n_first, r.n_chunks) for r in found}
    assert first[5][0] == first[5][1] and first[11][0] == first[30][0] == first[40][0] == 0


def test_deduplicated_texts(spark):
    passage, docs = planted(spark)
    out = {r.doc_id: r.text for r in ch.deduplicated(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert out[5] == texts[5] and out[40] == "" and out[1] == texts[1]
    assert len(out[11]) < len(texts[11]) - len(passage) / 2


def test_repeated_chunks_against_brute_force(spark, odd_docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.select("doc_id", "text").collect()]
    count = {}
    for _, data in rows:
        start = 0
        for end in ch.boundaries(data):
            count[data[start:end]] = count.get(data[start:end], 0) + 1
            start = end
    expect = sum(n for n in count.values() if n > 1)
    got = ch.repeated_chunks(odd_docs).collect()
    assert len(got) == expect
    assert sum(r.copies for r in {(r.digest, r.copies): r for r in got}.values()) == expect


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert {r.doc_id for r in ch.repeated_passages(odd_docs).collect()} >= {3, 20, 21}
    assert ch.repeated_passages(no_docs).count() == 0
    out = ch.deduplicated(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()


def test_passages_are_judged_by_whole_words_not_bytes(spark):
    rng = random.Random(4)

    def short(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(rng.randint(1, 3)))
                        for _ in range(n))
    rows, expect, spans = [], set(), {}
    for i in range(40):
        n = 51 if i % 2 else 50
        passage = "".join(short(n))
        for k in (0, 1):
            # Rims of capitals differ on either side.
            head, tail = (" ".join(words(rng, 30).upper().split()) + f" {k}X ", f" {k}Y " + words(rng, 30).upper())
            rows.append((2 * i + k, head + passage + tail))
            if n == 51:
                expect.add(2 * i + k)
                spans[2 * i + k] = (len(head), len(passage))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.start, r.n_bytes) for r in ch.repeated_passages(docs).collect()}
    assert set(found) <= expect
    assert len(found) >= 0.9 * len(expect)
    assert all(found[d] == spans[d] for d in found)


def test_repeated_rows_and_punctuated_quotes(spark):
    rng = random.Random(6)
    passage = words(rng, 51)
    rows = [(1, "A " + passage + " Z"), (2, 'said: "' + passage + '", they'), (9, words(rng, 80)), (9, None)]
    rows.append(rows[2])
    found = {r.doc_id: r for r in ch.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) == {1, 2, 9}
    assert all(found[d].n_bytes == len(passage) for d in (1, 2))
    assert found[9].n_bytes == len(rows[2][1]) and found[9].copies == 2 and found[9].n_first == found[9].n_chunks
