import struct
import zlib
from collections import Counter

import xxhash
from llm_samples import no_docs, odd_docs  # noqa: F401

from wellnote.llm import sharding as sh


def hash_long(value, seed):
    return xxhash.xxh64_intdigest(struct.pack("<q", value), seed=seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_shard(doc_id, shards):
    key = signed(hash_long(doc_id, 42))
    start = hash_long(key, 42)
    score = [xxhash.xxh64_intdigest(struct.pack("<i", i), seed=start) >> 11 for i in range(shards)]
    return max(range(shards), key=lambda i: (score[i], -i))


def test_against_brute_force(spark):
    docs = spark.range(3000).selectExpr("id * 7919 - 5000 as doc_id", "concat('text ', id % 50) as text")
    rows = sh.shard_documents(docs).collect()
    assert len(rows) == 3000
    for r in rows[:400]:
        assert r.shard == brute_shard(r.doc_id, 16) and r.grown_shard == brute_shard(r.doc_id, 17)
    assert all(r.grown_shard in (r.shard, 16) for r in rows)
    assert 60 < sum(r.grown_shard == 16 for r in rows) < 300
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) == 16 and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_weights_and_removal(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'' as text")
    weights = [1.0, 2.0, 4.0, 1.0]
    rows = {r.doc_id: (r.shard, r.grown_shard) for r in sh.with_shards(docs, weights, grown=2.0).collect()}
    share = Counter(s for s, _ in rows.values())
    for i, w in enumerate(weights):
        assert abs(share[i] / 20_000 - w / 8) < 0.02
    assert all(g in (s, 4) for s, g in rows.values())
    fewer = {r.doc_id: r.shard for r in sh.with_shards(docs, weights[:3]).collect()}
    assert all(fewer[d] == s for d, (s, _) in rows.items() if s != 3)


def test_odd_rows(spark, odd_docs, no_docs):
    got = sh.shard_documents(odd_docs).collect()
    given = odd_docs.collect()
    assert len(got) == len(given)
    expect = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in given)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == expect
    slots = Counter((r.shard, r.slot) for r in got)
    assert max(slots.values()) == 1
    # The rows' own column of that name gives way; all others stay.
    out = sh.with_shards(odd_docs, [1.0] * 4)
    assert out.schema["shard"].dataType.simpleString() == "int" and out.filter("row = 'mine'").count() == len(given)
    assert sh.shard_documents(no_docs).count() == 0


def test_no_udf_and_no_whole_shard_window(spark):
    docs = spark.range(10).selectExpr("id as doc_id", "'' as text")
    plan = sh.shard_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
