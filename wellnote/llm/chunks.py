"""Repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where its top bits are zero, within size
limits (where they never are, as in periodic text, at the largest value in reach).  Boundaries depend on the last ``GEAR`` bytes only, so an insertion shifts nothing behind the
next boundary and a passage shared by two texts has the same chunks but for its rims.

A chunk is compared by the ``LEAD`` words that start with it, which single chunks that agree by
chance do not survive, and every match is extended byte by byte, to both sides, against the text of
its first occurrence.  Neighbouring matches make one passage, cut to whole words; it counts when it
has over ``OVER_WORDS`` words, whatever its bytes.  A passage is missed only if no chunk starts at
the same place of its copies with ``LEAD`` words of it to come, or if all that do are first found in a
text that ends the likeness earlier; the README gives the measured recall.

Words are divided by white space; punctuation around a word may differ.  A character of a script
without spaces counts as a word, and a longer piece once for each ``LONG`` bytes begun.

Every repeated chunk has one first occurrence (smallest doc_id, text hash, offset); the others are
redundant.  A row is known by its doc_id and a hash of its text (``tid``: a checksum, or 64 bits
where the id is null), so that repeated and null ids need no care.

Defined results: null and empty texts have no chunks; repeated rows are copies of each other; a
null doc_id sorts last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wellnote.llm.common import Powers, U64, batches_of, cut, mix64, rows_of

MIN_CHUNK, MAX_CHUNK, GEAR = 12, 128, 16
#: A boundary stands after one position in 2**BOUNDARY_BITS on average.
BOUNDARY_BITS = 4
OVER_WORDS = 50
#: Words that a chunk is compared by, and the bytes after which a piece counts as a further word.
LEAD, LONG = 16, 32
_GEAR_TABLE = (mix64(np.arange(7, 263, dtype=U64)) >> U64(48)).astype(np.uint16)


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of a text's UTF-8 bytes; no character is split."""
    n = len(data)
    if not n:
        return []
    raw = np.frombuffer(data, np.uint8)
    rolled = _GEAR_TABLE[raw]
    step = 1
    while step < GEAR:
        more = rolled.copy()
        more[step:] += rolled[:-step] << np.uint16(step)
        rolled = more
        step *= 2
    # A cut stands before byte i + 1; not inside a character.
    opens = np.append((raw[1:] & 0xC0) != 0x80, True)
    ends = np.flatnonzero(((rolled >> np.uint16(16 - BOUNDARY_BITS)) == 0) & opens) + 1
    cuts, last = [], 0
    for end in [*ends.tolist(), n]:
        while end - last > MAX_CHUNK:
            # No boundary in reach: the largest value in reach, which texts of one period share.
            reach = rolled[last + MIN_CHUNK - 1: last + MAX_CHUNK] * opens[last + MIN_CHUNK - 1: last + MAX_CHUNK]
            last += MIN_CHUNK + int(reach.argmax())
            cuts.append(last)
        if end - last >= MIN_CHUNK or end == n and end > last:
            cuts.append(end)
            last = end
    return cuts


CHUNKS = "doc_id long, tid long, start int, n_bytes int, digest long, digest_rest int"
_CHUNKS = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("start", pa.int32()),
                     ("n_bytes", pa.int32()), ("digest", pa.int64()), ("digest_rest", pa.int32())])


def _tid() -> Column:
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.crc32(F.col("text").cast("binary")))


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk: doc_id, tid, start and n_bytes (UTF-8), digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for doc_id, tid, text in rows_of(batches):
                data, start = text.encode("utf-8", "surrogatepass"), 0
                for end in boundaries(data):
                    digest = hashlib.blake2b(data[start:end], digest_size=12).digest()
                    yield (doc_id, tid, start, end - start, int.from_bytes(digest[:8], "little", signed=True),
                           int.from_bytes(digest[8:], "little", signed=True))
                    start = end

        yield from batches_of(found(), _CHUNKS, size=1 << 15)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       _tid().alias("tid"), "text") \
        .filter("text is not null and text <> ''").mapInArrow(run, CHUNKS)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Chunks that occur more than once, with the first occurrence's place and whether this is it.

    Counts are aggregated before the shuffle, so a chunk that a third of all texts share is no hot
    group; only rows of repeated digests are kept for what follows.
    """
    made = chunks(docs)
    often = made.groupBy("digest").agg(F.count("*").alias("copies")).filter("copies > 1").select("digest")
    again = cut(made.join(often, "digest", "left_semi"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), "tid", "start")
    first = again.groupBy("digest", "digest_rest").agg(
        F.count("*").alias("copies"), F.min(place).alias("first")).filter("copies > 1")
    return again.join(first, ["digest", "digest_rest"]).select(
        "doc_id", "tid", "start", "n_bytes", "digest", "digest_rest", "copies",
        F.col("first.doc_id").alias("first_doc_id"),
        ((F.col("first.tid") == F.col("tid")) & (F.col("first.start") == F.col("start"))
         & F.col("first.doc_id").eqNullSafe(F.col("doc_id"))).alias("is_first"))


def _after_gaps(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start, and which bytes are white space; what stands before a place never matters behind it."""
    n = len(raw)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13)) | ((raw >= 28) & (raw <= 31))
    single = np.zeros(n, bool)
    if n > 2 and raw.max() >= 0xC2:
        a, b, c = raw[:-2], raw[1:-1], raw[2:]
        wide = ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) \
            | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        for k in range(3):
            space[k: n - 2 + k] |= wide
        narrow = (raw[:-1] == 0xC2) & ((raw[1:] == 0xA0) | (raw[1:] == 0x85))
        space[:-1] |= narrow
        space[1:] |= narrow
        # Thai, Lao, Myanmar, Khmer, kana and ideographs.
        lone = ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | ((a == 0xE1) & ((b <= 0x82) | (b == 0x9E) | (b == 0x9F))) \
            | ((a >= 0xE3) & (a <= 0xE9)) | ((a == 0xEF) & (b >= 0xA4) & (b <= 0xAB)) | ((a == 0xF0) & (b >= 0xA0) & (b <= 0xB3))
        single[:-2] = lone & ~space[:-2]
    opens = ~space
    opens[1:] &= space[:-1]
    if single.any():
        opens |= single
        # What follows a single character is a word of its own.
        at = np.flatnonzero(single)
        behind = at + np.where(raw[at] == 0xF0, 4, 3)
        behind = behind[behind < n]
        opens[behind] |= ~space[behind]
    return np.flatnonzero(opens), space


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and of what punctuation around them leaves."""
    starts, space = _after_gaps(raw)
    if not len(starts):
        return starts, starts, starts, starts
    gaps = np.append(np.flatnonzero(space), len(raw))
    ends = np.minimum(np.append(starts[1:], len(raw)), gaps[np.searchsorted(gaps, starts)])
    if (ends - starts).max() > LONG:
        cuts = np.concatenate([starts, *(np.arange(a + LONG, b, LONG) for a, b in zip(starts, ends) if b - a > LONG)])
        for _ in range(3):
            cuts = np.where((raw[np.minimum(cuts, len(raw) - 1)] & 0xC0) == 0x80, cuts + 1, cuts)
        starts = np.unique(cuts[cuts < len(raw)])
        starts = starts[~space[starts]]
        ends = np.minimum(np.append(starts[1:], len(raw)), gaps[np.searchsorted(gaps, starts)])
    low = raw | 0x20
    inner = np.flatnonzero(((low >= 97) & (low <= 122)) | ((raw >= 48) & (raw <= 57)) | (raw >= 0x80))
    if not len(inner):
        return starts, ends, starts, ends
    first = inner[np.minimum(np.searchsorted(inner, starts), len(inner) - 1)]
    last = inner[np.maximum(np.searchsorted(inner, ends) - 1, 0)] + 1
    plain = (first >= starts) & (first < ends)
    return starts, ends, np.where(plain, first, starts), np.where(plain, last, ends)


def leads(data: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks that have ``LEAD`` words to come, and a 64-bit hash of these words."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    at = np.array([0, *boundaries(data)[:-1]], np.int64)
    starts, _ = _after_gaps(raw)
    nth = np.searchsorted(starts, at, side="right") + LEAD - 1
    ends = np.append(starts, 1 << 40)[np.minimum(nth, len(starts))]
    ends = np.minimum(ends, at + LEAD * LONG)
    at, ends = at[ends <= n], ends[ends <= n]
    up, down = powers.upto(n + 1)
    sums = np.zeros(n + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(mix64(raw.astype(U64) + U64(1)) * up[:n], out=sums[1:])
        return at, mix64((sums[ends] - sums[at]) * down[at] + (ends - at).astype(U64)).view(np.int64)


LEADS = "doc_id long, tid long, start int, lead long"
_LEADS = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("start", pa.int32()), ("lead", pa.int64())])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tid().alias("tid"), "text") \
        .filter("text is not null and text <> ''")


def _rid(prefix: str = "") -> Column:
    """One key without nulls for (doc_id, tid)."""
    return F.xxhash64(F.col(f"{prefix}doc_id").isNull(), f"{prefix}doc_id", f"{prefix}tid")


def repeated_leads(docs: DataFrame) -> DataFrame:
    """Chunks whose leading words occur more than once, one row per place, with the first occurrence.

    Counts are aggregated before the shuffle, so words that a third of all texts share are no hot
    group; only rows of repeated words are kept for what follows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        held, n = [], 0
        for doc_id, tid, text in rows_of(batches):
            at, lead = leads(text.encode("utf-8", "surrogatepass"), powers)
            held.append((doc_id, tid, at, lead))
            n += len(at)
            if n >= 1 << 15:
                yield made_of(held)
                held, n = [], 0
        if n:
            yield made_of(held)

    def made_of(held: list[tuple]) -> pa.RecordBatch:
        sizes = np.array([len(at) for _, _, at, _ in held])
        which = pa.array(np.repeat(np.arange(len(held)), sizes))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in held], pa.int64()).take(which), pa.array([x[1] for x in held], pa.int64()).take(which),
             pa.array(np.concatenate([x[2] for x in held]).astype(np.int32)),
             pa.array(np.concatenate([x[3] for x in held]))], schema=_LEADS)

    made = _texts(docs).mapInArrow(run, LEADS)
    often = made.groupBy("lead").agg(F.count("*").alias("copies")).filter("copies > 1").select("lead")
    again = cut(made.join(often, "lead", "left_semi"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), "tid", "start")
    first = again.groupBy("lead").agg(F.count("*").alias("copies"), F.min(place).alias("first"))
    # Rows with equal id and text are one place with several copies.
    return again.groupBy("lead", "doc_id", "tid", "start").agg(F.count("*").alias("here")).join(first, "lead").select(
        "doc_id", "tid", "start", "here", "copies", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.tid").alias("first_tid"), F.col("first.start").alias("first_start"),
        ((F.col("first.tid") == F.col("tid")) & (F.col("first.start") == F.col("start"))
         & F.col("first.doc_id").eqNullSafe(F.col("doc_id"))).alias("is_first"))


def _alike(a: bytes, b: bytes) -> int:
    """Length of the common start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, size = 0, 64
    while a[low: low + size] == b[low: low + size]:
        low += size
        size *= 2
    x, y = np.frombuffer(a[low: low + size], np.uint8), np.frombuffer(b[low: low + size], np.uint8)
    m = min(len(x), len(y))
    return low + int((x[:m] != y[:m]).argmax())


def stretches(own: bytes, other: bytes, matches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, start in the other text) of all longest equal stretches through the matched places."""
    found, reach = [], {}
    turned = own[::-1], other[::-1]
    for s, t in sorted(matches):
        if s < reach.get(s - t, 0):
            continue
        left = _alike(turned[0][len(own) - s:], turned[1][len(other) - t:])
        right = _alike(own[s:], other[t:])
        reach[s - t] = s + right
        if left + right:
            found.append((s - left, s + right, t - left))
    return found


def echoes(matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring places of one text that share a first occurrence, as in periodic text."""
    last, found = {}, []
    for s, t in matches:
        if t in last:
            found.append((s, last[t]))
        last[t] = s
    return found


SPANS = "doc_id long, tid long, lo long, hi long, start long, end long, word long, last long"
_SPANS = pa.schema([(c.split()[0], pa.int64()) for c in SPANS.split(", ")])


def _span(words: tuple, n: int, lo: int, hi: int) -> tuple | None:
    """Bytes of the whole words of a stretch, and the numbers of the first and last of them."""
    starts, ends, inner, outer = words
    word, last = int(np.searchsorted(inner, lo)), int(np.searchsorted(outer, hi, side="right")) - 1
    if last < word:
        return None
    start = 0 if lo == 0 else int(starts[word]) if starts[word] >= lo else int(inner[word])
    end = n if hi == n else int(ends[last]) if ends[last] <= hi else int(outer[last])
    return lo, hi, start, end, word, last


def repeated_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Stretches of whole words that two places share, for both places: bytes and word numbers."""
    pairs = found.filter("not is_first or here > 1").groupBy("doc_id", "tid", "first_doc_id", "first_tid").agg(
        F.collect_list("start").alias("starts"), F.collect_list("first_start").alias("first_starts"))
    pairs = cut(pairs.withColumn("rid", _rid()).withColumn("first_rid", _rid("first_")))
    needed = pairs.select("rid").union(pairs.select(F.col("first_rid").alias("rid"))).distinct()
    # Repeated rows count once; dealt by the key that the joins need.
    texts = cut(_texts(docs).select(_rid().alias("rid"), "text").join(needed, "rid", "left_semi")
                .groupBy("rid").agg(F.first("text").alias("text")))
    both = pairs.join(texts.select(F.col("rid").alias("first_rid"), F.col("text").alias("first_text")), "first_rid") \
        .join(texts, "rid").select("doc_id", "tid", "first_doc_id", "first_tid", "starts", "first_starts", "text", "first_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for doc_id, tid, first_id, first_tid, starts, first_starts, text, first_text in rows_of(batches):
                own, other = (x.encode("utf-8", "surrogatepass") for x in (text, first_text))
                own_words = words_of(np.frombuffer(own, np.uint8))
                other_words = words_of(np.frombuffer(other, np.uint8))
                matches = sorted(zip(starts, first_starts))
                for lo, hi, there in stretches(own, other, matches):
                    if span := _span(own_words, len(own), lo, hi):
                        yield doc_id, tid, *span
                    if span := _span(other_words, len(other), there, there + hi - lo):
                        yield first_id, first_tid, *span
                for lo, hi, there in stretches(own, own, echoes(matches)):
                    for at in (lo, there):
                        if span := _span(own_words, len(own), at, at + hi - lo):
                            yield doc_id, tid, *span

        yield from batches_of(made(), _SPANS, size=1 << 13)

    return both.mapInArrow(run, SPANS).distinct()


def repeated_passages(docs: DataFrame, over_words: int = OVER_WORDS) -> DataFrame:
    """One row per maximal run of repeated stretches with more than ``over_words`` whole words.

    doc_id, tid, start, n_bytes, n_chunks (whose leading words are repeated), copies (of its rarest chunk),
    n_first (chunks whose first occurrence is here), first_doc_id (the smallest document that holds its
    first chunks).
    """
    found = cut(repeated_leads(docs))
    spans = repeated_spans(docs, found).withColumn("rid", _rid())
    before = W.partitionBy("rid").orderBy("word", "last").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("rid").orderBy("word", "last").rowsBetween(W.unboundedPreceding, 0)
    opens = F.when(F.col("word") <= F.max("last").over(before) + 1, 0).otherwise(1)
    passages = spans.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(upto)) \
        .groupBy("rid", "_run").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("start").alias("start"), F.max("end").alias("end"),
            (F.max("last") - F.min("word") + 1).alias("n_words")).filter(F.col("n_words") > over_words)
    chunk = found.select(_rid().alias("rid"), "doc_id", "tid", F.col("start").alias("at"), "copies", "is_first", "first_doc_id")
    return passages.join(chunk, "rid").filter("at >= lo and at < hi").groupBy("rid", "_run", "start", "end").agg(
        F.first("doc_id").alias("doc_id"), F.first("tid").alias("tid"), F.count("*").alias("n_chunks"),
        F.min("copies").alias("copies"), F.sum(F.col("is_first").cast("long")).alias("n_first"),
        F.min("first_doc_id").alias("first_doc_id")) \
        .select("doc_id", "tid", "start", (F.col("end") - F.col("start")).alias("n_bytes"), "n_chunks", "copies",
                "n_first", "first_doc_id")


def deduplicated(docs: DataFrame, over_words: int = OVER_WORDS) -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated passages but at their first occurrence.

    Passages all of whose chunks are first occurrences stay.  Rows with equal id and text are
    treated alike.
    """
    spans = repeated_passages(docs, over_words).filter("n_first < n_chunks") \
        .groupBy("doc_id", "tid").agg(F.sort_array(F.collect_list(F.struct("start", "n_bytes"))).alias("spans"))

    @F.pandas_udf("string")
    def without(texts, spans):
        import pandas as pd

        def rest(text, parts):
            if text is None or parts is None or not len(parts):
                return text
            data, at, kept = text.encode("utf-8", "surrogatepass"), 0, []
            for p in parts:
                kept.append(data[at:p["start"]])
                at = p["start"] + p["n_bytes"]
            return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
        return pd.Series([rest(t, s) for t, s in zip(texts, spans)], dtype=object)

    named = docs.select(F.struct("*").alias("row"), _tid().alias("own_tid"),
                        F.col("doc_id").cast("long").alias("own_id"))
    joined = named.join(spans, (F.col("own_tid") == F.col("tid")) & F.col("own_id").eqNullSafe(F.col("doc_id")),
                        "left")
    cleaned = without(F.col("row.text"), F.col("spans"))
    return joined.select(F.struct(*[cleaned.alias(c) if c == "text" else F.col("row")[c].alias(c)
                                    for c in docs.columns]).alias("row")).select("row.*")
