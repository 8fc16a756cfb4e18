"""Exact Jaccard join of documents on word shingles, by token-combination prefixes.

A document's set holds the distinct shingles of ``SHINGLE`` words.  Two sets that reach the
threshold share most of their tokens, so it is enough to index a prefix of each set in one global
order: rare tokens first, then frequent ones.  Rare tokens are indexed singly.  Frequent tokens,
which would give long lists, are indexed as pairs inside hashed subclasses of them; the prefix is
extended by one token for each subclass it touches, which is exactly what a pair can miss.  Sets
sharing no signature cannot reach the threshold; all others are bounded by short parity rows of
their sets, and what is left is verified on whole sets.

The order and what counts as frequent come from counters of fixed number over all documents, into
which tokens are hashed: a token's counter is its own count plus noise that is much the same for all,
so tokens of shared passages stand behind those of one text.  The counters only steer the work, any
values give the same result.

Links inside large groups of copies are not expanded into all pairs.  Equal sets are one class.
A first round verifies, in each list, every class against the list's first (or previous) class, and
what is left against a few classes of the list's largest component; the last round verifies every
pair of one short list whose classes are still in different components.  Long lists of one group of near
copies go by the classes' differences from one set, the group's centre: |x ^ y| = |Dx ^ Dy|, so what links two
classes apart is shared differences, and those are rare where whole texts are alike.  Classes that have more of
them than their lists have rows share a passage, not a text; they are paired within their lists, the cheaper way.
Pairs inside one component cannot change it, all others are checked, so components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wellnote.llm.common import Powers, U64, batches_of, cut, mix64, rows_of

SHINGLE = 5
THRESHOLD = 75
#: Counters of the frequency sketch; their number does not grow with the data.
SKETCH = 1 << 17
#: Bits of the filter that finds the texts to verify; when it fills up, more texts pass, none is lost.
FILTER_BITS = 1 << 23
#: Parts into which the list of a token pair is split before its heads meet.
SALTS = 32
#: Trial partners per list, for lists of so many rows; both only save work.
TRIALS, TRIAL_LIST = 8, 16
#: Rows from which a list goes by differences; any value gives the same result.
LONG_LIST = 64
#: Classes of one group that share a copy of its centre.
GROUP_PART = 256
#: Classes remembered by a task so that copies it meets again are not indexed twice.
REMEMBERED = 1 << 18

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = b" \t\n\x0b\x0c\r"


class Shingler:
    """Set of shingle hashes (sorted, 64 bits) of a text, vectorised over its bytes."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size = size
        self.powers = Powers()
        self.byte = mix64(np.arange(1, 257, dtype=U64))
        self.space = np.zeros(256, bool)
        self.space[list(_SPACE)] = True
        self.place = mix64(np.arange(1000, 1000 + size, dtype=U64)) | U64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
        n = len(data)
        inside = np.zeros(n + 2, np.int8)
        inside[1:-1] = ~self.space[data]
        step = np.diff(inside)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        count = len(starts)
        if not count:
            return np.empty(0, U64)
        up, down = self.powers.upto(n + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, U64)
            np.cumsum(self.byte[data] * up[:n], out=sums[1:])
            words = mix64((sums[ends] - sums[starts]) * down[starts])
            if count < self.size:
                whole = (words * self.place[:count]).sum(dtype=U64) + U64(count)
                return mix64(np.array([whole], U64))
            last = count - self.size + 1
            shingles = words[:last] * self.place[0]
            for i in range(1, self.size):
                shingles += words[i: i + last] * self.place[i]
        return np.unique(mix64(shingles))


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set: (cid, rest)."""
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return (int.from_bytes(digest[:8], "little", signed=True),
            int.from_bytes(digest[8:], "little", signed=True))


def signatures(tokens: np.ndarray, counters: np.ndarray, limit: float, threshold: int = THRESHOLD
               ) -> tuple[np.ndarray, np.ndarray]:
    """Single-token and token-pair signatures of the prefix of a set (sorted by hash).

    Tokens are ordered by their counters, then hashes; those with a counter over ``limit`` are
    frequent.  Sizes fall into overlapping classes: class 0 up to 32 tokens uses single tokens
    throughout; class j covers 24*4**(j-1) to 32*4**j tokens with 8*4**(j-1) subclasses of frequent
    tokens.  Sets that can match have a class in common, and inside a class the number of pairs is
    linear in the size.
    """
    n = len(tokens)
    need = n - (threshold * n + 99) // 100 + 1
    count = counters[(tokens % U64(len(counters))).astype(np.int64)]
    order = np.argsort(count, kind="stable")
    tokens = tokens[order]
    known = int(np.searchsorted(count[order], limit, side="right"))
    rare, common = tokens[:known], tokens[known:]
    if len(rare) >= need:
        return rare[:need], np.empty(0, U64)
    single = rare
    pairs = [np.empty(0, U64)]
    if n <= 32:
        single = np.concatenate((rare, common[: need - len(rare)]))
    level, low = 1, 24
    while low <= n:
        if n <= low // 24 * 128:
            subclasses = 8 * (low // 24)
            part = ((common >> U64(20)) % U64(subclasses)).astype(np.int64)
            first = np.zeros(len(common), bool)
            first[np.unique(part, return_index=True)[1]] = True
            gained = np.cumsum(~first)
            length = int(np.searchsorted(gained, need - len(rare))) + 1
            order = np.argsort(part[:length], kind="stable")
            ids, chosen = part[:length][order], common[:length][order]
            ends = np.searchsorted(ids, ids, side="right")
            index = np.arange(len(ids))
            times = ends - index - 1
            left = np.repeat(index, times)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
            with np.errstate(over="ignore"):
                pairs.append(mix64(mix64(chosen[left]) + chosen[right] * U64(0x9E3779B97F4A7C15)
                                   + U64(level)))
        level, low = level + 1, low * 4
    return single, np.concatenate(pairs)


def parity_bits(tokens: np.ndarray) -> bytes:
    """One bit per token, added modulo 2 in a power of two of at least as many bits (64 to 2**17).

    In the sum of two such rows common tokens cancel out, so its ones never outnumber the tokens
    that only one set has: a bound on the similarity at a 64th of the size of the tokens.
    """
    size = 1 << min(17, max(6, (len(tokens) - 1).bit_length()))
    at = ((tokens >> U64(32)) & U64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=size) & 1).tobytes()


def fewest_differences(a: bytes, b: bytes) -> int:
    """Lower bound of the number of tokens that only one of two sets has."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


PROFILE = "doc_id long, n int, cid long, rest long, tid long, bits binary, counts array<int>"
_PROFILE = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("cid", pa.int64()), ("rest", pa.int64()),
                      ("tid", pa.int64()), ("bits", pa.binary()), ("counts", pa.list_(pa.int32()))])


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"),
                       text.alias("text"))


def profiles(docs: DataFrame) -> DataFrame:
    """Per document: set size and key; per task one more row (n = -1) with its token counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, seen = Shingler(), np.zeros(SKETCH, np.int64), set()

        def found() -> Iterator[tuple]:
            for doc_id, tid, text in rows_of(batches):
                tokens = shingler(text)
                if tid not in seen:  # copies are one class and would only look frequent
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(tid)
                    np.add.at(counts, (tokens % U64(SKETCH)).astype(np.int64), 1)
                cid, rest = set_key(tokens)
                yield doc_id, len(tokens), cid, rest, tid, parity_bits(tokens), None
            for start in range(0, SKETCH, 4096):
                part = counts[start: start + 4096]
                if part.any():
                    yield start, -1, 0, 0, 0, None, np.minimum(part, 2**31 - 1).astype(np.int32)

        yield from batches_of(found(), _PROFILE)

    return _texts(docs).mapInArrow(run, PROFILE)


def token_counters(profile: DataFrame) -> tuple[np.ndarray, float]:
    """All counters (``SKETCH`` numbers, whatever the input) and the limit beyond which one stands out."""
    parts = profile.filter("n = -1").select("doc_id", F.posexplode("counts").alias("at", "count"))
    sums = parts.filter("count > 0").groupBy((F.col("doc_id") + F.col("at")).cast("int").alias("counter")) \
        .agg(F.sum("count").cast("long").alias("count")).toPandas()
    counters = np.zeros(SKETCH, np.int64)
    counters[sums["counter"].to_numpy(np.int64)] = sums["count"].to_numpy(np.int64)
    mean = counters.mean()
    return counters, float(mean + 8 * mean ** 0.5 + 32)


POSTINGS = "sig long, cid long, n int, paired boolean"
_POSTINGS = pa.schema([("sig", pa.int64()), ("cid", pa.int64()), ("n", pa.int32()),
                       ("paired", pa.bool_())])


def postings(docs: DataFrame, counters: np.ndarray, limit: float) -> DataFrame:
    """Inverted index of prefix signatures; a task indexes a class it meets again only once."""
    shared = docs.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), set()
        frequencies = shared.value
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            sizes = [len(s) for s, *_ in held]
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([s for s, *_ in held]).view(np.int64)),
                pa.array(np.repeat(np.array([c for _, c, _, _ in held], np.int64), sizes)),
                pa.array(np.repeat(np.array([n for *_, n, _ in held], np.int32), sizes)),
                pa.array(np.repeat(np.array([p for *_, p in held], bool), sizes))], schema=_POSTINGS)

        for _, _, text in rows_of(batches):
            tokens = shingler(text)
            if not len(tokens):
                continue
            cid, _ = set_key(tokens)
            if cid in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(cid)
            for found, paired in zip(signatures(tokens, frequencies, limit), (False, True)):
                if len(found):
                    held.append((found, cid, len(tokens), paired))
                    size += len(found)
            if size >= 1 << 16:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return _texts(docs).mapInArrow(run, POSTINGS)


SETS = "cid long, rest long, tokens array<long>"
_SETS = pa.schema([("cid", pa.int64()), ("rest", pa.int64()), ("tokens", pa.list_(pa.int64()))])


def token_sets(docs: DataFrame, tids: DataFrame) -> DataFrame:
    """Sets of the classes whose text is named in ``tids``, one row per class (and few others).

    The texts are found by a bit filter of fixed size, so that texts need no shuffle.
    """
    bit = F.pmod("tid", F.lit(FILTER_BITS))
    words = tids.groupBy((bit / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(tid, {FILTER_BITS}) % 64 as int))")).alias("bits")
    ).toPandas()
    bits = np.zeros(FILTER_BITS // 64, U64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(U64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, held = Shingler(), set(), shared.value

        def found() -> Iterator[tuple]:
            for _, tid, text in rows_of(batches):
                at = tid % FILTER_BITS
                if not int(held[at >> 6]) >> (at & 63) & 1 or tid in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(tid)
                tokens = shingler(text)
                yield (*set_key(tokens), tokens.view(np.int64))

        yield from batches_of(found(), _SETS)

    return _texts(docs).mapInArrow(run, SETS).dropDuplicates(["cid", "rest"])


def _fewest(a: str, b: str) -> F.Column:
    """:func:`fewest_differences` of two columns of parity bits."""
    @F.pandas_udf("long")
    def differences(a, b):
        import pandas as pd
        return pd.Series([fewest_differences(x, y) for x, y in zip(a, b)], dtype="int64")

    return differences(a, b)


def possible(classes: DataFrame, pairs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) that the parity bits do not rule out."""
    def end(name: str) -> DataFrame:
        return classes.select(F.col("cid").alias(name), F.col("n").alias(f"n_{name}"),
                              F.col("bits").alias(f"bits_{name}"))

    both = pairs.join(end("a"), "a").join(end("b"), "b")
    sizes = F.col("n_a") + F.col("n_b")
    return both.filter((100 + threshold) * (sizes - _fewest("bits_a", "bits_b")) >= 2 * threshold * sizes) \
        .select("a", "b").distinct()


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the threshold."""
    pairs = cut(possible(classes, pairs, threshold))
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    sets = cut(token_sets(docs, classes.join(ends, "cid").select("tid")).join(ends, "cid", "left_semi"))
    second = pairs.join(sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    both = second.join(sets.select(F.col("cid").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.select("a", "b", common.alias("common"),
                       (F.size("tokens_a") + F.size("tokens_b")).alias("sizes")) \
        .filter(100 * F.col("common") >= threshold * (F.col("sizes") - F.col("common"))) \
        .select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, by minimum propagation with pointer jumping.

    Each round writes one table and follows labels twice, so rounds grow with the logarithm of the
    longest path.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")) \
            .agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                 F.least("label", "near").alias("label"))
        for _ in range(2):
            target = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
            moved = moved.join(target, "label").select("node", "old", F.least("label", "next").alias("label"))
        moved = cut(moved)
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after further links between nodes: components of the components they join."""
    def of(name: str) -> DataFrame:
        return labels.select(F.col("node").alias(name), F.col("label").alias(f"label_{name}"))

    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left") \
        .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).distinct()
    joined = components(cut(between))
    moved = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left") \
        .select("node", F.coalesce("to", "label").alias("label"))
    # Nodes without a link so far are their own label.
    alone = joined.join(labels, "node", "left_anti")
    return cut(moved.union(alone.select("node", "label")))


def _fits(a: str, b: str, threshold: int) -> F.Column:
    """Sizes that allow the threshold."""
    return threshold * F.greatest(a, b) <= 100 * F.least(a, b)


def rows_apart(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, cid, n, label): rows of the lists whose classes are not all in one component."""
    placed = rows.join(labels.withColumnRenamed("node", "cid"), "cid", "left") \
        .withColumn("label", F.coalesce("label", "cid"))
    split = placed.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")) \
        .filter("lo <> hi").select("sig")
    return cut(placed.join(split, "sig", "left_semi"))


def trial_pairs(apart: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """A few pairs per class that are likely to join its component to the largest of its list.

    In groups of copies with many changes not every pair reaches the threshold.  Each list names
    ``TRIALS`` classes of its largest component, by seeded hashes; its other classes try those.  This
    only makes the components fewer before all pairs across them are verified.
    """
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    known = cut(apart.join(sizes, "label", "left").withColumn("size", F.coalesce("size", F.lit(1))))
    top = known.groupBy("sig").agg(F.count("*").alias("rows"), F.max(F.struct("size", "label")).alias("top")) \
        .filter(F.col("rows") >= TRIAL_LIST).select("sig", F.col("top.label").alias("top"))
    members = known.join(top, "sig")
    seeds = [F.min(F.struct(F.xxhash64("cid", F.lit(i)), F.col("cid").alias("to"), F.col("n").alias("to_n")))
             .alias(f"p{i}") for i in range(TRIALS)]
    probes = members.filter("label = top").groupBy("sig").agg(*seeds)
    tries = members.filter("label <> top").join(probes, "sig").select(
        "cid", "n", F.explode(F.array(*[f"p{i}" for i in range(TRIALS)])).alias("p"))
    return tries.filter(_fits("n", "p.to_n", threshold)).select(
        F.least("cid", "p.to").alias("a"), F.greatest("cid", "p.to").alias("b")).distinct()


def long_lists(apart: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, cid, n, label, rows, top): the lists of ``LONG_LIST`` rows or more, with their rows and largest component."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    known = apart.join(sizes, "label", "left").withColumn("size", F.coalesce("size", F.lit(1)))
    tops = known.groupBy("sig").agg(F.count("*").alias("rows"), F.max(F.struct("size", "label")).alias("top")) \
        .filter(F.col("rows") >= LONG_LIST).select("sig", "rows", F.col("top.label").alias("top"))
    return cut(apart.join(tops, "sig"))


def centre_differences(docs: DataFrame, classes: DataFrame, lists: DataFrame) -> DataFrame:
    """(top, cid, n, label, tokens, d, most, far): classes of long lists and the tokens that only one of them and their
    centre has; there are ``d`` of these, or ``d`` to ``most`` where that is enough to know.

    Long lists whose largest component is the same are one group, named by it (``top``); a class stands in a group
    once, in however many of its lists it is.  The centre is the class of the largest component in most lists, for few
    changes leave most frequent words, without what it alone changed; any would do.  A class with more differences than
    its lists have rows is ``far``: it shares some passage with the others, and pairs are fewer than its differences.

    Whole sets travel only for classes that do not look far by their parity bits (of ``d`` tokens thrown into B bits about
    B / 2 * (1 - exp(-2d / B)) are left odd), and differences are kept only of classes that are not far (``tokens`` is null
    for others): a text may share passages with many groups, and each time its differences would be the text and the centre.
    """
    members = cut(lists.groupBy("top", "cid", "n", "label").agg(F.count("*").alias("lists"), F.sum("rows").alias("met")))
    centres = members.filter("label = top").groupBy("top").agg(F.max(F.struct("lists", "cid", "n")).alias("first")) \
        .select("top", F.col("first.cid").alias("centre_cid"), F.col("first.n").alias("centre_n"))
    bits = classes.select("cid", "bits")
    beside = _beside_centre(members.drop("lists").join(bits, "cid"), centres.join(
        bits.select(F.col("cid").alias("centre_cid"), F.col("bits").alias("centre_bits")), "centre_cid"))
    most = (F.col("n") + F.col("centre_n")).cast("long")
    counted = cut(beside.select(
        "top", "cid", "n", "label", "met", most.alias("most"), F.abs(F.col("n") - F.col("centre_n")).cast("long").alias("apart"),
        _fewest("bits", "centre_bits").alias("odd"),
        (F.least(F.octet_length("bits"), F.octet_length("centre_bits")) * F.lit(8.0)).alias("places")))
    full = 2 * F.col("odd") >= F.col("places")
    likely = F.when(full, F.col("most")).otherwise(-F.col("places") / 2 * F.log(1 - 2 * F.col("odd") / F.col("places")))
    bounded = counted.withColumn("close", F.greatest(likely, "apart") <= F.col("met")).withColumn("d", F.greatest("apart", "odd"))
    close = bounded.filter("close")
    used = centres.join(close.select("top").distinct(), "top", "left_semi")
    cids = cut(close.select("cid").union(used.select("centre_cid")).distinct())
    sets = cut(token_sets(docs, classes.join(cids, "cid").select("tid")).join(cids, "cid", "left_semi")
               .select("cid", "tokens"))
    whole = used.join(sets.select(F.col("cid").alias("centre_cid"), F.col("tokens").alias("centre")), "centre_cid")
    size, far = F.size("tokens").cast("long"), F.size("tokens") > F.col("met")
    known = _differing(close.join(sets, "cid"), whole.select("top", "centre"), "tokens").select(
        "top", "cid", "n", "label", F.when(~far, F.col("tokens")).alias("tokens"), size.alias("d"), size.alias("most"),
        far.alias("far"))
    return cut(known.union(bounded.filter("not close").select(
        "top", "cid", "n", "label", F.lit(None).cast("array<long>"), "d", "most", F.lit(True))))


def far_pairs(lists: DataFrame, changed: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of different components in one long list, at least one of them far from the centre.

    |x ^ y| is at least |Dx| - |Dy|, which rules out most pairs of a far and a near class.  |Dx| is ``d``, or lies between
    ``d`` and ``most`` if there is such a column.
    """
    most = F.col("most" if "most" in changed.columns else "d").alias("most")
    rows = lists.join(changed.select("top", "cid", "d", most, "far"), ["top", "cid"])

    def end(name: str) -> DataFrame:
        return rows.select("sig", F.col("cid").alias(name), *[
            F.col(c).alias(f"{name}_{c}") for c in ("n", "label", "d", "most", "far")])

    fewest = F.greatest(F.col("a_d") - F.col("b_most"), F.col("b_d") - F.col("a_most"))
    apart = (100 + threshold) * fewest <= (100 - threshold) * (F.col("a_n") + F.col("b_n"))
    return end("a").filter("a_far").join(end("b"), "sig").filter(
        (F.col("a_label") != F.col("b_label")) & (~F.col("b_far") | (F.col("a") < F.col("b"))) & apart
        & _fits("a_n", "b_n", threshold)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def group_differences(changed: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(top, cid, n, label, excess, low, low_cid, diff): the classes that are not far by their differences from their centre.

    ``changed`` is from :func:`centre_differences`.  ``excess`` is (100 + t) * |diff| - (100 - t) * n, ``low`` the group's
    least, of ``low_cid``: two classes link exactly when they share (excess + excess) / 2 / (100 + t) differences.
    """
    near = changed.filter("not far").drop("d", "most", "far")
    # What most classes have changed are the centre's own changes: they are taken back.
    sizes = near.groupBy("top").agg(F.count("*").alias("size"))
    usual = near.select("top", F.explode("tokens").alias("token")).groupBy("top", "token").agg(F.count("*").alias("df")) \
        .join(sizes, "top").filter(2 * F.col("df") > F.col("size")).groupBy("top").agg(F.collect_list("token").alias("centre"))
    none = F.array().cast("array<long>")
    usual = sizes.join(usual, "top", "left").select("top", F.coalesce("centre", none).alias("centre"))
    excess = (100 + threshold) * F.size("tokens").cast("long") - (100 - threshold) * F.col("n")
    apart_by = cut(_differing(near, usual, "tokens").select("top", "cid", "n", "label", excess.alias("excess"),
                                                            F.col("tokens").alias("diff")))
    low = apart_by.groupBy("top").agg(F.min(F.struct("excess", "cid")).alias("least")) \
        .select("top", F.col("least.excess").alias("low"), F.col("least.cid").alias("low_cid"))
    return cut(apart_by.join(low, "top"))


def _beside_centre(members: DataFrame, centres: DataFrame) -> DataFrame:
    """``members`` with the columns of their group's row in ``centres``.  A row of a large group stands in copies, one for
    about ``GROUP_PART`` members, so that the group is compared in many tasks; a small group has one."""
    parts = members.groupBy("top").agg(F.ceil(F.count("*") / GROUP_PART).alias("parts"))
    copies = centres.join(parts, "top").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = members.join(parts, "top").withColumn("salt", F.pmod("cid", "parts"))
    return dealt.drop("parts").join(copies.drop("parts"), ["top", "salt"]).drop("salt")


def _differing(members: DataFrame, centres: DataFrame, tokens: str) -> DataFrame:
    """``members`` with the tokens that only one of them and their group's centre has."""
    differing = F.concat(F.array_except(tokens, "centre"), F.array_except("centre", tokens))
    return _beside_centre(members, centres).withColumn(tokens, differing).drop("centre")


def difference_pairs(members: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of different components of a group (:func:`group_differences`) that may reach the threshold.

    Classes whose excess and the least one are not above 0 together link with the class of the least,
    whatever they share.  Any link of another class needs ``o`` > 0 shared differences, so with all in one order, rare
    ones first, the first shared one is among the |diff| - o + 1 first of both.  ``o`` grows with the other's
    excess: a place in the order is met by classes up to the excess ``reach``.
    """
    step = 2 * (100 + threshold)
    tokens = members.select("top", "cid", "n", "label", "excess", F.size("diff").alias("d"),
                            (F.col("excess") + F.col("low") > 0).alias("outer"), F.explode("diff").alias("token"))
    stats = tokens.groupBy("top", "token").agg(F.count("*").alias("df"), F.min("excess").alias("nearest"))
    place = F.row_number().over(W.partitionBy("top", "cid").orderBy("df", "token"))
    placed = cut(tokens.join(stats, ["top", "token"]).withColumn("place", place)
                 .withColumn("reach", step * (F.col("d") - F.col("place") + 1) - F.col("excess"))
                 .filter("df > 1 and nearest <= reach").drop("d", "df", "nearest", "place"))

    def end(name: str) -> DataFrame:
        return placed.select("top", "token", F.col("cid").alias(name), *[
            F.col(c).alias(f"{name}_{c}") for c in ("n", "label", "excess", "reach", "outer")])

    return end("a").filter("a_outer").join(end("b"), ["top", "token"]).filter(
        (F.col("a_label") != F.col("b_label")) & (F.col("b_excess") <= F.col("a_reach"))
        & (F.col("a_excess") <= F.col("b_reach")) & (~F.col("b_outer") | (F.col("a") < F.col("b")))
        & _fits("a_n", "b_n", threshold)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_components(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, tid (hash of the text), label, n_shingles, component_id.

    component_id is the smallest doc_id reachable by links, itself included.  Null and empty texts
    have an empty set and no link; rows of equal sets belong together.  Null ids never name a
    component that holds another id.  Rows with words belong together when their labels are equal.  Repeated rows come out repeated; other columns are ignored;
    an empty table gives no rows.
    """
    profile = cut(profiles(docs))
    counters, limit = token_counters(profile)
    rows = profile.filter("n >= 0").drop("counts")
    classes = cut(rows.filter("n > 0").groupBy("cid", "rest", "n", "bits").agg(F.min("tid").alias("tid")))
    rows = rows.drop("bits")

    index = postings(docs, counters, limit)
    # Lists of pairs of frequent tokens can be long: they are dealt in salted parts, whose heads meet again.
    dealt = index.withColumn("salt", F.when(F.col("paired"), F.pmod("cid", F.lit(SALTS))).otherwise(0))
    part = W.partitionBy("sig", "salt").orderBy("n", "cid")

    def neighbours(df: DataFrame, window) -> DataFrame:
        head, head_n = F.first("cid").over(window), F.first("n").over(window)
        df = df.withColumn("_lag", F.lag("cid").over(window)).withColumn("_lag_n", F.lag("n").over(window)) \
            .withColumn("_head", head).withColumn("_head_n", head_n) \
            .withColumn("_lead", F.lead("cid").over(window))
        fits_head = _fits("n", "_head_n", threshold)
        return df.withColumn("to", F.when(fits_head, F.col("_head")).otherwise(F.col("_lag"))) \
            .withColumn("to_n", F.when(fits_head, F.col("_head_n")).otherwise(F.col("_lag_n")))

    # Copies that several tasks indexed stand side by side; they are a list of one.
    listed = cut(neighbours(dealt, part).filter("paired or _lag is not null or _lead is not null")
                 .filter("_lag is null or _lag <> cid")
                 .select("sig", "cid", "n", "paired", "to", "to_n", F.col("_lag").isNull().alias("is_head")))
    heads = neighbours(listed.filter("paired and is_head").select("sig", "cid", "n"),
                       W.partitionBy("sig").orderBy("n", "cid"))
    step = listed.select("cid", "n", "to", "to_n").union(heads.select("cid", "n", "to", "to_n"))
    pairs = cut(step.filter(F.col("to").isNotNull() & (F.col("to") != F.col("cid"))
                            & _fits("n", "to_n", threshold))
                .select(F.least("cid", "to").alias("a"), F.greatest("cid", "to").alias("b")).distinct())
    links = cut(verified(docs, classes, pairs, threshold))
    labels = components(links)

    apart = rows_apart(listed.select("sig", "cid", "n"), labels)
    tried = cut(trial_pairs(apart, labels, threshold).join(pairs, ["a", "b"], "left_anti"))
    if not tried.isEmpty():
        labels = merged(labels, cut(verified(docs, classes, tried, threshold)))
        apart = rows_apart(apart.select("sig", "cid", "n"), labels)
    lists = long_lists(apart, labels)
    changed = centre_differences(docs, classes, lists)
    members = group_differences(changed, threshold)
    sure = members.filter("excess + low <= 0 and cid <> low_cid").select(
        F.least("cid", "low_cid").alias("a"), F.greatest("cid", "low_cid").alias("b")).distinct()
    short = apart.groupBy("sig").agg(F.count("*").alias("rows")).filter(F.col("rows") < LONG_LIST).select("sig")
    apart = apart.join(short, "sig", "left_semi")
    left = apart.select("sig", F.col("cid").alias("a"), F.col("n").alias("a_n"), F.col("label").alias("a_label"))
    right = apart.select("sig", F.col("cid").alias("b"), F.col("n").alias("b_n"), F.col("label").alias("b_label"))
    rest = left.join(right, "sig").filter(
        (F.col("a") < F.col("b")) & (F.col("a_label") != F.col("b_label")) & _fits("a_n", "b_n", threshold)) \
        .select("a", "b").union(difference_pairs(members, threshold)).union(far_pairs(lists, changed, threshold)).distinct()
    rest = cut(rest.join(pairs.union(tried), ["a", "b"], "left_anti"))
    links = cut(verified(docs, classes, rest, threshold).union(sure))
    if not links.isEmpty():
        labels = merged(labels, links)

    # A row without words is alone; its own id names it.
    owned = rows.join(labels.withColumnRenamed("node", "cid"), "cid", "left") \
        .withColumn("label", F.coalesce("label", "cid"))
    names = owned.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return owned.join(names, "label", "left").select(
        "doc_id", "tid", "label", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
