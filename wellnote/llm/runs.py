"""Periodic runs of words: stretches that repeat a block of words again and again.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no
neighbouring word extends keeping the period.  They are found by a suffix automaton built word by
word, whose suffix-link tree is kept as a link-cut tree: each path segment carries the position at
which its strings last ended.  The access of an appended word's state walks the segments up to the
root and recolours them with the new position.  A segment whose strings of up to L words ended d words
ago, with d <= L, shows a square of period d; the stretch of L + d words that ends here has smallest period
d (strings of the segment's length ended nowhere in between) and starts where the run starts, so
the squares of one (start, period) over successive words extend to the run.  Amortised O(log n) a word.

A run of exponent k or more inside a stretch of m words has a period of at most m / k, and each of its
words has an equal one within that distance.  Words without one are in no run: they are cut out, the
pieces are looked at in the same way, and only what is left is appended to an automaton.  This
loses no run: it is what bounds the work on ordinary prose.

Words are the maximal runs of bytes other than space and \\t to \\r.  Documents are independent: no
shuffle, one text at a time in memory.  A null or empty text has no words, no runs and an empty
collapsed text; an empty table gives none.  Repeated rows come out repeated; ids and other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellnote.llm.common import batches_of, rows_of

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Rounds of cutting; more would only cut more.
ROUNDS = 24

Run = tuple[int, int, int]


def automaton_runs(ids: Sequence[int], min_length: int = MIN_LENGTH,
                   min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """(start, length, period) of the runs of at least ``min_exponent`` periods and ``min_length`` words."""
    n = len(ids)
    size = 2 * n + 2
    length, link = [0] * size, [0] * size
    after: list[dict[int, int]] = [{}] * size
    after[1] = {}
    # The link-cut tree: up is the parent in a path's splay tree, or at its root the state above the
    # path; left leads to shorter strings, right to longer ones; ended holds at splay roots.
    up, left, right, ended = [0] * size, [0] * size, [0] * size, [0] * size

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p] = b
            right[x] = p
        else:
            b = left[x]
            right[p] = b
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            ended[x] = ended[p]

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    found: dict[tuple[int, int], int] = {}
    last, states = 1, 1
    more = min_exponent - 1
    for i, c in enumerate(ids, 1):
        states += 1
        cur = states
        after[cur] = {}
        length[cur] = i
        p = last
        while p and c not in after[p]:
            after[p][c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = after[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                states += 1
                clone = states
                length[clone] = length[p] + 1
                after[clone] = dict(after[q])
                link[clone] = link[q]
                # The clone stands on q's path right above q, with the same last end.
                splay(q)
                above = left[q]
                left[clone] = above
                if above:
                    up[above] = clone
                left[q] = clone
                up[clone] = q
                while p and after[p].get(c) == q:
                    after[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        up[cur] = link[cur]
        last = cur
        # Access: the segments from the new prefix up to the root, longest strings first.
        x, below = cur, 0
        while x:
            splay(x)
            end = ended[x]
            if end and length[x] >= more * (i - end):
                start = i - length[x] - (i - end)
                if i - start >= min_length:
                    found[start, i - end] = i
            if right[x]:
                ended[right[x]] = end
            right[x] = below
            below = x
            x = up[x]
        ended[below] = i
    return sorted((s, e - s, d) for (s, d), e in found.items())


def _pieces(alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], alive, [False]))))
    return edges[::2], edges[1::2]


def stretches(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Stretches (start, end) outside of which no word is in a run."""
    n = len(ids)
    alive = np.ones(n, bool)
    piece = np.zeros(n, np.int64)
    for _ in range(ROUNDS):
        starts, ends = _pieces(alive)
        sizes = ends - starts
        at = np.flatnonzero(alive)
        if not len(at):
            return []
        number = np.repeat(np.arange(len(sizes)), sizes)
        piece[at] = number
        order = at[np.lexsort((at, ids[at], number))]
        same = (ids[order[1:]] == ids[order[:-1]]) & (piece[order[1:]] == piece[order[:-1]])
        gap = np.where(same, order[1:] - order[:-1], n + 1)
        near = np.full(n, n + 1)
        near[order[1:]] = gap
        near[order[:-1]] = np.minimum(near[order[:-1]], gap)
        size = np.repeat(sizes, sizes)
        stay = (near[at] <= size // min_exponent) & (size >= min_length)
        if stay.all():
            break
        alive[at[~stay]] = False
    starts, ends = _pieces(alive)
    return [(int(s), int(e)) for s, e in zip(starts, ends) if e - s >= min_length]


def runs_of_words(words: Sequence[bytes], min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < min_length:
        return []
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return []
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    found = []
    for start, end in stretches(ids, min_length, min_exponent):
        found += [(start + s, size, period) for s, size, period in
                  automaton_runs(ids[start:end].tolist(), min_length, min_exponent)]
    return found


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> bytes:
    """The words joined by one space, of each run only the first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, size, period in runs:
        keep[start + period: start + size] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def word_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: its runs (start, length, period) in words, by start,
    then period, and its text with every run cut to its first period."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text in rows_of(batches):
                words = text.split()
                runs = runs_of_words(words, min_length, min_exponent)
                yield (doc_id, [{"start": s, "length": e, "period": d} for s, e, d in runs],
                       collapsed(words, runs).decode("utf-8", "replace"))
        return batches_of(rows(), schema)

    found = ids.mapInArrow(scan, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def looped(doc_id: Column, text: Column) -> Column:
    """The contract's edit: the words of one document in ten repeat with a period chosen by the id's
    crc32 (a null id counts as empty text); other texts are left as they are."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    first = F.pmod(g, n).cast("int")
    period = (1 + F.floor((n - first) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    times = F.ceil((n - first) / period).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, first + 1, period), times))
    edited = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), first), again), F.lit(1), n), " ")
    return F.when(F.pmod(h, F.lit(10)) == 0, F.when(n > 0, edited).otherwise(F.lit(""))).otherwise(text)


def run_report(found: DataFrame) -> DataFrame:
    """Per row of :func:`word_runs`: number of runs, the longest one (ties: smallest start, then
    period; nulls without a run), its exponent in thousandths, digests of all runs and of the
    collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"),
                                                              r["period"].alias("period"))))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    told = found.withColumn("best", best)
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.size")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.size") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
